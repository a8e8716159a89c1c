"""DuckDB oracle for option features and the combined frame."""

from __future__ import annotations

from faresight.plans.oracle_customers import CUSTOMER_FEATURE_KINDS
from faresight.plans.oracle_sqlparts import HUBS_SQL, base_cte, dur_sql, fill0, lead_sql, row_mean_sql, seg

OPTION_FEATURE_KINDS = {
    "Id": "i", "ranker_id": "s", "profileId": "i", "corporateTariffCode": "i",
    "miniRules0_monetaryAmount": "d", "miniRules0_percentage": "d", "miniRules1_monetaryAmount": "d",
    "miniRules1_percentage": "d", "selected": "i", "is_access3D": "i", "is_roundtrip": "i", "route_origin": "s",
    "origin_is_major_hub": "i", "destination_is_major_hub": "i", "leg0_num_segments": "i",
    "leg1_num_segments": "i", "total_segments": "i", "leg0_flight_time_min": "i", "leg1_flight_time_min": "i",
    "booking_lead_days": "i", "leg0_duration_minutes": "i", "leg1_duration_minutes": "i",
    "trip_duration_minutes": "i", "leg0_departure_hour": "i", "leg0_departure_weekday": "i",
    "leg0_arrival_hour": "i", "leg0_arrival_weekday": "i", "leg1_departure_hour": "i", "leg1_arrival_hour": "i",
    "leg1_departure_weekday": "i", "leg1_arrival_weekday": "i", "has_cancellation_fee": "i",
    "has_exchange_fee": "i", "max_cabin_class": "i", "avg_cabin_class": "d", "min_seats_available": "i",
    "total_seats_available": "i", "baggage_allowance_quantity": "i", "baggage_allowance_weight": "i",
    "unique_carriers": "i", "primary_carrier": "s", "marketing_carrier": "s", "aircraft_diversity": "i",
    "primary_aircraft": "s", "is_daytime": "i", "is_weekend": "i", "is_redeye": "i", "has_connections": "i",
    "price_percentile": "d", "price_rank_pct": "d", "price_ratio_to_min": "d", "route_popularity": "i",
    "route_popularity_log": "d",
}

CROSS_FEATURE_KINDS = {
    "daytime_alignment": "d", "weekend_alignment": "d", "departure_weekday_match": "i",
    "return_departure_weekday_match": "i", "redeye_alignment": "d", "price_preference_match": "d",
    "carrier_loyalty_match": "i", "carrier_ff_match": "i",
}


def combined_kinds() -> dict:
    k = {n: t for n, t in OPTION_FEATURE_KINDS.items() if n != "profileId"}
    for n, t in CUSTOMER_FEATURE_KINDS.items():
        k[n + "_right" if n in ("max_cabin_class", "avg_cabin_class") else n] = t
    k.update(CROSS_FEATURE_KINDS)
    return k


def _distinct_sql(cols):
    return f"len(list_distinct([{', '.join(cols)}]))"


def option_ctes(single_row_percentile: str = "50.0", rounded: bool = True):
    L = (0, 1)
    mkt = [seg(l, s, "marketingCarrier_code") for l in L for s in range(4)]
    op = [seg(l, s, "operatingCarrier_code") for l in L for s in range(4)]
    air = [seg(l, s, "aircraft_code") for l in L for s in range(4)]
    cabin = [seg(l, s, "cabinClass") for l in L for s in range(4)]
    seats = [seg(l, s, "seatsAvailable") for l in L for s in range(4)]
    cells = [(seg(l, s, "baggageAllowance_weightMeasurementType"), seg(l, s, "baggageAllowance_quantity"))
             for l in L for s in range(4)]

    def bag(t):
        return "coalesce(least(" + ", ".join(f"CASE WHEN {a} = {t} THEN {q} END" for a, q in cells) + "), 0)"

    def fee(r):
        a, p = f"miniRules{r}_monetaryAmount", f"miniRules{r}_percentage"
        return f"CAST(coalesce({a} > 0, false) OR coalesce({p} > 0, false) AS INTEGER)"

    def nn(cols):
        return " + ".join(f"CAST({x} IS NOT NULL AS INTEGER)" for x in cols)
    feats = f"""SELECT Id, ranker_id, profileId, corporateTariffCode, miniRules0_monetaryAmount, miniRules0_percentage,
  miniRules1_monetaryAmount, miniRules1_percentage, selected, totalPrice, searchRoute,
  CAST(isAccess3D AS INTEGER) AS is_access3D,
  CAST(legs1_departureAt IS NOT NULL AS INTEGER) AS is_roundtrip,
  substring(searchRoute, 1, 3) AS route_origin,
  CAST(substring(searchRoute, 1, 3) IN {HUBS_SQL} AS INTEGER) AS origin_is_major_hub,
  CAST(substring(searchRoute, 4, 3) IN {HUBS_SQL} AS INTEGER) AS destination_is_major_hub,
  {nn([seg(0, s, 'duration') for s in range(4)])} AS leg0_num_segments,
  {nn([seg(1, s, 'duration') for s in range(4)])} AS leg1_num_segments,
  {nn(air)} AS total_segments,
  {' + '.join(dur_sql(seg(0, s, 'duration')) for s in range(4))} AS leg0_flight_time_min,
  {' + '.join(dur_sql(seg(1, s, 'duration')) for s in range(4))} AS leg1_flight_time_min,
  {lead_sql()} AS booking_lead_days,
  leg0_duration_minutes, leg1_duration_minutes, trip_duration_minutes,
  hour(dep0) AS leg0_departure_hour, isodow(dep0) AS leg0_departure_weekday,
  hour(arr0) AS leg0_arrival_hour, isodow(arr0) AS leg0_arrival_weekday,
  hour(dep1) AS leg1_departure_hour, hour(arr1) AS leg1_arrival_hour,
  isodow(dep1) AS leg1_departure_weekday, isodow(arr1) AS leg1_arrival_weekday,
  {fee(0)} AS has_cancellation_fee, {fee(1)} AS has_exchange_fee,
  greatest({', '.join(cabin)}) AS max_cabin_class, {row_mean_sql(cabin)} AS avg_cabin_class,
  least({', '.join(seats)}) AS min_seats_available,
  {' + '.join(f'coalesce({x}, 0)' for x in seats)} AS total_seats_available,
  {bag(0)} AS baggage_allowance_quantity, {bag(1)} AS baggage_allowance_weight,
  {_distinct_sql(mkt + op)} AS unique_carriers,
  coalesce({', '.join(mkt + op)}) AS primary_carrier,
  legs0_segments0_marketingCarrier_code AS marketing_carrier,
  {_distinct_sql(air)} AS aircraft_diversity,
  coalesce({', '.join(air)}) AS primary_aircraft
FROM obase"""
    derived = """SELECT *,
  CAST(leg0_departure_hour BETWEEN 6 AND 22 AS INTEGER) AS is_daytime,
  CAST(leg0_departure_weekday >= 5 AS INTEGER) AS is_weekend,
  CAST((leg0_departure_hour BETWEEN 6 AND 22) AND NOT (leg0_arrival_hour BETWEEN 6 AND 22) AS INTEGER) AS is_redeye,
  CAST(total_segments > 1 AS INTEGER) AS has_connections,
  rank() OVER (PARTITION BY ranker_id ORDER BY totalPrice) AS s_rank,
  row_number() OVER (PARTITION BY ranker_id ORDER BY totalPrice, Id) AS s_ord,
  count(totalPrice) OVER (PARTITION BY ranker_id) AS s_cnt,
  min(totalPrice) OVER (PARTITION BY ranker_id) AS s_min,
  count(*) OVER (PARTITION BY searchRoute) AS route_popularity
FROM ofeat"""
    win = f"""SELECT *,
  CASE WHEN totalPrice IS NULL THEN 50.0 WHEN s_cnt = 1 THEN {single_row_percentile}
       ELSE (s_rank - 1) / (s_cnt - 1) * 100.0 END AS price_percentile,
  s_ord / s_cnt AS price_rank_pct,
  totalPrice / s_min AS price_ratio_to_min,
  ln(1 + route_popularity) AS route_popularity_log
FROM oder"""
    final = "SELECT " + ", ".join(f"{fill0(n, k, rounded)} AS {n}" for n, k in OPTION_FEATURE_KINDS.items()) + " FROM owin"
    return [("obase", base_cte()), ("ofeat", feats), ("oder", derived), ("owin", win), ("opt", final)]


def combined_ctes():
    from faresight.plans.oracle_customers import customer_ctes
    cross = """SELECT o.* EXCLUDE (profileId), c.* EXCLUDE (profileId, max_cabin_class, avg_cabin_class),
  c.max_cabin_class AS max_cabin_class_right, c.avg_cabin_class AS avg_cabin_class_right,
  o.is_daytime * (1.0 - coalesce(c.night_flight_preference, 0.5)) AS daytime_alignment,
  o.is_weekend * coalesce(c.weekend_travel_rate, 0.5) AS weekend_alignment,
  CAST(o.leg0_departure_weekday = c.weekday_preference AS INTEGER) AS departure_weekday_match,
  CAST(o.leg1_departure_weekday = c.return_weekday_preference AS INTEGER) AS return_departure_weekday_match,
  o.is_redeye * coalesce(c.redeye_flight_preference, 0.5) AS redeye_alignment,
  o.price_rank_pct * coalesce(c.price_position_preference, 0.5) AS price_preference_match,
  CAST(o.primary_carrier = coalesce(c.most_common_carrier, 'unknown') AS INTEGER) AS carrier_loyalty_match,
  CAST(coalesce(contains(c.frequent_flyer, o.marketing_carrier), false) AS INTEGER) AS carrier_ff_match
FROM opt o JOIN cust c ON o.profileId = c.profileId"""
    kinds = combined_kinds()
    final = "SELECT " + ", ".join(
        (f"round({n}, 6) AS {n}" if t == "d" else f"CAST({n} AS BIGINT) AS {n}" if t == "i" else n)
        for n, t in kinds.items()) + " FROM comb0"
    return customer_ctes(rounded=False) + option_ctes(rounded=False) + [("comb0", cross), ("comb", final)]
