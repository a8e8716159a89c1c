"""DuckDB oracle for the 62 customer features (written from the feature
definitions, not from the Spark plan: quartiles are nearest-rank values of
sorted lists joined back, modes are explicit counts)."""

from __future__ import annotations

from faresight.plans.oracle_sqlparts import (HUBS_SQL, base_cte, clip_sql, fill0, lead_sql, mode_cte,
                                             row_mean_sql, seg)

# name → kind (i integer, d double, s string)
CUSTOMER_FEATURE_KINDS = {
    "company_id": "i", "sex": "i", "nationality": "i", "frequent_flyer": "s", "is_vip": "i", "by_self": "i",
    "has_corp_codes": "i", "total_flights_searched": "i", "total_search_sessions": "i",
    "avg_searches_per_session": "d", "unique_routes_searched": "i", "min_booking_lead_days": "i",
    "max_booking_lead_days": "i", "avg_booking_lead_days": "d", "median_booking_lead_days": "d",
    "most_common_departure_airport": "s", "unique_departure_airports": "i", "most_common_carrier": "s",
    "unique_carriers_used": "i", "roundtrip_preference": "d", "min_cabin_class": "i", "max_cabin_class": "i",
    "avg_cabin_class": "d", "weekday_preference": "i", "return_weekday_preference": "i",
    "weekend_travel_rate": "d", "return_weekend_travel_rate": "d", "time_of_day_variance": "d",
    "night_flight_preference": "d", "redeye_flight_preference": "d", "route_loyalty": "d",
    "hub_preference": "d", "short_haul_preference": "d", "connection_tolerance": "d",
    "preferred_duration_quartile": "i", "price_to_duration_sensitivity": "d", "avg_price_per_minute": "d",
    "price_per_minute_variance": "d", "price_position_preference": "d", "premium_economy_preference": "d",
    "consistent_price_tier": "d", "preferred_price_tier": "i", "baggage_qty_preference": "d",
    "baggage_weight_preference": "d", "loyalty_program_utilization": "d",
    "convenience_priority_score": "d", "loyalty_vs_price_index": "d", "planning_consistency_score": "d",
    "luxury_index": "d", "search_intensity_per_route": "d", "lead_time_variance": "i", "lead_time_skew": "d",
    "carrier_diversity": "d", "airport_diversity": "d", "cabin_class_range": "i", "customer_tier": "i",
    "vip_search_intensity": "d", "vip_carrier_diversity": "d", "vip_cabin_preference": "d",
    "corp_search_volume": "i", "corp_roundtrip_pref": "d", "corp_planning_variance": "i",
}


def customer_ctes(single_row_percentile: str = "'NaN'::DOUBLE", rounded: bool = True):
    """CTE list producing ``cust`` (profileId + 62 features, filled)."""
    cabin = [seg(L, S, "cabinClass") for L in (0, 1) for S in range(4)]
    sel = "selected = 1"
    ret = "selected = 1 AND legs1_departureAt IS NOT NULL"
    dep_air = seg(0, 0, "departureFrom_airport_iata")
    mkt0 = seg(0, 0, "marketingCarrier_code")
    last_arr = f"coalesce({seg(0, 2, 'arrivalTo_airport_iata')}, {seg(0, 1, 'arrivalTo_airport_iata')}, {seg(0, 0, 'arrivalTo_airport_iata')})"
    cells = [(seg(L, S, "baggageAllowance_weightMeasurementType"), seg(L, S, "baggageAllowance_quantity"))
             for L in (0, 1) for S in range(4)]

    def bag(t):
        return "least(" + ", ".join(f"CASE WHEN {tc} = {t} THEN {qc} END" for tc, qc in cells) + ")"
    prem = row_mean_sql([f"CAST({seg(0, S, 'cabinClass')} = 2 AS DOUBLE)" for S in range(4)])
    ppm = "totalPrice / greatest(trip_duration_minutes, 1)"
    lead = lead_sql()
    x, y = "totalPrice", "trip_duration_minutes"
    corr_f = f"FILTER (WHERE {sel} AND {x} IS NOT NULL AND {y} IS NOT NULL)"
    corr = (f"(CASE WHEN count({x}) {corr_f} = 0 THEN NULL "
            f"WHEN stddev_pop({x}) {corr_f} = 0 OR stddev_pop({y}) {corr_f} = 0 THEN 'NaN'::DOUBLE "
            f"ELSE covar_pop({x}, {y}) {corr_f} / (stddev_pop({x}) {corr_f} * stddev_pop({y}) {corr_f}) END)")
    short = (f"(1 - avg(leg0_duration_minutes) FILTER (WHERE {sel}) / 180) * 0.7 + "
             f"avg(CASE WHEN leg0_duration_minutes <= 180 THEN 1.0 ELSE 0.0 END) FILTER (WHERE {sel}) * 0.3")
    conn = " + ".join(f"CAST({seg(0, S, 'departureFrom_airport_iata')} IS NOT NULL AS INTEGER)" for S in range(4))

    def first(c):
        return f"arg_min({c}, Id) FILTER (WHERE {c} IS NOT NULL)"
    agg = f"""SELECT profileId,
  {first('companyID')} AS company_id,
  CAST({first('sex')} AS INTEGER) AS sex,
  {first('nationality')} AS nationality,
  coalesce(replace({first('frequentFlyer')}, '- ЮТэйр ЗАО', 'UT'), '') AS frequent_flyer,
  CAST({first('isVip')} AS INTEGER) AS is_vip,
  CAST({first('bySelf')} AS INTEGER) AS by_self,
  max(CAST(corporateTariffCode IS NOT NULL AS INTEGER)) AS has_corp_codes,
  count(*) AS total_flights_searched,
  count(DISTINCT ranker_id) AS total_search_sessions,
  count(*) / count(DISTINCT ranker_id) AS avg_searches_per_session,
  count(DISTINCT searchRoute) AS unique_routes_searched,
  min({lead}) FILTER (WHERE {sel}) AS min_booking_lead_days,
  max({lead}) FILTER (WHERE {sel}) AS max_booking_lead_days,
  avg({lead}) FILTER (WHERE {sel}) AS avg_booking_lead_days,
  median({lead}) FILTER (WHERE {sel}) AS median_booking_lead_days,
  count(DISTINCT {dep_air}) FILTER (WHERE {sel}) AS unique_departure_airports,
  count(DISTINCT {mkt0}) FILTER (WHERE {sel}) AS unique_carriers_used,
  avg(CASE WHEN legs1_departureAt IS NOT NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE {sel}) AS roundtrip_preference,
  min(least({', '.join(cabin)})) FILTER (WHERE {sel}) AS min_cabin_class,
  max(greatest({', '.join(cabin)})) FILTER (WHERE {sel}) AS max_cabin_class,
  avg({row_mean_sql(cabin)}) FILTER (WHERE {sel}) AS avg_cabin_class,
  avg(CASE WHEN isodow(dep0) >= 5 THEN 1.0 WHEN dep0 IS NOT NULL THEN 0.0 END) FILTER (WHERE {sel}) AS weekend_travel_rate,
  avg(CASE WHEN isodow(dep1) >= 5 THEN 1.0 WHEN dep1 IS NOT NULL THEN 0.0 END) FILTER (WHERE {ret}) AS return_weekend_travel_rate,
  stddev_samp(hour(dep0)) FILTER (WHERE {sel}) AS time_of_day_variance,
  avg(CASE WHEN hour(dep0) >= 22 OR hour(dep0) < 6 THEN 1.0 WHEN dep0 IS NOT NULL THEN 0.0 END) FILTER (WHERE {sel}) AS night_flight_preference,
  avg(CAST(hour(dep0) >= 22 OR hour(dep0) <= 5 OR (hour(dep0) >= 18 AND hour(arr0) <= 8) AS DOUBLE)) FILTER (WHERE {sel}) AS redeye_flight_preference,
  1 - (count(DISTINCT searchRoute) + max(CASE WHEN searchRoute IS NULL THEN 1 ELSE 0 END)) / greatest(count(*), 1) AS route_loyalty,
  avg(CAST(({dep_air} IN {HUBS_SQL}) OR ({last_arr} IN {HUBS_SQL}) AS DOUBLE)) FILTER (WHERE {sel}) AS hub_preference,
  {clip_sql(short, 0, 1)} AS short_haul_preference,
  avg({conn}) FILTER (WHERE {sel}) AS connection_tolerance,
  coalesce({corr}, 0) AS price_to_duration_sensitivity,
  avg({ppm}) FILTER (WHERE {sel}) AS avg_price_per_minute,
  coalesce(stddev_samp({ppm}) FILTER (WHERE {sel}), 0) AS price_per_minute_variance,
  avg(price_percentile) FILTER (WHERE {sel}) AS price_position_preference,
  avg({prem}) FILTER (WHERE {sel}) AS premium_economy_preference,
  1 - {clip_sql(f"coalesce(stddev_samp(price_tier) FILTER (WHERE {sel}), 0) / 3", 0, 1)} AS consistent_price_tier,
  coalesce(avg({bag(0)}) FILTER (WHERE {sel}), 0) AS baggage_qty_preference,
  coalesce(avg({bag(1)}) FILTER (WHERE {sel}), 0) AS baggage_weight_preference,
  coalesce(avg(CASE WHEN coalesce(contains(frequentFlyer, {mkt0}), false) THEN 1.0 ELSE 0.0 END) FILTER (WHERE {sel}), 0) AS loyalty_program_utilization
FROM crow GROUP BY profileId"""

    derived = """SELECT *,
  (1 - time_of_day_variance) * 10 + price_to_duration_sensitivity * 5 AS convenience_priority_score,
  loyalty_program_utilization * 10 - price_position_preference / 10 AS loyalty_vs_price_index,
  1.0 / (max_booking_lead_days - min_booking_lead_days + 1) AS planning_consistency_score,
  avg_cabin_class * 20 + price_position_preference / 2 AS luxury_index,
  total_flights_searched / greatest(unique_routes_searched, 1) AS search_intensity_per_route,
  max_booking_lead_days - min_booking_lead_days AS lead_time_variance,
  avg_booking_lead_days / (CASE WHEN median_booking_lead_days IS NULL THEN NULL ELSE greatest(median_booking_lead_days, 1) END) AS lead_time_skew,
  unique_carriers_used / greatest(total_flights_searched, 1) AS carrier_diversity,
  unique_departure_airports / greatest(total_flights_searched, 1) AS airport_diversity,
  max_cabin_class - min_cabin_class AS cabin_class_range,
  is_vip * 2 + CAST(has_corp_codes IS NOT NULL AS INTEGER) AS customer_tier
FROM cagg2"""
    inter = """SELECT *,
  search_intensity_per_route * is_vip AS vip_search_intensity,
  carrier_diversity * is_vip AS vip_carrier_diversity,
  avg_cabin_class * is_vip AS vip_cabin_preference,
  total_flights_searched * has_corp_codes AS corp_search_volume,
  roundtrip_preference * has_corp_codes AS corp_roundtrip_pref,
  (max_booking_lead_days - min_booking_lead_days) * has_corp_codes AS corp_planning_variance
FROM cder"""
    final = "SELECT profileId, " + ", ".join(f"{fill0(n, k, rounded)} AS {n}" for n, k in CUSTOMER_FEATURE_KINDS.items()) + " FROM cint"
    return [
        ("cbase", base_cte()),
        ("cwin", """SELECT *, rank() OVER (PARTITION BY ranker_id ORDER BY totalPrice) AS s_rank,
  count(totalPrice) OVER (PARTITION BY ranker_id) AS s_cnt FROM cbase"""),
        ("cq", """SELECT profileId, list_sort(list(totalPrice)) AS pl, count(totalPrice) AS pn,
  list_sort(list(leg0_duration_minutes)) AS dl, count(leg0_duration_minutes) AS dn FROM cbase GROUP BY profileId"""),
        ("cqq", """SELECT profileId,
  pl[CAST(round((pn-1)*0.25) AS INTEGER)+1] AS price_q25, pl[CAST(round((pn-1)*0.5) AS INTEGER)+1] AS price_q50,
  pl[CAST(round((pn-1)*0.75) AS INTEGER)+1] AS price_q75,
  dl[CAST(round((dn-1)*0.25) AS INTEGER)+1] AS dur_q25, dl[CAST(round((dn-1)*0.5) AS INTEGER)+1] AS dur_q50,
  dl[CAST(round((dn-1)*0.75) AS INTEGER)+1] AS dur_q75 FROM cq"""),
        ("crow", f"""SELECT w.*,
  CASE WHEN s_rank IS NULL OR totalPrice IS NULL THEN 50.0 WHEN s_cnt = 1 THEN {single_row_percentile}
       ELSE (s_rank - 1) / (s_cnt - 1) * 100.0 END AS price_percentile,
  CASE WHEN totalPrice <= price_q25 THEN 1 WHEN totalPrice <= price_q50 THEN 2 WHEN totalPrice <= price_q75 THEN 3 ELSE 4 END AS price_tier,
  CASE WHEN leg0_duration_minutes <= dur_q25 THEN 1 WHEN leg0_duration_minutes <= dur_q50 THEN 2
       WHEN leg0_duration_minutes <= dur_q75 THEN 3 ELSE 4 END AS dur_tier
FROM cwin w JOIN cqq USING (profileId)"""),
        ("cagg", agg),
        ("m_air", mode_cte("crow", "profileId", dep_air, sel, "most_common_departure_airport")),
        ("m_car", mode_cte("crow", "profileId", mkt0, sel, "most_common_carrier")),
        ("m_wd", mode_cte("crow", "profileId", "isodow(dep0)", sel, "weekday_preference")),
        ("m_rwd", mode_cte("crow", "profileId", "isodow(dep1)", ret, "return_weekday_preference0")),
        ("m_dq", mode_cte("crow", "profileId", "dur_tier", sel, "preferred_duration_quartile")),
        ("m_pt", mode_cte("crow", "profileId", "price_tier", sel, "preferred_price_tier")),
        ("cagg2", """SELECT cagg.*, most_common_departure_airport, most_common_carrier, weekday_preference,
  coalesce(return_weekday_preference0, -1) AS return_weekday_preference, preferred_duration_quartile, preferred_price_tier
FROM cagg LEFT JOIN m_air USING (profileId) LEFT JOIN m_car USING (profileId) LEFT JOIN m_wd USING (profileId)
  LEFT JOIN m_rwd USING (profileId) LEFT JOIN m_dq USING (profileId) LEFT JOIN m_pt USING (profileId)"""),
        ("cder", derived),
        ("cint", inter),
        ("cust", final),
    ]
