"""DuckDB oracle SQL for profiling, split and metric queries."""

from __future__ import annotations

from faresight.plans.oracle_binding import with_candidates
from faresight.schema import LEGS, SEGMENTS, SEGMENT_ATTRS

SCALAR_COLUMNS = ["Id", "ranker_id", "profileId", "companyID", "nationality", "sex", "isVip", "bySelf",
                  "isAccess3D", "frequentFlyer", "corporateTariffCode", "requestDate", "searchRoute",
                  "totalPrice", "taxes", "miniRules0_monetaryAmount", "miniRules0_percentage",
                  "miniRules1_monetaryAmount", "miniRules1_percentage"]


def all_columns():
    cols = list(SCALAR_COLUMNS)
    for L in LEGS:
        cols += [f"legs{L}_departureAt", f"legs{L}_arrivalAt", f"legs{L}_duration"]
    for L in LEGS:
        for S in SEGMENTS:
            cols += [f"legs{L}_segments{S}_{a}" for a in SEGMENT_ATTRS]
    return cols + ["selected"]


def _typename(c):
    return (f"CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
            f"WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof({c})) END")


def _missing_cte():
    parts = []
    for c in all_columns():
        parts.append(f"SELECT '{c}' AS \"column\", any_value({_typename(c)}) AS data_type, "
                     f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
                     f"CASE WHEN typeof(any_value({c})) = 'VARCHAR' OR any_value({_typename(c)}) = 'string' "
                     f"THEN count(*) FILTER (WHERE CAST({c} AS VARCHAR) = '') ELSE 0 END AS empty_count, "
                     f"count(*) AS n FROM candidates")
    return ("miss0", "\nUNION ALL\n".join(parts)), ("miss", """SELECT "column", data_type, null_count, CAST(empty_count AS BIGINT) AS empty_count,
  null_count + empty_count AS missing_count, round((null_count + empty_count) / n * 100, 2) AS missing_percentage
FROM miss0""")


def _carrier_cols():
    return [f"legs{L}_segments{S}_{a}" for L in LEGS for S in SEGMENTS
            for a in ("marketingCarrier_code", "operatingCarrier_code")]


def _stack(cols, name="code"):
    return "\nUNION ALL\n".join(f"SELECT {c} AS {name} FROM candidates WHERE {c} IS NOT NULL" for c in cols)


def _iata_cols():
    return [f"legs{L}_segments{S}_{a}" for L in LEGS for S in SEGMENTS
            for a in ("departureFrom_airport_iata", "arrivalTo_airport_iata", "arrivalTo_airport_city_iata")]


def _tokens():
    return ("tok", "SELECT DISTINCT unnest(string_split(frequentFlyer, '/')) AS token FROM candidates WHERE frequentFlyer IS NOT NULL")


def _price_rank():
    return ("pr", """SELECT Id, ranker_id, selected, totalPrice,
  -(row_number() OVER (PARTITION BY ranker_id ORDER BY totalPrice, Id) / count(totalPrice) OVER (PARTITION BY ranker_id)) AS y_pred,
  row_number() OVER (PARTITION BY ranker_id ORDER BY totalPrice, Id) AS rk,
  count(*) OVER (PARTITION BY ranker_id) AS n
FROM candidates""")


def _assign():
    return [("sz", """SELECT ranker_id, count(*) AS flight_count,
  CASE WHEN count(*) <= 50 THEN 'very_small' WHEN count(*) <= 200 THEN 'small' WHEN count(*) <= 500 THEN 'medium'
       WHEN count(*) <= 1000 THEN 'large' ELSE 'very_large' END AS size_category
FROM candidates GROUP BY ranker_id"""),
            ("asg", """SELECT ranker_id, flight_count, size_category,
  (count(*) OVER (PARTITION BY size_category) > 1 AND
   row_number() OVER (PARTITION BY size_category ORDER BY md5(ranker_id || '|42'), ranker_id)
     <= ceil(count(*) OVER (PARTITION BY size_category) * 0.2)) AS is_test
FROM sz""")]


def profile_oracles() -> dict[str, str]:
    o = {}
    o["profile_unique_counts"] = with_candidates(final="""SELECT count(DISTINCT ranker_id) AS sessions,
  count(DISTINCT profileId) AS customers, count(*) AS "rows" FROM candidates""")
    o["profile_sessions_without_selection"] = with_candidates(final="""SELECT ranker_id, max(selected) AS max_selected,
  count(*) AS options FROM candidates GROUP BY ranker_id HAVING max(selected) <> 1""")
    o["profile_options_per_session"] = with_candidates(final="SELECT ranker_id, count(*) AS flights FROM candidates GROUP BY ranker_id")
    o["profile_options_per_customer"] = with_candidates(final="SELECT profileId, count(*) AS flights FROM candidates GROUP BY profileId")
    o["profile_options_per_customer_session"] = with_candidates(
        final="SELECT profileId, ranker_id, count(*) AS flights FROM candidates GROUP BY profileId, ranker_id")
    o["profile_sessions_per_customer"] = with_candidates(
        final="SELECT profileId, count(DISTINCT ranker_id) AS sessions FROM candidates GROUP BY profileId")
    for name, keys in (("session", "ranker_id"), ("customer", "profileId"), ("customer_session", "profileId, ranker_id")):
        cnt = ("cnt", f"SELECT {keys}, CAST(count(*) AS DOUBLE) AS v FROM candidates GROUP BY {keys}")
        o[f"profile_{name}_size_describe"] = with_candidates(
            cnt, ("srt", "SELECT list(v ORDER BY v) AS s, count(*) AS n FROM cnt"),
            ("st", """SELECT count(v) AS "count", CAST(count(*) FILTER (WHERE v IS NULL) AS BIGINT) AS null_count,
  avg(v) AS mean, stddev_samp(v) AS std, min(v) AS "min", max(v) AS "max",
  quantile_cont(v, 0.25) AS box_q25, quantile_cont(v, 0.75) AS box_q75 FROM cnt"""),
            ("st2", "SELECT *, box_q25 - 1.5*(box_q75 - box_q25) AS lower_fence, box_q75 + 1.5*(box_q75 - box_q25) AS upper_fence FROM st"),
            final="""SELECT "count", null_count, round(mean, 6) AS mean, round(std, 6) AS std, round("min", 6) AS "min",
  s[CAST(round((n - 1) * 0.25) AS INTEGER) + 1] AS q25, s[CAST(round((n - 1) * 0.5) AS INTEGER) + 1] AS median,
  s[CAST(round((n - 1) * 0.75) AS INTEGER) + 1] AS q75, round("max", 6) AS "max", round(box_q25, 6) AS box_q25,
  round(box_q75, 6) AS box_q75, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
  (SELECT CAST(count(*) AS BIGINT) FROM cnt, st2 WHERE v < lower_fence OR v > upper_fence) AS outliers FROM st2, srt""")
        o[f"profile_{name}_size_histogram"] = with_candidates(
            cnt, ("rng", "SELECT min(v) AS lo, max(v) AS hi FROM cnt"),
            final="""SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin,
  count(*) AS n, min(v) AS bin_min, max(v) AS bin_max FROM cnt, rng GROUP BY 1""")
    m0, m1 = _missing_cte()
    o["profile_missing_values"] = with_candidates(m0, m1, final="SELECT * FROM miss")
    o["profile_dtype_histogram"] = with_candidates(m0, m1, final="SELECT data_type, count(*) AS columns FROM miss GROUP BY data_type")
    o["profile_missing_bands"] = with_candidates(m0, m1, final="""SELECT "column", missing_count, missing_percentage,
  CASE WHEN missing_percentage = 0 THEN 'none' WHEN missing_percentage < 10 THEN 'low'
       WHEN missing_percentage < 50 THEN 'mid' ELSE 'high' END AS band FROM miss""")
    car = ("car", _stack(_carrier_cols()))
    o["profile_distinct_carriers"] = with_candidates(car, final="SELECT DISTINCT code FROM car")
    o["profile_carrier_frequency"] = with_candidates(car, final='SELECT code, count(*) AS "count" FROM car GROUP BY code')
    o["profile_top20_carriers"] = with_candidates(
        car, final='SELECT code, count(*) AS "count" FROM car GROUP BY code ORDER BY "count" DESC, code LIMIT 20')
    o["profile_programmes_raw"] = with_candidates(final="SELECT DISTINCT frequentFlyer FROM candidates")
    o["profile_programme_tokens"] = with_candidates(_tokens(), final="SELECT token FROM tok")
    o["profile_programmes_without_carrier"] = with_candidates(
        _tokens(), car, final="SELECT token FROM tok WHERE token NOT IN (SELECT code FROM car)")
    o["profile_distinct_airports"] = with_candidates(("air", _stack(_iata_cols())), final="SELECT DISTINCT code FROM air")
    bag = "\nUNION ALL\n".join(
        f"SELECT legs{L}_segments{S}_baggageAllowance_weightMeasurementType AS measurement_type, "
        f"legs{L}_segments{S}_baggageAllowance_quantity AS quantity FROM candidates"
        for L in LEGS for S in SEGMENTS)
    o["profile_baggage_values"] = with_candidates(("bag", bag), final="""SELECT measurement_type, quantity, count(*) AS cells
FROM bag WHERE measurement_type IS NOT NULL AND quantity IS NOT NULL GROUP BY ALL""")
    o["split_assignment"] = with_candidates(*_assign(), final="SELECT * FROM asg")
    o["split_distribution"] = with_candidates(*_assign(), final="""SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS side,
  size_category, count(*) AS sessions, CAST(sum(flight_count) AS BIGINT) AS "rows" FROM asg GROUP BY ALL""")
    hits = ("h", """SELECT ranker_id, count(*) AS n, max(CASE WHEN selected = 1 AND rk <= 3 THEN 1 ELSE 0 END) AS hit
FROM pr GROUP BY ranker_id""")
    o["price_rank_hit_rate_min10"] = with_candidates(_price_rank(), hits, final="""SELECT 3 AS k, count(*) AS sessions,
  CAST(sum(hit) AS BIGINT) AS hits, round(sum(hit) / count(*), 6) AS hit_rate FROM h WHERE n >= 10""")
    o["price_rank_hit_details"] = with_candidates(_price_rank(), final="""SELECT ranker_id AS search_id, count(*) AS group_size,
  CAST(sum(selected) AS BIGINT) AS num_actual_selections, max(CASE WHEN selected = 1 AND rk <= 3 THEN 1 ELSE 0 END) = 1 AS hit,
  coalesce(list_sort(list(CAST(y_pred AS DOUBLE)) FILTER (WHERE rk <= 3)), []) AS top_k_scores,
  coalesce(list_sort(list(CAST(y_pred AS DOUBLE)) FILTER (WHERE selected = 1)), []) AS actual_selections_scores
FROM pr GROUP BY ranker_id""")
    o["price_rank_ndcg"] = with_candidates(_price_rank(), final="""SELECT 3 AS k, count(*) AS sessions, round(avg(dcg / idcg), 6) AS ndcg FROM (
  SELECT ranker_id, sum(CASE WHEN rk <= 3 AND selected = 1 THEN 1.0 / log2(rk + 1.0) ELSE 0.0 END) AS dcg,
         sum(selected) AS pos,
         CASE least(sum(selected), 3) WHEN 1 THEN 1.0 WHEN 2 THEN 1.0 + 1.0/log2(3.0)
              ELSE 1.0 + 1.0/log2(3.0) + 1.0/log2(4.0) END AS idcg
  FROM pr GROUP BY ranker_id) t WHERE pos > 0""")
    o["price_flight_rank"] = with_candidates(_price_rank(), final="""SELECT Id, ranker_id,
  row_number() OVER (PARTITION BY ranker_id ORDER BY y_pred DESC, Id) AS flight_rank FROM pr""")
    o["segment_comparison_price"] = with_candidates(
        _price_rank(),
        ("vs", """SELECT pr.ranker_id, min(CAST(isVip AS INTEGER)) AS vip, count(*) AS n,
  max(CASE WHEN pr.selected = 1 AND rk <= 3 THEN 1 ELSE 0 END) AS hit
FROM pr JOIN candidates c ON pr.Id = c.Id GROUP BY pr.ranker_id HAVING count(*) >= 4"""),
        ("g", "SELECT CAST(vip AS BIGINT) AS is_vip, n, hit FROM vs UNION ALL SELECT 99 AS is_vip, n, hit FROM vs"),
        final="""SELECT is_vip, 'price_rank' AS model, count(*) AS sessions, round(CAST(sum(hit) AS DOUBLE), 6) AS hits,
  round(avg(hit), 6) AS hit_rate FROM g GROUP BY is_vip
UNION ALL SELECT is_vip, 'random' AS model, count(*) AS sessions, round(sum(least(3.0::DOUBLE / n, 1.0)), 6) AS hits,
  round(avg(least(3.0::DOUBLE / n, 1.0)), 6) AS hit_rate FROM g GROUP BY is_vip""")
    o["random_baseline"] = with_candidates(final="""SELECT 3 AS k, count(*) AS sessions, round(avg(least(3.0 / n, 1.0)), 6) AS random_hit_rate
FROM (SELECT ranker_id, count(*) AS n FROM candidates GROUP BY ranker_id) t""")
    o["price_rank_hit_rate_by_vip"] = with_candidates(
        _price_rank(), hits,
        ("vip", "SELECT DISTINCT ranker_id, CAST(isVip AS INTEGER) AS is_vip FROM candidates"),
        final="""SELECT is_vip, 3 AS k, count(*) AS sessions, CAST(sum(hit) AS BIGINT) AS hits,
  round(sum(hit) / count(*), 6) AS hit_rate FROM h JOIN vip USING (ranker_id) GROUP BY is_vip""")
    return o
