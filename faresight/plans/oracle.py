"""DuckDB SQL for each registered query (same column names and meaning)."""

from __future__ import annotations

from faresight.plans.oracle_binding import with_candidates

ORACLE: dict[str, str] = {}

ORACLE["candidates"] = with_candidates(final="SELECT * FROM candidates")

ORACLE["price_rank_hit_rate"] = with_candidates(
    ("r", """SELECT ranker_id, selected,
       row_number() OVER (PARTITION BY ranker_id ORDER BY totalPrice, Id) AS rk
FROM candidates"""),
    ("s", """SELECT ranker_id, max(CASE WHEN selected = 1 AND rk <= 3 THEN 1 ELSE 0 END) AS hit
FROM r GROUP BY ranker_id"""),
    final="""SELECT 3 AS k, count(*) AS sessions, CAST(sum(hit) AS BIGINT) AS hits,
       round(sum(hit) / count(*), 6) AS hit_rate FROM s""")

from faresight.plans.oracle_customers import customer_ctes  # noqa: E402

ORACLE["customer_features"] = with_candidates(*customer_ctes(), final="SELECT * FROM cust")

from faresight.plans.oracle_options import combined_ctes, option_ctes  # noqa: E402

ORACLE["option_features"] = with_candidates(*option_ctes(), final="SELECT * FROM opt")
ORACLE["combined_features"] = with_candidates(*combined_ctes(), final="SELECT * FROM comb")

from faresight.plans.oracle_profile import profile_oracles  # noqa: E402

ORACLE.update(profile_oracles())

from faresight.plans.oracle_customers import customer_ctes as _cc  # noqa: E402

_EMB = ("emb", "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings")
_EMB_LONG = ("el", "SELECT vec_id, label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM emb")
_CENT = ("cent", "SELECT label, i, avg(v) AS c, count(*) AS n FROM el GROUP BY label, i")

ORACLE["embedding_centroids"] = with_candidates(_EMB, _EMB_LONG, _CENT, final="""SELECT label, max(n) AS n,
  list(round(c, 6) ORDER BY i) AS centroid FROM cent GROUP BY label""")
ORACLE["embedding_nearest_centroid"] = with_candidates(
    _EMB, _EMB_LONG, _CENT,
    ("d", """SELECT el.vec_id, el.label, cent.label AS cl, sum((el.v - cent.c) * (el.v - cent.c)) AS d2
FROM el JOIN cent ON el.i = cent.i GROUP BY el.vec_id, el.label, cent.label"""),
    final="""SELECT vec_id, label, arg_min(cl, d2 * 1e9 + cl) AS nearest_label, round(sqrt(min(d2)), 6) AS min_distance
FROM d GROUP BY vec_id, label""")
ORACLE["embedding_silhouette"] = with_candidates(
    _EMB, _EMB_LONG,
    ("pd", """SELECT a.vec_id AS p, a.label AS pl, b.label AS ql, sum((a.v - b.v) * (a.v - b.v)) AS d2
FROM el a JOIN el b ON a.i = b.i GROUP BY a.vec_id, a.label, b.vec_id, b.label"""),
    ("sz", "SELECT label, count(*) AS n FROM emb GROUP BY label"),
    ("pc", """SELECT p, pl, ql, sum(d2) AS s FROM pd GROUP BY p, pl, ql"""),
    ("ab", """SELECT p, max(CASE WHEN pl = ql AND sz.n > 1 THEN s / (sz.n - 1) END) AS a,
  min(CASE WHEN pl <> ql THEN s / sz.n END) AS b FROM pc JOIN sz ON pc.ql = sz.label GROUP BY p"""),
    final="""SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette,
  count(*) AS points FROM ab""")

ORACLE["programme_top_tokens"] = with_candidates(*_cc(), final="""SELECT token, count(*) AS "count" FROM (
  SELECT unnest(string_split(frequent_flyer, '/')) AS token FROM cust WHERE frequent_flyer IS NOT NULL AND frequent_flyer <> '') t
GROUP BY token ORDER BY "count" DESC, token LIMIT 10""")
ORACLE["customer_encoding"] = with_candidates(
    *_cc(),
    ("top", """SELECT token FROM (SELECT unnest(string_split(frequent_flyer, '/')) AS token FROM cust
  WHERE frequent_flyer IS NOT NULL AND frequent_flyer <> '') t GROUP BY token ORDER BY count(*) DESC, token LIMIT 10"""),
    ("fa", "SELECT most_common_departure_airport AS v, count(*) AS f FROM cust WHERE most_common_departure_airport IS NOT NULL GROUP BY 1"),
    ("fc", "SELECT most_common_carrier AS v, count(*) AS f FROM cust WHERE most_common_carrier IS NOT NULL GROUP BY 1"),
    final="""SELECT profileId, CAST(coalesce(fa.f, 0) AS BIGINT) AS airport_frequency, CAST(coalesce(fc.f, 0) AS BIGINT) AS carrier_frequency,
  CAST(CASE WHEN frequent_flyer IS NOT NULL AND frequent_flyer <> '' THEN len(string_split(frequent_flyer, '/')) ELSE 0 END AS BIGINT) AS ff_program_count,
  CAST(CASE WHEN frequent_flyer IS NOT NULL AND frequent_flyer <> '' THEN
    (SELECT count(*) FROM top WHERE list_contains(string_split(frequent_flyer, '/'), top.token)) ELSE 0 END AS BIGINT) AS ff_top_hits
FROM cust LEFT JOIN fa ON cust.most_common_departure_airport = fa.v LEFT JOIN fc ON cust.most_common_carrier = fc.v""")

# feature and report name, written out here so that the report's own list is checked too
SEGMENT_MEANS = """total_flights_searched avg_flights_searched, total_search_sessions avg_search_sessions,
avg_searches_per_session avg_searches_per_session, unique_routes_searched avg_unique_routes, avg_booking_lead_days avg_lead_days,
median_booking_lead_days avg_median_lead_days, roundtrip_preference avg_roundtrip_pref, weekend_travel_rate avg_weekend_travel,
avg_cabin_class avg_cabin_class, route_loyalty avg_route_loyalty, carrier_diversity avg_carrier_diversity,
loyalty_program_utilization avg_loyalty_utilization, avg_price_per_minute avg_price_per_min,
price_per_minute_variance avg_price_variance, price_position_preference avg_price_position_pref"""
PROFILE_MEANS = """total_flights_searched avg_flights_searched, is_vip vip_rate, roundtrip_preference roundtrip_rate,
avg_booking_lead_days avg_lead_days, unique_carriers_used avg_carriers, avg_cabin_class avg_cabin_class,
loyalty_program_utilization avg_loyalty_utilization, price_position_preference avg_price_position_preference,
preferred_price_tier avg_preferred_price_tier, connection_tolerance avg_connection_tolerance,
weekend_travel_rate avg_weekend_travel_rate, night_flight_preference avg_night_flight_preference"""


def _means(pairs: str) -> str:
    return ", ".join("round(avg({}), 6) AS {}".format(*p.split()) for p in pairs.split(","))


ORACLE["segment_statistics_by_tier"] = with_candidates(*_cc(rounded=False), final=(
    "SELECT customer_tier, count(profileId) AS customer_count, round(avg(sex) * 100, 6) AS pct_male, "
    "round(avg(is_vip) * 100, 6) AS pct_vip, round(avg(has_corp_codes) * 100, 6) AS pct_corporate, "
    + _means(SEGMENT_MEANS)
    + ", CAST(sum(is_vip) AS BIGINT) AS vip_count, CAST(sum(has_corp_codes) AS BIGINT) AS corp_count "
    "FROM cust GROUP BY customer_tier"))
ORACLE["cluster_profiles_by_tier"] = with_candidates(*_cc(rounded=False), final=(
    "SELECT CAST(customer_tier AS BIGINT) AS customer_tier, " + _means(PROFILE_MEANS)
    + ", count(*) AS size FROM cust GROUP BY customer_tier"))
ORACLE["rows_per_tier"] = with_candidates(*_cc(), final="""SELECT CAST(customer_tier AS BIGINT) AS customer_tier, count(*) AS "rows"
FROM candidates JOIN cust USING (profileId) GROUP BY customer_tier""")
ORACLE["session_stats_by_tier"] = with_candidates(
    *_cc(), ("j", "SELECT customer_tier, profileId, ranker_id FROM candidates JOIN cust USING (profileId)"),
    ("per", "SELECT customer_tier, ranker_id, count(*) AS n FROM j GROUP BY ALL"),
    ("who", "SELECT customer_tier, count(DISTINCT profileId) AS customers FROM j GROUP BY customer_tier"),
    final="""SELECT CAST(customer_tier AS BIGINT) AS customer_tier, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS options,
  min(n) AS min_options, max(n) AS max_options, round(avg(n), 6) AS avg_options, any_value(customers) AS customers
FROM per JOIN who USING (customer_tier) GROUP BY customer_tier""")
ORACLE["embedding_label_distribution"] = "SELECT label, count(*) AS customers FROM embeddings GROUP BY label"
ORACLE["customer_programme_flags"] = with_candidates(
    *_cc(),
    ("top", """SELECT token FROM (SELECT unnest(string_split(frequent_flyer, '/')) AS token FROM cust
  WHERE frequent_flyer IS NOT NULL AND frequent_flyer <> '') t GROUP BY token ORDER BY count(*) DESC, token LIMIT 10"""),
    final="""SELECT profileId, token, CAST(coalesce(list_contains(string_split(frequent_flyer, '/'), token), FALSE) AS BIGINT) AS flag
FROM cust, top""")

from faresight.plans.oracle_customers import CUSTOMER_FEATURE_KINDS  # noqa: E402

ORACLE["customer_scaling"] = with_candidates(
    *_cc(), ("q", "\nUNION ALL\n".join(
        f"SELECT '{c}' AS name, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS a, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS b FROM cust" for c, kind in CUSTOMER_FEATURE_KINDS.items() if kind != "s")),
    final="SELECT name, round(m, 6) AS center, round(CASE WHEN b - a = 0 THEN 1.0 ELSE b - a END, 6) AS scale FROM q")
