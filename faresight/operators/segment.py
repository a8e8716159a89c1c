"""Customer segmentation: encode → scale → PCA → cluster →
centroids → nearest-centroid assignment, plus cluster reports.

Scale notes
* Encoders are fitted with aggregates; what reaches the driver is bounded
  (top-10 programme tokens; frequency maps stay DataFrames and are joined).
* Robust-scaler quantiles are exact and interpolated: a sketch brackets each one,
  a second scan tallies the values inside the bracket.
* PCA fits a d×d covariance with a tree aggregate (d ≈ 70).
* Clusterings of all sizes are fitted and scored together (``clustering``), DBSCAN
  by balls and halos (``density``); segments are the best cut of seven linkage trees.
* Silhouette is exact for squared Euclidean distance via per-cluster sums (Σy, Σ‖y‖², n).
* Tables per label (statistics, centroids) are joined, never inlined into a plan.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from faresight.operators import clustering, density
from faresight.schema import ENCODER_SKIP
from faresight.sources.store import staged

# ship this module's functions by value: executors need only numpy and pyarrow
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROGRAMME_COL = "frequent_flyer"


# ------------------------------------------------------------------ encoding
@dataclass
class Encoders:
    top_programmes: list[str] = field(default_factory=list)
    frequency: dict[str, DataFrame] = field(default_factory=dict)


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, NumericType) and f.name not in ENCODER_SKIP]


def programme_token_counts(df: DataFrame, col: str = PROGRAMME_COL) -> DataFrame:
    """Token counts over non-empty programme strings."""
    toks = df.filter(F.col(col).isNotNull() & (F.col(col) != "")) \
             .select(F.explode(F.split(F.col(col), "/")).alias("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def fit_encoders(df: DataFrame, top_n: int = 10) -> Encoders:
    enc = Encoders()
    for col in categorical_columns(df):
        if col == PROGRAMME_COL:
            top = (programme_token_counts(df, col).orderBy(F.col("count").desc(), "token").limit(top_n))
            enc.top_programmes = [r.token for r in top.collect()]  # ≤ top_n rows
        else:
            enc.frequency[col] = (df.filter(F.col(col).isNotNull()).groupBy(col)
                                    .agg(F.count(F.lit(1)).cast("int").alias(f"{col}_frequency")))
    return enc


def programme_flags(df: DataFrame, tokens: list[str], col: str = PROGRAMME_COL) -> list:
    """1 / 0 per programme token, null where a customer has no programme (filled later)."""
    filled = F.col(col).isNotNull() & (F.col(col) != "")
    return [F.when(filled, F.array_contains(F.split(F.col(col), "/"), t).cast("int")).alias(f"ff_{t}") for t in tokens]


def apply_encoders(df: DataFrame, enc: Encoders) -> DataFrame:
    """Multi-hot top programmes + programme count, frequency-encode the other
    categoricals (unseen / null → 0), drop the originals, nulls → 0."""
    cats = categorical_columns(df)
    out = df
    if PROGRAMME_COL in cats:
        toks = F.split(F.col(PROGRAMME_COL), "/")
        filled = F.col(PROGRAMME_COL).isNotNull() & (F.col(PROGRAMME_COL) != "")
        out = out.select("*", *programme_flags(out, enc.top_programmes),
                         F.when(filled, F.size(toks)).otherwise(0).alias("ff_program_count"))
    for col, freq in enc.frequency.items():
        if col not in cats:
            continue
        out = out.join(freq, col, "left")
    out = out.drop(*cats)
    return out.na.fill(0)


# ------------------------------------------------------------------ scaling
#: Relative accuracy (one in so many) of the sketch that tells where a quantile lies.
SKETCH = 2_000


def _near_quantiles(batches, cols: list[str], brackets: dict[str, list[tuple[float, float]]]):
    """(name, q, v, n): how often each value of a quantile's bracket occurs, and with null ``v`` how many lie below it."""
    below: dict[tuple[str, int], int] = {}

    def rows(found):
        names, at, v, n = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int32()), pa.array(v, pa.float64()),
                                           pa.array(n, pa.int64())], ["name", "q", "v", "n"])

    for b in batches:
        for j, c in enumerate(cols):
            x = b.column(j).drop_null().to_numpy(zero_copy_only=False)
            for i, (lo, hi) in enumerate(brackets[c]):
                below[c, i] = below.get((c, i), 0) + int(np.count_nonzero(x < lo))
                v, n = np.unique(x[(x >= lo) & (x <= hi)], return_counts=True)
                if len(v):
                    yield rows([(c, i, *vn) for vn in zip(v.tolist(), n.tolist(), strict=True)])
    if below:
        yield rows([(c, i, None, n) for (c, i), n in below.items()])


def column_quantiles(df: DataFrame, cols: list[str], qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """``name`` and its exact, linearly interpolated quantiles ``q0, q1, …``.

    A sketch tells two values that a quantile lies between; the second scan counts
    what is below and tallies what is between them, so few values are shuffled.  A
    bracket that misses its quantile is widened to all values.  ``df`` is read two
    times or more: hand over a scan or a staged table."""
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    ends = [min(max(q + d / SKETCH, 0.0), 1.0) for q in qs for d in (-2, 2)]
    told = x.agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(c, ends, SKETCH).alias("e")).alias(f"_{j}") for j, c in enumerate(cols)]).first()
    size = {c: told[f"_{j}"]["n"] for j, c in enumerate(cols)}
    brackets = {}
    for j, c in enumerate(cols):
        e = told[f"_{j}"]["e"] or [0.0] * len(ends)
        brackets[c] = [(-np.inf if np.isnan(lo) else lo, np.inf if np.isnan(hi) else hi) for lo, hi in zip(e[::2], e[1::2], strict=True)]

    def tallied():
        return staged(x.mapInArrow(lambda b: _near_quantiles(b, cols, brackets), "name string, q int, v double, n long")
                      .groupBy("name", "q", "v").agg(F.sum("n").alias("n")), "quantiles")

    while True:
        tally = tallied()
        held = tally.groupBy("name", "q").agg(F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("below"), F.sum("n").alias("to")).collect()  # a row per quantile
        missed = [(r["name"], r["q"]) for r in held if brackets[r["name"]][r["q"]] != (-np.inf, np.inf)
                  and not r["below"] <= (size[r["name"]] - 1) * qs[r["q"]] <= r["to"] - 1 and size[r["name"]]]
        if not missed:
            break
        for c, i in missed:
            brackets[c][i] = (-np.inf, np.inf)
    upto = F.sum("n").over(Window.partitionBy("name", "q").orderBy(F.col("v").asc_nulls_first()))
    sizes = df.sparkSession.createDataFrame([(c, n) for c, n in size.items()], "name string, _n long")
    placed = tally.withColumn("_upto", upto).join(F.broadcast(sizes), "name")  # a row per column

    def at(i, position):
        # NaN, the largest value, is in no bracket
        return F.coalesce(F.min(F.when((F.col("q") == i) & F.col("v").isNotNull() & (F.col("_upto") > position), F.col("v"))),
                          F.when(F.max("_n") > 0, F.lit(float("nan"))))

    place = [(F.col("_n") - 1) * q for q in qs]
    found = placed.groupBy("name").agg(
        *[e for i, p in enumerate(place) for e in (at(i, F.floor(p)).alias(f"_lo{i}"), at(i, F.ceil(p)).alias(f"_hi{i}"))],
        F.max("_n").alias("_n"))
    part = [(F.col("_n") - 1) * q - F.floor((F.col("_n") - 1) * q) for q in qs]
    return found.select("name", *[(F.col(f"_lo{i}") + w * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}")
                                  for i, w in enumerate(part)])


def robust_scaling(df: DataFrame, cols: list[str]) -> DataFrame:
    """``name, center, scale``: median and q75 − q25 of each column (scale 0 → 1)."""
    spread = F.coalesce(F.col("q2") - F.col("q0"), F.lit(0.0))
    return column_quantiles(df, cols).select(
        "name", F.coalesce("q1", F.lit(0.0)).alias("center"), F.when(spread == 0, 1.0).otherwise(spread).alias("scale"))


def fit_robust_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """(center, scale) per column; one row per column reaches the driver."""
    found = {r["name"]: (r["center"], r["scale"]) for r in robust_scaling(df, cols).collect()}
    return {c: found.get(c, (0.0, 1.0)) for c in cols}


def apply_robust_scaler(df: DataFrame, params: dict[str, tuple[float, float]], keep=("profileId",)) -> DataFrame:
    return df.select(*[F.col(k) for k in keep if k in df.columns],
                     *[((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c) for c, (m, s) in params.items()])


# ------------------------------------------------------------------ PCA
def fit_pca(df: DataFrame, cols: list[str], variance: float = 0.95):
    """Centred PCA keeping the smallest k whose cumulative explained variance
    exceeds ``variance``.  Returns (assembler, centerer model, pca model, k)."""
    vec = VectorAssembler(inputCols=cols, outputCol="_x").transform(df)
    center = StandardScaler(inputCol="_x", outputCol="_xc", withMean=True, withStd=False).fit(vec)
    centred = center.transform(vec)
    full = PCA(k=len(cols), inputCol="_xc", outputCol="_pcs").fit(centred)
    cum, k = 0.0, len(cols)
    for i, v in enumerate(full.explainedVariance.toArray(), start=1):
        cum += v
        if cum > variance:
            k = i
            break
    return cols, center, full, k


def apply_pca(df: DataFrame, fitted, keep=("profileId",)) -> DataFrame:
    cols, center, full, k = fitted
    vec = VectorAssembler(inputCols=cols, outputCol="_x").transform(df)
    pcs = full.transform(center.transform(vec))
    arr = F.slice(vector_to_array(F.col("_pcs")), 1, k)
    return pcs.select(*[F.col(x) for x in keep if x in df.columns], array_to_vector(arr).alias("features"))


# ------------------------------------------------------------------ clustering
def cluster_stats(points: DataFrame, label: str = "cluster", vec: str = "features",
                  dim: int | None = None) -> DataFrame:
    """Per cluster: n, Σy (array), Σ‖y‖² – the sufficient statistics of centroids
    and of the squared-Euclidean silhouette."""
    arr = vector_to_array(F.col(vec)) if dict(points.dtypes)[vec] != "array<double>" else F.col(vec)
    p = points.select(F.col(label).alias("_c"), arr.alias("_y"))
    d = dim if dim is not None else len(p.first()["_y"])
    return p.groupBy("_c").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("_y")[i]) for i in range(d)]).alias("sum_y"),
        F.sum(F.aggregate(F.col("_y"), F.lit(0.0), lambda a, x: a + x * x)).alias("sum_sq"))


def centroids(points: DataFrame, label: str = "cluster", vec: str = "features") -> DataFrame:
    """Mean vector per label."""
    st = cluster_stats(points, label, vec)
    return st.select(F.col("_c").alias(label), "n",
                     F.transform("sum_y", lambda s: s / F.col("n")).alias("centroid"))


def _array(points: DataFrame, vec: str):
    return vector_to_array(F.col(vec)) if dict(points.dtypes)[vec] != "array<double>" else F.col(vec)


def _all_rows(points: DataFrame, table: DataFrame) -> DataFrame:
    """Every point with the rows of a table per label as the array ``_all``, a one-row side, however many labels.

    The row is broadcast by Spark only below its threshold."""
    return points.join(table.agg(F.sort_array(F.collect_list(F.struct(*table.columns))).alias("_all")))


def nearest_centroid(points: DataFrame, cents: DataFrame, label: str = "cluster",
                     vec: str = "features", out: str = "customer_segment") -> DataFrame:
    """Label of the nearest centroid (Euclidean, first wins ties) and the distance."""
    table = cents.select(F.col(label).alias("_label"), "centroid")
    x = _array(points, vec)
    far = F.transform("_all", lambda c: F.struct(F.aggregate(F.zip_with(x, c["centroid"], lambda a, b: (a - b) * (a - b)),
                                                             F.lit(0.0), lambda s, v: s + v).alias("d"), c["_label"].alias("l")))
    return (_all_rows(points, table).withColumn("_near", F.array_min(far))
            .select(*points.columns, F.col("_near.l").alias(out), F.sqrt("_near.d").alias("min_distance")))


def silhouette_sq(points: DataFrame, label: str = "cluster", vec: str = "features",
                  dim: int | None = None) -> DataFrame:
    """Exact mean silhouette with squared Euclidean distance.

    For point x and cluster C: Σ_{y∈C}‖x−y‖² = n_C‖x‖² − 2x·ΣC + Σ_C‖y‖².
    a(x) uses n_C − 1 (x itself contributes 0); singleton clusters score 0.
    The clusters' statistics are a joined table."""
    x = _array(points, vec)
    own = points.select(F.col(label).alias("_own"), x.alias("_x"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v).alias("_xx"))
    dot = lambda c: F.aggregate(F.zip_with("_x", c["sum_y"], lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    # rounding can push a distance of 0 below it
    far = F.transform("_all", lambda c: F.struct(c["_c"].alias("c"), c["n"].alias("n"), F.greatest(
        c["n"] * F.col("_xx") - 2 * dot(c) + c["sum_sq"], F.lit(0.0)).alias("d")))
    told = _all_rows(own, cluster_stats(points, label, vec, dim)).withColumn("_far", far)
    a = F.get(F.transform(F.filter("_far", lambda c: (c["c"] == F.col("_own")) & (c["n"] > 1)), lambda c: c["d"] / (c["n"] - 1)), F.lit(0))
    b = F.array_min(F.transform(F.filter("_far", lambda c: c["c"] != F.col("_own")), lambda c: c["d"] / c["n"]))
    told = told.select(a.alias("_a"), b.alias("_b"))
    # points that coincide with everything score 0
    score = F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    return told.select(score.alias("_s")).agg(F.avg("_s").alias("silhouette"), F.count(F.lit(1)).alias("points"))


#: Sizes that the reference sweeps: mixtures (J7), Ward alone (J9), seven linkages.
GMM_KS = list(range(15, 41, 5))
WARD_KS = list(range(10, 36, 5))
HIERARCHY_KS = list(range(4, 17))


def sweep_kmeans(points: DataFrame, ks, seed: int = 42, vec: str = "features"):
    """All k-means sizes together: (best k, its centres, [(k, squared silhouette)])."""
    fitted, scores = clustering.sweep_all(clustering.as_points(points, vec), kmeans_ks=ks, seed=seed)
    results = [(k, scores[f"kmeans:{k}"]) for k in ks if f"kmeans:{k}" in scores]
    name = clustering.best(scores)
    return (int(name.split(":")[1]) if name else None), (fitted.kmeans[name] if name else None), results


def linkage_segments(points: DataFrame, ks=None, seed: int = 42, vec: str = "features"):
    """The best cut of seven linkage trees, (setting, centroids, [(setting, squared silhouette)]).

    Centroids: (cluster, n, centroid), renumbered by ``ordered_labels``.  Where no
    cut gives two clusters, as with fewer than two places, all points are one."""
    found, scores = clustering.micro_sweep(clustering.as_points(points, vec), ks or HIERARCHY_KS, seed)
    name = clustering.best(scores)
    label = found.cuts[name] if name else np.zeros(len(found.micro.n) if found.micro else 0, dtype=int)
    rows = []
    for c in np.unique(label):
        mine = label == c
        n = found.micro.n[mine]
        rows.append((int(c), int(n.sum()), [float(v) for v in (n[:, None] * found.micro.centre[mine]).sum(0) / n.sum()]))
    cents = points.sparkSession.createDataFrame(ordered_labels(rows), "cluster int, n long, centroid array<double>")
    return name, cents, list(scores.items())


def alternative_methods(points: DataFrame, ks, seed: int = 42, gmm_ks=GMM_KS, ward_ks=WARD_KS,
                        hierarchy_ks=HIERARCHY_KS, key: str = "profileId") -> list[tuple[str, str, float]]:
    """(method, chosen setting, squared silhouette) of each family over its own sizes: k-means ``ks``,
    mixtures ``gmm_ks``, DBSCAN by radius, Ward ``ward_ks``, seven linkages ``hierarchy_ks``.  Families
    without a setting of two clusters or more are left out."""
    placed = staged(points.select(key, _array(points, "features").alias("x")), "points")
    _, scores = clustering.sweep_all(placed.select("x"), ks, gmm_ks, ward_ks, hierarchy_ks, seed)
    scores |= density.dbscan_sweep(placed, key, "x")
    out = []
    for method in ("kmeans", "gmm", "dbscan", "ward", "linkage"):
        name = clustering.best({n: s for n, s in scores.items() if n.startswith(f"{method}:")})
        if name is not None:
            out.append((method, name.split(":")[1], scores[name]))
    return out


def ordered_labels(rows: list[tuple[int, int, list[float]]]) -> list[tuple[int, int, list[float]]]:
    """Clusters (label, n, centroid) renumbered from 0 by size (largest first), then by centroid, so that
    labels do not depend on where a fit started."""
    return [(i, n, c) for i, (_, n, c) in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])))]


# ------------------------------------------------------------------ reports
#: Output names of the report.
PROFILE_MEANS = [
    ("total_flights_searched", "avg_flights_searched"), ("is_vip", "vip_rate"),
    ("roundtrip_preference", "roundtrip_rate"), ("avg_booking_lead_days", "avg_lead_days"),
    ("unique_carriers_used", "avg_carriers"), ("avg_cabin_class", "avg_cabin_class"),
    ("loyalty_program_utilization", "avg_loyalty_utilization"),
    ("price_position_preference", "avg_price_position_preference"),
    ("preferred_price_tier", "avg_preferred_price_tier"), ("connection_tolerance", "avg_connection_tolerance"),
    ("weekend_travel_rate", "avg_weekend_travel_rate"), ("night_flight_preference", "avg_night_flight_preference"),
]


def analyze_clusters(customers: DataFrame, labels: DataFrame, label: str = "customer_segment") -> DataFrame:
    """12 feature means and size per cluster (labels joined on profileId)."""
    j = customers.join(labels.select("profileId", label), "profileId")
    return (j.groupBy(label).agg(*[F.avg(c).alias(a) for c, a in PROFILE_MEANS], F.count(F.lit(1)).alias("size"))
             .orderBy(label))


def label_distribution(labels: DataFrame, label: str = "customer_segment") -> DataFrame:
    """J18 / G15."""
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("customers")).orderBy(label)


#: Output names of the report.
SEGMENT_MEANS = [
    ("total_flights_searched", "avg_flights_searched"), ("total_search_sessions", "avg_search_sessions"),
    ("avg_searches_per_session", "avg_searches_per_session"), ("unique_routes_searched", "avg_unique_routes"),
    ("avg_booking_lead_days", "avg_lead_days"), ("median_booking_lead_days", "avg_median_lead_days"),
    ("roundtrip_preference", "avg_roundtrip_pref"), ("weekend_travel_rate", "avg_weekend_travel"),
    ("avg_cabin_class", "avg_cabin_class"), ("route_loyalty", "avg_route_loyalty"),
    ("carrier_diversity", "avg_carrier_diversity"), ("loyalty_program_utilization", "avg_loyalty_utilization"),
    ("avg_price_per_minute", "avg_price_per_min"), ("price_per_minute_variance", "avg_price_variance"),
    ("price_position_preference", "avg_price_position_pref"),
]


def segment_statistics(customers: DataFrame, segment: str = "customer_segment") -> DataFrame:
    """Customers, demographic shares, behaviour means and VIP / corporate counts per segment."""
    c = F.col
    return (customers.groupBy(segment).agg(
        F.count("profileId").alias("customer_count"),
        (F.avg("sex") * 100).alias("pct_male"), (F.avg("is_vip") * 100).alias("pct_vip"),
        (F.avg("has_corp_codes") * 100).alias("pct_corporate"),
        *[F.avg(c(x)).alias(a) for x, a in SEGMENT_MEANS],
        F.sum("is_vip").cast("long").alias("vip_count"), F.sum("has_corp_codes").cast("long").alias("corp_count"))
        .orderBy(segment))
