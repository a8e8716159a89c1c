"""Profiling / EDA queries.

Each returns a small DataFrame; every scan is one pass with partial
aggregation, and wide per-column profiles are a single ``agg`` followed by
``unpivot`` instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from faresight.sources.store import staged


def unique_counts(df: DataFrame) -> DataFrame:
    """Distinct sessions and customers."""
    return df.agg(F.count_distinct("ranker_id").alias("sessions"),
                  F.count_distinct("profileId").alias("customers"),
                  F.count(F.lit(1)).alias("rows"))


def sessions_without_selection(df: DataFrame) -> DataFrame:
    """Sessions whose max(selected) is not 1."""
    per = df.groupBy("ranker_id").agg(F.max("selected").alias("max_selected"),
                                      F.count(F.lit(1)).alias("options"))
    return per.filter(F.col("max_selected") != 1)


def counts_by(df: DataFrame, keys: list[str], name: str = "flights") -> DataFrame:
    """Rows per key, largest first (key breaks ties)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), *keys))


def sessions_per_customer(df: DataFrame) -> DataFrame:
    """C5 (what the label says): distinct sessions per customer."""
    return (df.groupBy("profileId").agg(F.count_distinct("ranker_id").alias("sessions"))
              .orderBy(F.col("sessions").desc(), "profileId"))


def describe_counts(counts: DataFrame, c: str) -> DataFrame:
    """describe() and box-plot statistics of a count column, in one row.

    ``q25, median, q75`` are nearest-rank quantiles (S5): the value at sorted
    place round((n − 1) q).  The box (``box_q25, box_q75`` and fences at 1.5
    times their distance) uses linear interpolation, like plots do.  Values are
    counted first, so both work on one row per distinct value, placed by the
    number of values before it."""
    v = F.col(c).cast("double")
    tally = staged(counts.filter(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n")), "tally")
    nulls = counts.agg(F.sum(v.isNull().cast("long")).alias("null_count"))
    ends = bucketed_ends(tally)
    n = F.sum("n")
    stats = tally.agg(n.alias("count"), (F.sum(F.col("v") * F.col("n")) / n).alias("mean"), F.min("v").alias("min"),
                      F.max("v").alias("max"))
    mean_sq = F.sum((F.col("v") - F.col("mean")) ** 2 * F.col("n"))
    std = tally.crossJoin(stats.select("mean", "count")).agg(
        F.sqrt(F.try_divide(mean_sq, F.max("count") - 1)).alias("std"))

    def at(place):
        """Value at a 0-based sorted place."""
        return F.min(F.when(F.col("end") > place, F.col("v")))

    picks, names = [], {}
    for q, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
        place = (F.col("count") - 1) * q
        names[name] = place
        picks += [at(F.round(place)).alias(name), at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}")]
    found = ends.crossJoin(stats.select("count")).groupBy("count").agg(*picks)
    for name in ("q25", "q75"):
        w = names[name] - F.floor(names[name])
        found = found.withColumn(f"box_{name}", F.col(f"_lo_{name}") + w * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")))
    iqr = F.col("box_q75") - F.col("box_q25")
    box = found.select("q25", "median", "q75", "box_q25", "box_q75", (F.col("box_q25") - 1.5 * iqr).alias("lower_fence"),
                       (F.col("box_q75") + 1.5 * iqr).alias("upper_fence"))
    outside = (F.col("v") < F.col("lower_fence")) | (F.col("v") > F.col("upper_fence"))
    outliers = tally.crossJoin(box.select("lower_fence", "upper_fence")).agg(
        F.sum(F.when(outside, F.col("n")).otherwise(0)).cast("long").alias("outliers"))
    return (stats.crossJoin(nulls).crossJoin(std).crossJoin(box).crossJoin(outliers)
            .select("count", "null_count", "mean", "std", "min", "q25", "median", "q75", "max", "box_q25", "box_q75",
                    "lower_fence", "upper_fence", "outliers"))


def bucketed_ends(tally: DataFrame) -> DataFrame:
    """``v, end``: number of values up to and including v, from (v, n) rows.

    Sums run inside slices of v, after the totals of the slices below."""
    sliced = tally.withColumn("_s", F.floor(F.log1p(F.abs("v")) * 8 * F.signum("v")))
    below = (sliced.groupBy("_s").agg(F.sum("n").alias("_t"))
             .withColumn("_before", F.coalesce(F.sum("_t").over(
                 Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t"))
    inside = F.sum("n").over(Window.partitionBy("_s").orderBy("v"))
    return sliced.withColumn("_in", inside).join(below, "_s").select("v", (F.col("_before") + F.col("_in")).alias("end"))


def histogram(counts: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed)."""
    v = F.col(c).cast("double")
    rng = counts.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((v - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    return (counts.crossJoin(F.broadcast(rng)).groupBy(b.alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("bin_min"), F.max(v).alias("bin_max"))
                  .orderBy("bin"))


#: Bits of one word that columns are packed into.
WORD_BITS = 60


def _packed(terms: list) -> F.Column:
    """Terms of separate bits as one word."""
    while len(terms) > 1:
        terms = [a.bitwiseOR(b) for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2:]
    return terms[0]


def missing_patterns(df: DataFrame) -> tuple[DataFrame, dict[str, F.Column]]:
    """Rows by which of their columns are null or empty: (words of bits, n), and each column's state there:
    0 null, 1 another value, for texts 1 empty and 2 another value."""
    words, at, states = [[]], 0, {}
    for f in df.schema.fields:
        text = isinstance(f.dataType, StringType)
        bits = 2 if text else 1
        if at + bits > WORD_BITS:
            words.append([])
            at = 0
        c = F.col(f.name)
        state = F.when(c.isNull(), 0).when(c == "", 1).otherwise(2) if text else c.isNotNull()
        words[-1].append(F.shiftleft(state.cast("long"), at))
        states[f.name] = F.shiftright(f"_word{len(words) - 1}", at).bitwiseAND(F.lit(2 ** bits - 1))
        at += bits
    rows = df.select(*[_packed(w).alias(f"_word{i}") for i, w in enumerate(words)])
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), states


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column null / empty-string / missing counts and percentage, one pass.

    Rows are counted by pattern first, so the sums per column run over patterns."""
    patterns, state = missing_patterns(df)
    n = F.col("n")
    aggs = [F.sum(n).alias("_rows")]
    for f in df.schema.fields:
        aggs.append(F.sum(F.when(state[f.name] == 0, n).otherwise(0)).alias(f"n__{f.name}"))
        if isinstance(f.dataType, StringType):
            aggs.append(F.sum(F.when(state[f.name] == 1, n).otherwise(0)).alias(f"e__{f.name}"))
    wide = patterns.agg(*aggs)
    entries = []
    for f in df.schema.fields:
        empty = F.coalesce(F.col(f"e__{f.name}"), F.lit(0)) if isinstance(f.dataType, StringType) else F.lit(0).cast("long")
        entries.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                F.col(f"n__{f.name}").alias("null_count"), empty.alias("empty_count")))
    long = wide.select("_rows", F.explode(F.array(*entries)).alias("e")).select("_rows", "e.*")
    missing = F.col("null_count") + F.col("empty_count")
    return long.select("column", "data_type", "null_count", "empty_count", missing.alias("missing_count"),
                       F.round(missing / F.col("_rows") * 100, 2).alias("missing_percentage"))


def dtype_histogram(profile: DataFrame) -> DataFrame:
    """Columns per data type."""
    return profile.groupBy("data_type").agg(F.count(F.lit(1)).alias("columns")).orderBy(F.col("columns").desc(), "data_type")


def missing_bands(profile: DataFrame) -> DataFrame:
    """C11: each column's band of missing share: =0, (0,10), [10,50), ≥50 percent."""
    p = F.col("missing_percentage")
    band = F.when(p == 0, "none").when(p < 10, "low").when(p < 50, "mid").otherwise("high")
    return profile.select("column", "missing_count", "missing_percentage", band.alias("band"))


def _stack(df: DataFrame, cols: list[str], name: str = "code") -> DataFrame:
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(name)).filter(F.col(name).isNotNull())


def carrier_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "Carrier_code" in c]


def distinct_carriers(df: DataFrame) -> DataFrame:
    """Distinct carrier codes over all carrier columns."""
    return _stack(df, carrier_columns(df)).distinct()


def carrier_frequency(df: DataFrame) -> DataFrame:
    """Occurrences of each carrier code, most frequent first."""
    return (_stack(df, carrier_columns(df)).groupBy("code").agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), "code"))


def top_carriers(df: DataFrame, n: int = 20) -> DataFrame:
    """C14: top-n of C13 (TakeOrdered)."""
    return carrier_frequency(df).limit(n)


def distinct_programmes_raw(df: DataFrame) -> DataFrame:
    """C15."""
    return df.select("frequentFlyer").distinct()


def programme_tokens(df: DataFrame) -> DataFrame:
    """Distinct '/'-separated programme tokens, sorted."""
    t = df.filter(F.col("frequentFlyer").isNotNull()).select(
        F.explode(F.split("frequentFlyer", "/")).alias("token"))
    return t.distinct().orderBy("token")


def programmes_without_carrier(df: DataFrame) -> DataFrame:
    """C17: programme tokens that are not a carrier code (set difference)."""
    carriers = distinct_carriers(df).withColumnRenamed("code", "token")
    return programme_tokens(df).join(carriers, "token", "left_anti")


def distinct_airports(df: DataFrame) -> DataFrame:
    """Distinct airport / city codes over every `_iata` column."""
    return _stack(df, [c for c in df.columns if c.endswith("_iata")]).distinct()


def baggage_values(df: DataFrame) -> DataFrame:
    """Distinct baggage quantities by measurement type (0 pieces, 1 weight)."""
    cells = [(c, c.replace("_quantity", "_weightMeasurementType"))
             for c in df.columns if c.endswith("baggageAllowance_quantity")]
    pairs = df.select(F.explode(F.array(*[F.struct(F.col(t).alias("measurement_type"), F.col(q).alias("quantity"))
                                          for q, t in cells])).alias("p")).select("p.*")
    pairs = pairs.filter(F.col("measurement_type").isNotNull() & F.col("quantity").isNotNull())
    return pairs.groupBy("measurement_type", "quantity").agg(F.count(F.lit(1)).alias("cells"))


def rows_per_segment(df: DataFrame, segment: str = "customer_segment") -> DataFrame:
    """C20."""
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("rows")).orderBy(segment)


def segment_session_stats(df: DataFrame, segment: str = "customer_segment") -> DataFrame:
    """Two-level aggregate – (segment, session) sizes, then per segment."""
    per = df.groupBy(segment, "ranker_id").agg(F.count(F.lit(1)).alias("n"))
    cust = df.groupBy(segment).agg(F.count_distinct("profileId").alias("customers"))
    return (per.groupBy(segment).agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("options"),
                                     F.min("n").alias("min_options"), F.max("n").alias("max_options"),
                                     F.avg("n").alias("avg_options"))
               .join(cust, segment).orderBy(segment))
