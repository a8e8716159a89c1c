"""Ranks, counts and minima within a group, safe for hot groups.

``Window.partitionBy(key)`` sends a whole group to one task, which is right for
sessions and customers but not for a key that holds a large share of all rows.
One narrow aggregate over the key tells the keys of more than ``HOT_ROWS``
rows.  All other rows take one window: one shuffle, no join.  A hot key is cut
into slices by splitters of (value, tie) from a bounded sample of its rows, so
that equal values spread as well; rows are numbered inside (key, slice), and
what stands before a slice is added from the slices' sizes.

Rows with a null key are a group like any other; rows without a value are
dealt over slices of their own.  The input is read twice, or three times if a
key is hot; hand over a scan or a staged table.

Outputs (rank and ordinal are null where the value column is null):
``<prefix>rank``   – rank('min') by the value column,
``<prefix>ordinal``– rank('ordinal') by value then tie-breaker,
``<prefix>count``  – non-null values in the group,
``<prefix>min``    – minimum value in the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from faresight.sources.store import staged

#: Rows of a key beyond which it is cut into slices.
HOT_ROWS = 100_000
#: Slices of a hot key at most, and sampled rows per slice.
MAX_SLICES = 256
SAMPLE_PER_SLICE = 32
#: Slices that rows without a value are dealt over.
NULL_SLICES = 64
#: Hot keys that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 1_000


def _local(rows: DataFrame, groups: list[str], value: str, tie: str) -> DataFrame:
    """Places inside ``groups`` by one sort; rows without a value come last."""
    whole, v = Window.partitionBy(*groups), F.col(value)
    order = whole.orderBy(v.asc_nulls_last(), tie)
    return rows.select("*", F.rank().over(whole.orderBy(v.asc_nulls_last())).alias("_rank"), F.row_number().over(order).alias("_ordinal"),
                       F.count(v).over(whole).alias("_count"), F.min(v).over(whole).alias("_min"))


def _splitters(rows: DataFrame, hot: DataFrame, key: str, value: str, tie: str, hot_rows: int) -> DataFrame:
    """Each hot key with sorted (value, tie) pairs that cut it into parts of about half ``hot_rows`` rows."""
    parts = F.least(F.ceil(2 * F.col("_n") / hot_rows), F.lit(MAX_SLICES)).cast("int")
    draw = F.pmod(F.xxhash64(F.col(tie), F.lit(7)), F.lit(1 << 30)) < (F.lit(float(SAMPLE_PER_SLICE << 30)) * parts / F.col("_n"))
    sample = (rows.join(hot, rows[key].eqNullSafe(hot["_key"])).filter(F.col(value).isNotNull()).filter(draw)
              .groupBy("_key", "_n").agg(F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col(tie).alias("t")))).alias("_s")))
    pick = F.expr(f"transform(filter(sequence(1, {MAX_SLICES}), i -> i < least(ceil(2 * _n / {hot_rows}), {MAX_SLICES})), "
                  f"i -> get(_s, int(size(_s) * i / least(ceil(2 * _n / {hot_rows}), {MAX_SLICES}))))")
    cut = sample.select("_key", F.array_distinct(F.array_compact(pick)).alias("_cuts"))
    # a key without a value has no sample
    return staged(hot.join(cut.withColumnRenamed("_key", "_k"), hot["_key"].eqNullSafe(F.col("_k")), "left").select(
        "_key", F.coalesce("_cuts", F.array().cast(cut.schema["_cuts"].dataType)).alias("_cuts")), "splitters")


def _hot_places(rows: DataFrame, hot: DataFrame, key: str, value: str, tie: str, hot_rows: int, few: bool) -> DataFrame:
    """The rows of hot keys with their places, by slices."""
    cuts = _splitters(rows, hot, key, value, tie, hot_rows)
    cuts = F.broadcast(cuts) if few else cuts
    place = F.struct(F.col(value).alias("v"), F.col(tie).alias("t"))
    own = F.when(F.col(value).isNull(), -F.lit(1) - F.pmod(F.xxhash64(F.col(tie)), F.lit(NULL_SLICES))).otherwise(
        F.size(F.filter("_cuts", lambda c: c < place)).cast("long"))
    sliced = rows.join(cuts, rows[key].eqNullSafe(cuts["_key"])).withColumn("_slice", own).drop("_cuts")
    local = staged(_local(sliced, ["_key", "_slice"], value, tie), "hot-ranks")
    # rank('min') of the largest value tells how many rows of a slice have it
    sizes = (local.filter(F.col(value).isNotNull()).groupBy("_key", "_slice").agg(
        F.max("_count").alias("n"), F.min("_min").alias("least"), F.max(value).alias("most"), F.max("_rank").alias("last")))
    slices = sizes.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_slice", "n", "least", "most", "last"))).alias("_all"))
    bases = slices.select("_key", F.explode("_all").alias("s"), "_all").select(
        "_key", F.col("s._slice").alias("_slice"), F.col("s.least").alias("_least"),
        F.expr("aggregate(_all, 0L, (a, x) -> a + IF(x._slice < s._slice, x.n, 0L))").alias("_before"),
        # rows of earlier slices with this slice's smallest value: its rank begins there
        F.expr("aggregate(_all, 0L, (a, x) -> a + IF(x._slice < s._slice AND x.most <=> s.least, x.n - x.last + 1L, 0L))").alias("_tied"))
    totals = slices.select("_key", F.expr("aggregate(_all, 0L, (a, x) -> a + x.n)").alias("_total"), F.col("_all")[0]["least"].alias("_lowest"))
    a, b, t = local.alias("a"), bases.alias("b"), totals.alias("t")
    joined = a.join(b, F.col("a._key").eqNullSafe(F.col("b._key")) & (F.col("a._slice") == F.col("b._slice")), "left").join(
        t, F.col("a._key").eqNullSafe(F.col("t._key")), "left")
    tied = F.when(F.col(f"a.{value}").eqNullSafe(F.col("b._least")), F.col("b._tied")).otherwise(0)
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in rows.columns], (F.col("b._before") + F.col("a._rank") - tied).alias("_rank"),
                         (F.col("b._before") + F.col("a._ordinal")).alias("_ordinal"),
                         F.coalesce("t._total", F.lit(0).cast("long")).alias("_count"), F.col("t._lowest").alias("_min"))


def _outputs(places: DataFrame, columns: list[str], value: str, prefix: str) -> DataFrame:
    v = F.col(value)
    return places.select(*columns, F.when(v.isNotNull(), F.col("_rank")).cast("long").alias(prefix + "rank"),
                         F.when(v.isNotNull(), F.col("_ordinal")).cast("long").alias(prefix + "ordinal"),
                         F.col("_count").alias(prefix + "count"), F.col("_min").alias(prefix + "min"))


def group_rank(df: DataFrame, key: str, value: str, tie: str, prefix: str = "g_", hot_rows: int | None = None) -> DataFrame:
    """Add rank / ordinal / count / min of ``value`` within ``key`` groups.

    Building the plan runs one narrow job: the sizes of the keys."""
    kind = df.schema[value].dataType
    if not isinstance(kind, (NumericType, StringType)):
        raise TypeError(f"{value}: numbers and strings can be ranked, not {kind.simpleString()}")
    hot_rows = hot_rows or HOT_ROWS
    hot = staged(df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows), "hot-keys")
    many = hot.limit(BROADCAST_KEYS + 1).count()
    if not many:
        return _outputs(_local(df, [key], value, tie), df.columns, value, prefix)
    few = many <= BROADCAST_KEYS
    known = F.broadcast(hot) if few else hot
    cold = df.join(known, df[key].eqNullSafe(known["_key"]), "left_anti")
    return _outputs(_local(cold, [key], value, tie), df.columns, value, prefix).unionByName(
        _outputs(_hot_places(df, hot, key, value, tie, hot_rows, few), df.columns, value, prefix))


def value_order(score: str | Column) -> Column:
    """Descending order of scores as ``group_rank`` of the negated score has it: NaN after numbers, null last."""
    return (-(F.col(score) if isinstance(score, str) else score)).asc_nulls_last()
