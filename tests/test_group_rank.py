"""group_rank: slices must give what one window over the whole group gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from faresight.operators.group_rank import _splitters, group_rank
from faresight.operators.split import session_assignment
from faresight.sources.store import staged


def _plain(df, key, value, tie):
    w, v = Window.partitionBy(key), F.col(value)
    return df.select("*", F.when(v.isNotNull(), F.rank().over(w.orderBy(v.asc_nulls_last()))).alias("g_rank"),
                     F.when(v.isNotNull(), F.row_number().over(w.orderBy(v.asc_nulls_last(), tie))).alias("g_ordinal"),
                     F.count(v).over(w).alias("g_count"), F.min(v).over(w).alias("g_min"))


def _differences(df, key, value, tie, **kw):
    a = group_rank(df, key, value, tie, **kw)
    return a.exceptAll(_plain(df, key, value, tie).select(*[F.col(c).cast(t) for c, t in a.dtypes])).count()


@pytest.mark.parametrize("hot_rows", [None, 5000])
def test_hot_key_with_extra_columns(spark, hot_rows):
    """400,000 rows, 70 % in one key, a hot null key, equal values, infinities and NaN."""
    n = F.col("id")
    h = F.pmod(F.xxhash64("id"), F.lit(1000003))
    value = (F.when(h % 41 == 0, None).when(h % 997 == 0, float("inf")).when(h % 991 == 0, float("-inf"))
             .when(h % 983 == 0, float("nan")).when(h % 5 == 0, F.lit(125.5)).when(h % 3 == 0, -(h % 5000) / 7.0)
             .otherwise(F.exp((h % 100000) / 7000.0)))
    key = F.when(n % 10 < 7, "hot").when(n % 10 < 9, None).otherwise(F.concat(F.lit("k"), h % 5000))
    df = staged(spark.range(400_000).select(F.col("id").alias("Id"), key.alias("key"), value.cast("double").alias("v"),
                                            F.sha2(n.cast("string"), 256).alias("extra"), F.lit("x").alias("_m")), "ranks")
    assert _differences(df, "key", "v", "Id", hot_rows=hot_rows) == 0


def test_equal_values_of_a_hot_key_spread(spark):
    """400,000 equal values of one key: slices by the tie, ranks of the whole, no slice near the whole."""
    df = staged(spark.range(400_000).selectExpr("id AS Id", "'all' AS key", "IF(id % 100 = 3, 2.0D, 1.0D) AS v"), "equal")
    assert _differences(df, "key", "v", "Id") == 0
    hot = spark.createDataFrame([("all", 400_000)], "_key string, _n long")
    cuts = _splitters(df, hot, "key", "v", "Id", 100_000).first()["_cuts"]
    edges = [0, *[c["t"] for c in cuts if c["v"] == 1.0], 400_000]
    assert len(cuts) >= 5 and max(b - a for a, b in zip(edges, edges[1:])) < 150_000


def test_keys_that_are_all_null_or_repeated(spark):
    df = spark.createDataFrame([(i % 50, "a" if i % 3 else "b", None if i % 3 == 0 else 1.0) for i in range(600)], "Id long, key string, v double")
    a = group_rank(df, "key", "v", "Id", hot_rows=40)
    got = sorted((r.key, r.g_ordinal) for r in a.filter("v IS NOT NULL").collect())
    assert got == [("a", i) for i in range(1, 401)]
    assert {(r.g_rank, r.g_count, r.g_min) for r in a.filter("v IS NULL").collect()} == {(None, 0, None)}


def test_strings_and_integers(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, "", "a", "aa", "ab", "é", "zz" * rnd.randint(1, 3)]),
             rnd.choice([None, 0, -5, 5, rnd.randint(-10**12, 10**12)])) for i in range(500)]
    df = spark.createDataFrame(rows, "Id long, key string, s string, n long")
    for hot_rows in (None, 60):
        assert _differences(df, "key", "s", "Id", hot_rows=hot_rows) == 0
        assert _differences(df, "key", "n", "Id", hot_rows=hot_rows) == 0


def test_rank_semantics(spark):
    df = spark.createDataFrame([(1, "s", 10.0), (2, "s", 10.0), (3, "s", 20.0), (4, "s", 20.0),
                                (5, "s", None)], "Id long, key string, v double")
    out = {r.Id: r for r in group_rank(df, "key", "v", "Id").collect()}
    assert [out[i].g_rank for i in range(1, 6)] == [1, 1, 3, 3, None]
    assert [out[i].g_ordinal for i in range(1, 6)] == [1, 2, 3, 4, None]
    assert out[1].g_count == 4 and out[5].g_min == 10.0


def test_small_keys_take_one_shuffle(spark):
    df = staged(spark.range(1000).selectExpr("id AS Id", "id % 200 AS key", "double(id) AS v"), "small")
    plan = group_rank(df, "key", "v", "Id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_split_of_a_heavy_bin(spark):
    """All 200,000 sessions fall into one size bin; the first ceil(20 %) by hash are test."""
    df = spark.range(200_000).selectExpr("concat('S', id) AS ranker_id")
    got = session_assignment(df)
    h = F.md5(F.concat(F.col("ranker_id"), F.lit("|42")))
    rn = F.row_number().over(Window.orderBy(h, "ranker_id"))
    want = df.select("ranker_id", (rn <= 40_000).alias("is_test"))
    assert got.select("ranker_id", "is_test").exceptAll(want).count() == 0
