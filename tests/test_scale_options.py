"""Steps over all options: what is written, and that the short ways give what the long ones gave."""

import datetime

from pyspark.sql import functions as F

from faresight.functions.scalar import parse_duration_minutes
from faresight.operators import profile
from faresight.sources import binding


def test_missing_profile_sums_patterns_not_rows(spark):
    rows = [(i, None if i % 3 == 0 else "" if i % 3 == 1 else "x", None if i % 2 else 1.5) for i in range(600)]
    fields = ", ".join(f"a{i} int" for i in range(70))
    df = spark.createDataFrame(rows, "id long, t string, v double").select(
        "*", *[F.when(F.col("id") < 600 - i, i).cast("int").alias(f"a{i}") for i in (0, 300)], F.from_json(F.lit("{}"), fields).alias("s"),
        F.lit("").alias("blank"), F.lit(None).cast("string").alias("none")).select("id", "t", "v", "a0", "a300", "s.*", "blank", "none")
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    patterns, _ = profile.missing_patterns(df)
    assert patterns.agg(F.sum("n")).first()[0] == 600 and patterns.count() == 12
    found = {r["column"]: (r["null_count"], r["empty_count"], r["missing_percentage"]) for r in profile.missing_profile(df).collect()}
    want = {c: (df.filter(F.col(c).isNull()).count(), df.filter(F.col(c) == "").count() if kind == "string" else 0)
            for c, kind in df.dtypes if c in ("c0", "c1", "c2", "c3", "c4", "c5", df.columns[-3], df.columns[-2], df.columns[-1])}
    assert {c: found[c][:2] for c in want} == want and len(found) == len(df.columns)
    assert found["c1"][2] == 66.67


def test_missing_profile_of_no_rows(spark):
    got = profile.missing_profile(spark.createDataFrame([], "t string, v double")).collect()
    assert [tuple(r)[2:] for r in got] == [(None, 0, None, None)] * 2


def test_option_times_equal_the_formatter(spark):
    times = [None, *[datetime.datetime(*x) for x in ((1, 1, 1), (999, 12, 31, 23, 59, 59), (1000, 1, 1), (1996, 2, 29, 5, 6, 7, 8),
                                                     (2024, 10, 10, 10, 10, 10), (9999, 12, 31, 23, 59, 59, 999999))]]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").withColumn("late", F.timestamp_add("YEAR", F.lit(9000), "t"))
    for c in ("t", "late"):
        got = df.select(binding._iso(F.col(c)).alias("a"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]


def test_durations_with_days_line_ends_and_halves(spark):
    want = {"01:02:03": 62, "00:00:30": 0, "00:00:31": 1, "00:00:89": 1, "00:00:90": 2, "12.23:59:31": 18720, "001.01:02:45": 1503,
            "3.01:02:03\n": 4382, "01:02:03\r\n": 62, "01:02:03 ": 0, "01:02:03\n\n": 0, "99999999999.01:02:03": 62,
            "1:02:03": 0, ".01:02:03": 0, "01.02:03": 0, "1.1.01:02:03": 0, " 01:02:03": 0, "": 0}
    df = spark.createDataFrame([(x,) for x in want], "c string").select("c", parse_duration_minutes("c").alias("m"))
    assert {r["c"]: r["m"] for r in df.collect()} == want and not df.schema["m"].nullable
