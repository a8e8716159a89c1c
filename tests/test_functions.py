"""Edge semantics of the column expressions (FIXTURES.md §3)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from faresight.functions.aggregates import guarded_corr
from faresight.functions.scalar import (clip, iso_weekday, lead_days, normalise_programme,
                                        parse_duration_minutes, parse_ts, row_mean, row_min)


def test_durations(spark):
    vals = [None, "", "07:25:00", "00:00:30", "00:01:30", "1.00:30:00", "2.09:45:00", "bad", "7:25"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    got = [r.m for r in df.select(parse_duration_minutes("d").alias("m")).collect()]
    assert got == [0, 0, 445, 0, 1, 1470, 3465, 0, 0]


def test_negative_lead_truncates_toward_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 3, 0, 0), "2020-01-01T12:00:00")], "r timestamp_ntz, d string")
    assert df.select(lead_days(parse_ts("d"), "r").alias("x")).first().x == -1


def test_iso_weekday_and_weekend_from_friday(spark):
    days = ["2024-01-04T10:00:00", "2024-01-05T10:00:00", "2024-01-06T10:00:00", "2024-01-07T10:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    wd = [r.w for r in df.select(iso_weekday(parse_ts("d")).alias("w")).collect()]
    assert wd == [4, 5, 6, 7]
    assert [int(w >= 5) for w in wd] == [0, 1, 1, 1]


def test_programme_normalisation(spark):
    vals = [None, "", "C01", "C01/C02", "- ЮТэйр ЗАО/C01"]
    df = spark.createDataFrame([(v,) for v in vals], "p string")
    assert [r.x for r in df.select(normalise_programme("p").alias("x")).collect()] == ["", "", "C01", "C01/C02", "UT/C01"]


def test_horizontal_and_clip_keep_nulls(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 3)], "a int, b int")
    rows = df.select(row_min(["a", "b"]).alias("mn"), row_mean(["a", "b"]).alias("mean"),
                     clip(F.col("b"), 0, 2).alias("c")).collect()
    assert [(r.mn, r.mean, r.c) for r in rows] == [(None, None, None), (1, 1.0, None), (1, 2.0, 2)]


def test_guarded_corr(spark):
    const = spark.createDataFrame([(1, 5.0, 1.0), (1, 5.0, 2.0), (1, 5.0, 3.0)], "g int, x double, y double")
    single = spark.createDataFrame([(1, 5.0, 1.0)], "g int, x double, y double")
    line = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, 4.0), (1, 3.0, 6.0)], "g int, x double, y double")
    assert math.isnan(const.groupBy("g").agg(guarded_corr("x", "y").alias("c")).first().c)
    assert math.isnan(single.groupBy("g").agg(guarded_corr("x", "y").alias("c")).first().c)
    assert abs(line.groupBy("g").agg(guarded_corr("x", "y").alias("c")).first().c - 1.0) < 1e-12
