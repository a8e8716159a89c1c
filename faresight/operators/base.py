"""Typed base view: parse text timestamps and durations once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.functions.scalar import parse_duration_minutes, parse_ts


def add_trip_duration(df: DataFrame) -> DataFrame:
    """leg0 / leg1 / trip duration in minutes (never null)."""
    if "trip_duration_minutes" in df.columns:
        return df
    l0 = parse_duration_minutes("legs0_duration")
    l1 = parse_duration_minutes("legs1_duration")
    return df.select("*", l0.alias("leg0_duration_minutes"), l1.alias("leg1_duration_minutes"),
                     (l0 + l1).alias("trip_duration_minutes"))


def add_parsed_times(df: DataFrame) -> DataFrame:
    """``_dep0 _arr0 _dep1 _arr1``: leg times as TIMESTAMP_NTZ."""
    if "_dep0" in df.columns:
        return df
    return df.select("*", parse_ts("legs0_departureAt").alias("_dep0"),
                     parse_ts("legs0_arrivalAt").alias("_arr0"),
                     parse_ts("legs1_departureAt").alias("_dep1"),
                     parse_ts("legs1_arrivalAt").alias("_arr1"))


def percentile_in_session(rank, count, single_row: float) -> "F.Column":
    """(rank_min − 1)/(n − 1)·100; null price → 50; a lone priced row → ``single_row``
    (the reference yields NaN there, its stated intent is 50)."""
    return (F.when(rank.isNull(), F.lit(50.0))
             .when(count == 1, F.lit(single_row))
             .otherwise((rank - 1) / (count - 1) * 100.0))


def nearest_tier(rank, count, qs=(0.25, 0.5, 0.75)) -> "F.Column":
    """Tier 1..4 of a value against its group's nearest-rank quartiles.

    ``value <= q`` ⟺ ``rank_min(value) <= round((n−1)·q) + 1``, so the tier
    follows from the value's rank in its group without joining a quantile
    table back.  Null values fall to the last tier like in the reference."""
    expr = None
    for i, q in enumerate(qs, start=1):
        cond = rank <= F.round((count - 1) * q) + 1
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(qs) + 1))
