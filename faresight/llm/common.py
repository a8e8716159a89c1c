"""Helpers shared by the operators: words, stage tables, bucketed prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.session import checkpoint_dir

#: Word separators of the contracts: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/faresight-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts lineage: a lost executor recomputes from the written files, and a
    frame used several times is computed once.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``; null text has none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(trimmed == "", empty).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as long."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, SPACE_CLASS + "+"))).cast("long")


def bucketed_starts(df: DataFrame, group: list[str], bucket: str, order: list[Column],
                    value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` inside each ``group``, as column ``out``.

    Order: ``bucket``, then ``order``.  No window holds a whole group: sums run
    inside (group, bucket), and the buckets' own totals are summed before them
    (one row per bucket).  ``group`` and ``bucket`` must not be null; ``df`` is
    read twice, so hand over a written table.
    """
    total, base = f"_{out}_total", f"_{out}_base"
    bases = (df.groupBy(*group, bucket).agg(F.sum(value).alias(total))
             .withColumn(base, F.coalesce(F.sum(total).over(
                 Window.partitionBy(*group).orderBy(bucket)
                 .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .drop(total))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    return (df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(bases, [*group, bucket])
            .withColumn(out, F.col(out) + F.col(base)).drop(base))
