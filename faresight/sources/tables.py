"""Parquet table access (A1, A2).  Scans are lazy; Catalyst prunes columns and
pushes filters into the parquet reader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)

