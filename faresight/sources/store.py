"""Stage store (A3, A4): parquet tables between stages and between runs.

Stages live in a folder that driver and executors share: below
``spark.checkpoint.dir`` for a run's own tables, or a path the caller gives
for stages that later runs reuse.  Writing a stage reuses work and cuts
lineage, so a lost executor only recomputes from the last written stage.
"""

from __future__ import annotations

import gc
import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from faresight.session import scratch_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` completely."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def staged(df: DataFrame, name: str, with_path: bool = False):
    """``df`` written to a new path of this run and read again (and the path, for ``drop_stage``)."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    return (read, path) if with_path else read


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage of this run that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go: Spark deletes them once the driver's collector has found their
    plans unused, which with a large heap is long after the work.  Call where a stage has been written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


MANIFEST = "_manifest"


def fingerprint(spark: SparkSession, inputs: list[str], parameters: dict | None = None) -> str:
    """Digest of the files below ``inputs`` (path, length, time of change) and of the parameters."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for path in inputs:
        place = jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(conf).listFiles(place, True)
        while found.hasNext():
            f = found.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps([sorted(files), parameters or {}], sort_keys=True, default=str).encode()).hexdigest()


def _read_manifest(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, path: str, digest: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    stream.writeUTF(digest)
    stream.close()


def load_or_build(spark: SparkSession, path: str, build, required: list[str] | None = None, partition_by: list[str] | None = None,
                  inputs: list[str] | None = None, parameters: dict | None = None) -> DataFrame:
    """The stage at ``path`` if it was written, has the ``required`` columns and, where ``inputs`` or
    ``parameters`` are given, was built from the same files and parameters; otherwise ``build()``,
    written there with its manifest and read back (A4)."""
    digest = fingerprint(spark, inputs or [], parameters) if inputs is not None or parameters is not None else None
    if exists(spark, path) and (digest is None or _read_manifest(spark, path) == digest):
        df = spark.read.parquet(path)
        if set(required or ()) <= set(df.columns):
            return df
    write_stage(build(), path, partition_by)
    if digest:
        _write_manifest(spark, path, digest)
    return spark.read.parquet(path)
