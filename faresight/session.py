"""Session helpers.

The library never creates a session behind the caller's back in library
code; ``get_session`` is for tests, the bench and command-line use.  Lineage
cuts go to ``spark.checkpoint.dir`` taken from the session; a directory is
only chosen here when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "faresight", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


#: Bytes of a method beyond which the JVM interprets it (its limit for compilation).
METHOD_BYTES = 8_000


def compiled_methods(spark: SparkSession) -> None:
    """Run stages whose generated method the JVM would only interpret without whole-stage code.

    The wide projections of the option table become methods several times that size; Spark's own
    limit lets them pass.  Results do not depend on it."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")) > METHOD_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stages.

    Uses the directory set on the SparkContext or ``spark.checkpoint.dir``.
    Only a local session, as in tests, gets a temporary folder when neither is
    set; on a cluster that would be a folder the executors do not share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="faresight-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written stage tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "stages", name)
