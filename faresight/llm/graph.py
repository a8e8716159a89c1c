"""Connected components of link tables, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``: long); root is the smallest node reachable.

    Each round hooks every group to its smallest neighbour, follows the hooks
    twice, and contracts the edges; edges inside a group leave.  Minima are
    aggregated map-side, so a node with very many links is one row per task.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = materialize(edges.select("a", "b").filter("a != b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = both(edges).groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        hooks = materialize(hooks, "hooks")
        for _ in range(2):
            onward = hooks.select(F.col("a").alias("to"), F.col("to").alias("onward"))
            hooks = materialize(hooks.join(onward, "to").select("a", F.col("onward").alias("to")), "hooks")
        moved = hooks.withColumnRenamed("a", "root")
        labels = materialize(labels.join(moved, "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")), "labels")
        ends = edges.join(hooks, "a").select("b", F.col("to").alias("ra")).join(
            hooks.select(F.col("a").alias("b"), F.col("to").alias("rb")), "b")
        edges = materialize(ends.filter("ra != rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return labels
