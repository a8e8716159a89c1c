"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard.  At each level every child of the
chosen node draws -ln(u) / weight, u being a hash of the row's key and the
child's name, and the smallest draw wins: a child wins in proportion to its
weight, and a changed weight moves rows only to or from that child.  So a new
shard, or a changed weight, moves rows only between subtrees whose weights
change.  A node's weight is the sum of its shards' weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faresight.llm.common import bucketed_starts, materialize

#: Fixed shape of the registered query: shards per rack, racks per region.
SHARDS_PER_RACK = 5
RACKS_PER_REGION = 2
ROW_OVERHEAD = 16
BUCKETS = 1024
SEED = 9


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree: shard number, its place and its weight."""

    number: int
    region: int
    rack: int
    weight: float = 1.0


def uniform_tree(shards: int) -> list[Shard]:
    """``shards`` equal shards, filled rack by rack and region by region."""
    return [Shard(i, i // (SHARDS_PER_RACK * RACKS_PER_REGION), i // SHARDS_PER_RACK) for i in range(shards)]


def _draw(key: Column, level: str, node: int, weight: float) -> Column:
    h = F.xxhash64(key, F.lit(f"{level}{node}"))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(node).alias("node"))


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    draws = [_draw(key, level, n, w) for n, w in sorted(weights.items()) if w > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["node"]


def _choose(node: Column, below: dict[int, Column]) -> Column:
    out = None
    for n, c in sorted(below.items()):
        out = F.when(node == n, c) if out is None else out.when(node == n, c)
    return out


def descend(key: Column, tree: Sequence[Shard]) -> Column:
    """Shard number of ``key`` as int: region, then rack, then shard."""
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    leaves: dict[int, dict[int, float]] = {}
    for s in tree:
        regions[s.region] = regions.get(s.region, 0.0) + s.weight
        racks.setdefault(s.region, {})
        racks[s.region][s.rack] = racks[s.region].get(s.rack, 0.0) + s.weight
        leaves.setdefault(s.rack, {})[s.number] = s.weight
    if len({s.number for s in tree}) != len(tree) or any(s.weight < 0 for s in tree) or sum(regions.values()) <= 0:
        raise ValueError("shard numbers must differ, weights must not be negative or all zero")
    region = _winner(key, "region", regions)
    rack = _choose(region, {r: _winner(key, "rack", kids) for r, kids in racks.items() if sum(kids.values()) > 0})
    return _choose(rack, {k: _winner(key, "shard", kids) for k, kids in leaves.items()
                          if sum(kids.values()) > 0}).cast("int")


def shard_documents(docs: DataFrame, tree: Sequence[Shard], grown: Sequence[Shard] | None = None,
                    id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: its shard, its slot there, and the shard in ``grown``.

    Returns ``id_col, size, text_crc32, law, shard, slot, grown_shard``.  Only
    ``id_col`` and ``seed`` decide the shard (law ``key``).  ``size`` is the
    text's UTF-8 bytes plus 16, ``text_crc32`` their unsigned CRC-32 (null text:
    no bytes, CRC 0).  ``slot`` numbers a shard's rows from 0 without gaps, by
    hash bucket, id and CRC.

    A null id is a key like any other; rows with equal ids share a shard; empty
    tables give empty results; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), F.lit(seed))
    placed = materialize(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("_key"))
        .select("*", descend(F.col("_key"), tree).alias("shard"),
                (descend(F.col("_key"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
                F.pmod("_key", F.lit(BUCKETS)).cast("int").alias("_bucket"), F.lit(1).cast("long").alias("_one")),
        "shards")
    numbered = bucketed_starts(placed, ["shard"], "_bucket",
                               [F.col("_id"), F.col("text_crc32"), F.col("size")], "_one", "slot")
    return numbered.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"),
                           "shard", "slot", "grown_shard")
