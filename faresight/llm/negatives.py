"""Hard negatives by lists shared among the anchors of a cluster (MAXIMUS).

Anchors are clustered by direction.  For a cluster with centroid c whose
members lie within an angle t of it, every member a and candidate x obey
``a.x <= |a| |x| cos(max(0, angle(c, x) - t))``.  So a shard of candidates is
sorted once per cluster by that bound, and every member walks the one list
until the bound certifies that nothing later can enter its result.

Vectors are scaled to integers and scores are integer inner products, exact in
any order.  Two walks: the first finds each anchor's positives, the second
takes, for each positive, candidates of other labels inside its score band.
Anchors go to the tasks in blocks of bounded size, each against all rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresight.llm.common import materialize

# ship this module's functions by value: executors need only numpy and pyarrow
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Components are scaled by this and rounded down (fixed by the contract).
SCALE = 256
#: A negative's score is at least so many hundredths of the positive's, and not above it.
LEAST_PERCENT = 80
#: Anchors sent to the tasks at once, members of a cluster on average, rounds of clustering.
ANCHOR_BLOCK = 2_048
CLUSTER_ANCHORS = 32
CLUSTER_ROUNDS = 8
#: Candidates sorted together, and the part of a list that is scored at a time.
SHARD_ROWS = 8_192
STEP = 256
#: Scaled vectors longer than this have no 64-bit score with themselves.
LARGEST_SQUARE = 1 << 62
EXACT = float(1 << 53)
LOWEST = -(1 << 63)
SEED = 13


@dataclass
class Walkers:
    """Walks over candidates: each looks for the ``k`` highest scores within ``low`` and ``high``, among rows
    of its anchor's label (``same``) or of other labels."""

    anchor: np.ndarray
    key: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    cluster: np.ndarray

    def __len__(self) -> int:
        return len(self.anchor)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero ones stay zero) and lengths."""
    size = np.sqrt((x * x).sum(axis=1))
    return x / np.where(size > 0, size, 1.0)[:, None], size


def clusters(x: np.ndarray) -> np.ndarray:
    """Cluster of each anchor: spherical k-means from seeded anchors."""
    unit, _ = directions(x)
    n = max(1, len(x) // CLUSTER_ANCHORS)
    centre = unit[np.random.default_rng(SEED).choice(len(x), n, replace=False)]
    for _ in range(CLUSTER_ROUNDS):
        own = np.argmax(unit @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, unit)
        moved, size = directions(total)
        centre = np.where(size[:, None] > 0, moved, centre)
    return np.argmax(unit @ centre.T, axis=1)


def shared_list(members: np.ndarray, candidates: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by descending bound on their score with any member of length 1, and the bounds.

    ``members`` and ``candidates`` are unit vectors, ``lengths`` those of the candidates."""
    centre, _ = directions(members.sum(axis=0, keepdims=True))
    slack = 1e-7
    spread = np.arccos(np.clip(members @ centre[0], -1, 1)).max() + slack
    angle = np.arccos(np.clip(candidates @ centre[0], -1, 1))
    bound = lengths * np.cos(np.clip(angle - spread, 0, np.pi)) + slack * (1 + lengths)
    if not centre.any():  # members that cancel out: only the length bounds a score
        bound = lengths * (1 + slack)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class Found:
    """The k best (score, row id, label) of each walk; equal scores by ascending id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.best: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.floor = np.full(n, LOWEST, dtype=np.int64)

    def add(self, walk: int, scores: np.ndarray, ids: np.ndarray) -> None:
        best = sorted([*self.best[walk], *zip((-scores).tolist(), ids.tolist(), strict=True)])[:self.k]
        self.best[walk] = best
        if len(best) == self.k:
            self.floor[walk] = -best[-1][0]


def walk_shard(w: Walkers, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, found: Found) -> int:
    """All walks over one shard of candidates (scaled integers); the number of scores computed."""
    unit, lengths = directions(x.astype(np.float64))
    a_unit, a_lengths = directions(w.vector.astype(np.float64))
    exact = float(lengths.max(initial=0.0)) * float(a_lengths.max(initial=0.0)) < EXACT / 2
    rows, anchors = (x.astype(np.float64), w.vector.astype(np.float64)) if exact else (x, w.vector)
    scored = 0
    for c in np.unique(w.cluster):
        walks = np.flatnonzero(w.cluster == c)
        order, bound = shared_list(a_unit[walks], unit, lengths)
        for at in range(0, len(order), STEP):
            # certified: no later score can reach what a walk still takes
            need = np.maximum(w.low[walks], found.floor[walks])
            most = a_lengths[walks] * bound[at] + 1e-6 * (1 + a_lengths[walks] * abs(bound[at]))
            walks = walks[(most >= need) & (w.high[walks] >= w.low[walks])]
            if not len(walks):
                break
            part = order[at:at + STEP]
            scores = (anchors[walks] @ rows[part].T).astype(np.int64)
            scored += scores.size
            equal = labels[part][None, :] == w.label[walks][:, None]
            good = (equal == w.same) & (ids[part][None, :] != w.anchor[walks][:, None])
            good &= (scores <= w.high[walks][:, None]) & (scores >= np.maximum(w.low[walks], found.floor[walks])[:, None])
            for j in np.flatnonzero(good.any(axis=1)):
                at_ = np.flatnonzero(good[j])
                found.add(walks[j], scores[j, at_], ids[part][at_])
    return scored


def _walk_batches(batches: Iterable[pa.RecordBatch], w: Walkers, k: int, dim: int) -> Iterator[pa.RecordBatch]:
    """(anchor, key, score, id): the k best of this task for each walk."""
    found, held = Found(len(w), k), []

    def flush() -> None:
        t = pa.Table.from_batches(held).combine_chunks()
        walk_shard(w, t["id"].to_numpy(), t["label"].to_numpy(),
                   t["vector"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), found)
        held.clear()

    for b in batches:
        at = 0
        while at < b.num_rows:
            held.append(b.slice(at, SHARD_ROWS - sum(x.num_rows for x in held)))
            at += held[-1].num_rows
            if sum(x.num_rows for x in held) == SHARD_ROWS:
                flush()
    if held:
        flush()
    out = [(int(w.anchor[i]), int(w.key[i]), -s, x) for i, best in enumerate(found.best) for s, x in best]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["anchor", "key", "score", "id"])


# ------------------------------------------------------------------ Spark jobs
def _scaled(vector: Column) -> Column:
    """floor(256 x) of every component in doubles, as longs."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(SCALE))).cast("long"))


def usable_rows(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``id, label, vector``: one row per id, labels moved where the contract moves them, vectors scaled.

    Left out are rows with a null id, label or vector, an empty vector, a null
    or non-finite component, a vector whose square, scaled, reaches 2^62, or
    another length than most rows have.  Of rows with equal ids the first by
    label and vector stays."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False)))
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x * F.lit(float(SCALE ** 2)))
    label = F.col(label_col).cast("long")
    moved = F.when(F.col(id_col) % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    good = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce((F.size(v) > 0) & finite, F.lit(False)))
    good = good.filter(F.coalesce(square < float(LARGEST_SQUARE), F.lit(False)))
    rows = materialize(good.select(F.col(id_col).cast("long").alias("id"), moved.alias("label"), _scaled(F.col(vector_col)).alias("vector"))
                       .groupBy("id").agg(F.min(F.struct("label", "vector")).alias("_first")).select("id", "_first.*"), "negatives-rows")
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    return rows.filter(F.size("vector") == (most["dim"] if most else 0))


def _walk(rows: DataFrame, w: Walkers, k: int, dim: int) -> DataFrame:
    best = Window.partitionBy("anchor", "key").orderBy(F.desc("score"), "id")
    found = rows.mapInArrow(lambda b: _walk_batches(b, w, k, dim), "anchor long, key long, score long, id long")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 5, id_col: str = "vec_id",
                   label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``vectors``.  An anchor's positives are its
    ``n_positives`` other rows of the same label with the highest scores; for
    each, the ``n_negatives`` highest rows of other labels whose score is at
    most the positive's and at least ``LEAST_PERCENT`` hundredths of it, all if
    fewer; ties by smaller id.  A negative positive score has an empty band.
    ``usable_rows`` says which rows take part.  A zero vector takes part with
    score 0.  Empty tables give no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = usable_rows(vectors, id_col, label_col, vector_col)
    asked = (rows.join(vectors.filter(F.coalesce(anchors, F.lit(False))).select(F.col(id_col).cast("long").alias("id")).distinct(),
                       "id", "left_semi"))
    asked = materialize(asked, "negatives-anchors")
    found = None
    n_blocks = -(-asked.count() // ANCHOR_BLOCK)
    for i in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == i).orderBy("id").collect()  # about a block
        if not block:
            continue
        ids, labels = np.array([r["id"] for r in block]), np.array([r["label"] for r in block])
        x = np.array([r["vector"] for r in block], dtype=np.int64)
        own, nothing, dim = clusters(x.astype(np.float64)), np.zeros(len(ids), dtype=np.int64), x.shape[1]
        walks = Walkers(ids, nothing, labels, x, np.full(len(ids), LOWEST), np.full(len(ids), (1 << 63) - 1), True, own)
        positives = _walk(rows, walks, n_positives, dim).collect()  # n_positives rows per anchor of the block
        if not positives:
            continue
        positives.sort(key=lambda r: (r["anchor"], r["rank"]))
        place = np.searchsorted(ids, [r["anchor"] for r in positives])
        score = np.array([r["score"] for r in positives], dtype=np.int64)
        low = -((-LEAST_PERCENT * score) // 100)  # rounded up
        key = np.array([r["id"] for r in positives], dtype=np.int64)
        negatives = _walk(rows, Walkers(ids[place], key, labels[place], x[place], low, score, False, own[place]), n_negatives, dim)
        scores = spark.createDataFrame([(r["anchor"], r["id"], r["score"]) for r in positives], "anchor long, key long, positive_score long")
        part = materialize(negatives.join(scores, ["anchor", "key"]).select(
            F.col("anchor").alias("anchor_id"), F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")), "negatives-found")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], OUT) if found is None else found


#: The registered query in SQL for DuckDB, over a table ``embeddings`` with one row per id.
ORACLE_SQL = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
WHERE rank <= 5"""
