"""Nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (iterative quantization: alternate sign
codes and the orthogonal rotation that fits them) turns vectors into 64-bit
codes.  The index holds every valid vector with its code.  A search cuts codes
into substrings, each with its own table of buckets: by the pigeonhole
principle a code within Hamming radius r agrees with the query's up to
floor(r / substrings) bits in at least one substring, so the buckets within
that many bits hold every code within r.  Their rows are checked against the
full radius and reranked on the original floats.

Every query has a radius of its own.  The sample's codes travel with the search:
a query's radius is the Hamming distance of the sample's k-th nearest code plus
a margin, which covers how much farther in Hamming distance than that
``MARGIN_COVERAGE`` of the sample's true neighbours lie.  Neighbours in the
whole table are nearer than in the sample, so radii err to the wide side, and
k sample rows lie within each: no query is left short.

Queries are searched in blocks of bounded size against all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresight.llm.common import materialize

#: Vectors the rotation and the margin are fitted on, at most (by smallest id hash); all are indexed.
FIT_ROWS = 10_000
FIT_QUERIES = 500
FIT_ROUNDS = 30
BITS = 64
SUBSTRINGS = 4
MARGIN_COVERAGE = 0.98
#: Queries sent to the tasks at once.
QUERY_BLOCK = 4096
#: Rows that are searched together, and queries whose codes are compared with the sample's at a time.
SHARD_ROWS = 8192
QUERY_SLICE = 64
SEED = 2


@dataclass
class Codes:
    """A learned code: ``bits`` signs of rotated, centred vectors; the sample's ids and codes, and the margin."""

    mean: np.ndarray
    projection: np.ndarray
    ids: np.ndarray
    sample: np.ndarray
    margin: int

    @property
    def dim(self) -> int:
        return len(self.mean)

    def encode(self, x: np.ndarray) -> np.ndarray:
        signs = (x - self.mean) @ self.projection > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u8")[:, 0]

    def kth(self, ids: np.ndarray, codes: np.ndarray, k: int) -> np.ndarray:
        """Hamming distance of the k-th nearest sample code of another id; all bits where there is none."""
        out = np.full(len(ids), BITS, dtype=np.int64)
        for a in range(0, len(ids) if len(self.ids) > k else 0, QUERY_SLICE):
            part = slice(a, a + QUERY_SLICE)
            far = np.bitwise_count(codes[part, None] ^ self.sample[None, :]).astype(np.int64)
            far[ids[part, None] == self.ids[None, :]] = BITS
            out[part] = np.partition(far, k - 1, axis=1)[:, k - 1]
        return out

    def radii(self, ids: np.ndarray, codes: np.ndarray, k: int) -> np.ndarray:
        """The search radius of each query."""
        return np.minimum(BITS, self.kth(ids, codes, k) + self.margin)


def fit_codes(ids: np.ndarray, sample: np.ndarray, k: int) -> Codes:
    """Rotation and margin from sample rows (float64)."""
    rng = np.random.default_rng(SEED)
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False) if len(sample) > dim else (None, None, np.eye(dim))
    width = min(dim, BITS)
    flat = centred @ axes[:width].T
    parts = []
    for _ in range(-(-BITS // width)):
        rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(FIT_ROUNDS):
            u, _, vt = np.linalg.svd(np.where(flat @ rotation > 0, 1.0, -1.0).T @ flat)
            rotation = (u @ vt).T
        parts.append(axes[:width].T @ rotation)
    codes = Codes(mean, np.concatenate(parts, axis=1)[:, :BITS], ids, np.empty(0, np.uint64), BITS)
    codes.sample = codes.encode(sample)
    asked = rng.choice(len(sample), min(FIT_QUERIES, len(sample)), replace=False)
    kth = codes.kth(ids[asked], codes.sample[asked], k)
    beyond = []
    for q, limit in zip(asked, kth, strict=True):
        far = ((sample - sample[q]) ** 2).sum(axis=1)
        far[ids == ids[q]] = np.inf
        near = np.argsort(far, kind="stable")[:k]
        beyond.append(np.bitwise_count(codes.sample[near[far[near] < np.inf]] ^ codes.sample[q]).astype(np.int64) - limit)
    beyond = np.concatenate(beyond)
    codes.margin = max(0, int(np.quantile(beyond, MARGIN_COVERAGE, method="higher"))) if len(beyond) else BITS
    return codes


#: All patterns of a substring, by number of bits; ``_UP_TO[p]`` of them have p bits or fewer.
_WIDTH = BITS // SUBSTRINGS
_FLIPS = np.argsort(np.bitwise_count(np.arange(1 << _WIDTH, dtype=np.uint64)), kind="stable")
_UP_TO = [sum(math.comb(_WIDTH, i) for i in range(p + 1)) for p in range(_WIDTH + 1)]


class Substrings:
    """Bucket tables of the codes' substrings for one shard of rows."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for i in range(SUBSTRINGS):
            shift = np.uint64(i * _WIDTH)
            sub = ((codes >> shift) & np.uint64((1 << _WIDTH) - 1)).astype(np.int64)
            rows = np.argsort(sub, kind="stable")
            buckets, starts = np.unique(sub[rows], return_index=True)
            self.tables.append((shift, buckets, np.append(starts, len(rows)), rows))

    def within(self, query: np.uint64, radius: int) -> np.ndarray:
        """Ascending rows: exactly those whose code lies within ``radius`` of the query's.

        Buckets are probed by flipping bits, or picked from the list of those
        in use where they are fewer than the flips: the same buckets.
        """
        probe = min(_WIDTH, radius // SUBSTRINGS)
        seen = np.zeros(len(self.codes), dtype=bool)
        for shift, buckets, starts, rows in self.tables:
            sub = int(query >> shift) & (1 << _WIDTH) - 1
            if _UP_TO[probe] < len(buckets):
                wanted = sub ^ _FLIPS[:_UP_TO[probe]]
                at = np.minimum(np.searchsorted(buckets, wanted), len(buckets) - 1)
                hit = at[buckets[at] == wanted]
            else:
                hit = np.nonzero(np.bitwise_count(buckets ^ sub) <= probe)[0]
            lengths = starts[hit + 1] - starts[hit]
            if len(hit):
                skip = np.repeat(starts[hit] - (np.cumsum(lengths) - lengths), lengths)
                seen[rows[skip + np.arange(len(skip))]] = True
        found = np.nonzero(seen)[0]
        return found[np.bitwise_count(self.codes[found] ^ query) <= radius]


def _valid(vector: Column, dim: int | None = None) -> Column:
    """True for vectors without null or non-finite components that are not all zero."""
    v = vector.cast("array<double>")
    good = F.forall(v, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")) & ~F.isnan(x), F.lit(False)))
    ok = v.isNotNull() & (F.size(v) > 0) & good & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok & (F.size(v) == dim) if dim else ok, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


def _encode(batches: Iterable[pa.RecordBatch], codes: Codes) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            code = codes.encode(_matrix(b.column(1), codes.dim).astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(code.view("<i8")), b.column(1)],
                                             ["vec_id", "code", "vector"])


def _search(batches: Iterable[pa.RecordBatch], codes: Codes, radii: np.ndarray, q_ids: np.ndarray, q_vectors: np.ndarray,
            k: int) -> Iterator[pa.RecordBatch]:
    """The k nearest retrieved rows of this task for each query of the block; floats are read of retrieved rows only."""
    q_codes = codes.encode(q_vectors)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0))] * len(q_ids)

    def shard(ids: np.ndarray, code: np.ndarray, x: np.ndarray) -> None:
        tables = Substrings(code)
        for i, query in enumerate(q_codes):
            rows = tables.within(query, int(radii[i]))
            rows = rows[ids[rows] != q_ids[i]]
            if not len(rows):
                continue
            apart = x[rows] - q_vectors[i]
            score = np.sqrt((apart ** 2).sum(axis=1))
            if len(rows) > k:
                near = score <= np.partition(score, k - 1)[k - 1]
                rows, score = rows[near], score[near]
            all_ids = np.concatenate((best[i][0], ids[rows]))
            all_scores = np.concatenate((best[i][1], score))
            keep = np.lexsort((all_ids, all_scores))[:k]
            best[i] = (all_ids[keep], all_scores[keep])

    held: list[pa.RecordBatch] = []

    def flush() -> None:
        t = pa.Table.from_batches(held).combine_chunks()
        shard(t["vec_id"].to_numpy(), t["code"].to_numpy().view("<u8"),
              _matrix(t["vector"].chunk(0), codes.dim).astype(np.float64))
        held.clear()

    for b in batches:
        for at in range(0, b.num_rows, SHARD_ROWS):
            held.append(b.slice(at, SHARD_ROWS))
            if sum(x.num_rows for x in held) >= SHARD_ROWS:
                flush()
    if held:
        flush()
    counts = [len(i) for i, _ in best]
    if sum(counts):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(q_ids, counts)), pa.array(np.concatenate([i for i, _ in best])),
             pa.array(np.concatenate([s for _, s in best]))], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest retrieved rows of each query row.

    ``queries`` is a condition on ``vectors``; a row never finds its own id.
    ``score`` is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller id.

    Vectors that are null, empty, all zero or hold a null or non-finite
    component take no part, nor do rows with a null id or another dimension
    than the fitted sample's most frequent one.  A query gets fewer than k rows only
    where there are fewer candidates.  Repeated rows are candidates
    of their own; a query id on several rows is searched from the first by
    vector order.  Without valid vectors the result is empty.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"),
                          F.coalesce(queries, F.lit(False)).alias("_query")).filter(F.col("vec_id").isNotNull())
    out = "query_id long, vec_id long, score double"
    # about fit_rows of all by hash, so that tasks send no more than the sample; the limit only trims chance
    usable = rows.filter(_valid(F.col("vector")))
    share = min(1.0, 1.1 * fit_rows / max(1, usable.count()))
    part = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 20)) < math.ceil(share * (1 << 20))
    sample = [(r["vec_id"], r["vector"]) for r in usable.filter(part).select("vec_id", "vector")
              .orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id", "vector").limit(fit_rows).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = [len(v) for _, v in sample]
    dim = max(set(sizes), key=lambda s: (sizes.count(s), -s))
    sample = [(i, v) for i, v in sample if len(v) == dim]
    codes = fit_codes(np.array([i for i, _ in sample], dtype=np.int64), np.array([v for _, v in sample], dtype=np.float64), k)
    valid = rows.filter(_valid(F.col("vector"), dim))
    index = materialize(valid.select("vec_id", "vector").mapInArrow(
        lambda b: _encode(b, codes),
        f"vec_id long, code long, vector {rows.schema['vector'].dataType.simpleString()}"), "mih-index")
    asked = materialize(valid.filter("_query").groupBy("vec_id").agg(F.min("vector").alias("vector")), "mih-queries")
    n_blocks = -(-asked.count() // QUERY_BLOCK)
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = None
    for block in _blocks(asked, n_blocks):
        q_ids = np.array([r["vec_id"] for r in block], dtype=np.int64)
        q_vectors = np.array([r["vector"] for r in block], dtype=np.float64)
        radii = codes.radii(q_ids, codes.encode(q_vectors), k)
        part = index.mapInArrow(lambda b, radii=radii, q_ids=q_ids, q_vectors=q_vectors:
                                _search(b, codes, radii, q_ids, q_vectors, k), out)
        part = materialize(part.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k), "mih-found")
        part = part.select("query_id", "rank", "vec_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found


def _blocks(asked: DataFrame, n_blocks: int) -> Iterator[list]:
    """The queries in blocks of about ``QUERY_BLOCK`` by id hash, one block on the driver at a time."""
    for i in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == i).collect()
        if block:
            yield block
