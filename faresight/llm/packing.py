"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens.  Each turn gives a queue a
quantum of ``QUANTUM`` tokens; the next turn goes to the queue that is
furthest behind its target share, so a window is filled to the target
proportions up to a quantum, and what a queue is behind (its deficit) is
carried to the next window, over partitions as well.  Quantum j of a queue
with share p falls due at virtual time (j + 1/2) / p, so its turn is the number
of quanta of all queues that fall due earlier: arithmetic on totals instead of
a loop over windows.  Any task can place any document from its start in its
queue, and no window waits for the one before it.

A queue's order is its documents' order in the read table: a document's start
is its start in its partition plus the totals of the partitions before.  The
driver gets one total per source.  Tokens are written once to the shared folder and
cut into pieces where they lie.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresight.llm import tokens
from faresight.llm.common import materialize

WINDOW = 2048
QUANTUM = 256
END_ID = 1
_IDS_SCHEMA = "doc_id long, source string, source_null boolean, part int, start_in_part long, doc_tokens long, ids binary"
_PIECE_SCHEMA = ("doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                 "sequence_id long, offset long")
#: Rows per Arrow batch of encoded documents; bounds a worker's memory together with the batch it came from.
_BATCH_BYTES = 8 << 20


class Turns:
    """Places of all quanta for queues with given token totals and target shares."""

    def __init__(self, totals: Sequence[int], shares: Sequence[float], quantum: int):
        self.quantum = quantum
        self.totals = np.asarray(totals, dtype=np.int64)
        self.quanta = -(-self.totals // quantum)
        share = np.asarray(shares, dtype=np.float64)
        if (share <= 0).any() and len(share):
            raise ValueError("target shares must be positive")
        self.share = share / share.sum() if len(share) else share
        #: due time of each queue's last quantum, and the ids missing from that one
        self.last = (self.quanta - 0.5) / self.share
        self.short = self.quanta * quantum - self.totals

    def position(self, queue: int, j: np.ndarray) -> np.ndarray:
        """Global position of the first id of quanta ``j`` of ``queue``."""
        due = (j + 0.5) / self.share[queue]
        turn = np.zeros(len(j), dtype=np.int64)
        short = np.zeros(len(j), dtype=np.int64)
        for q in range(len(self.totals)):
            if q == queue:
                turn += j
                continue
            # quanta of q due before, an equal due time counts for the earlier queue
            guess = np.floor(due * self.share[q] - 0.5).astype(np.int64)
            count = np.maximum(guess - 1, 0)
            for _ in range(4):
                t = (count + 0.5) / self.share[q]
                count += (t < due) | ((t == due) & (q < queue))
            turn += np.minimum(count, self.quanta[q])
            before = (self.last[q] < due) | ((self.last[q] == due) & (q < queue))
            short += np.where(before, self.short[q], 0)
        return turn * self.quantum - short

    def pieces(self, queue: np.ndarray, start: np.ndarray, length: np.ndarray,
               window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(span, start in the span, length, global position) of spans, cut at windows.

        Span i holds ids ``start[i]`` to ``start[i] + length[i]`` (at least one) of its queue.
        Pieces come span by span, each in order; neighbours in one window are joined.
        """
        q = self.quantum
        first, last = start // q, (start + length - 1) // q
        counts = last - first + 1
        span = np.repeat(np.arange(len(start)), counts)
        j = first[span] + np.arange(len(span)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.empty(len(span), dtype=np.int64)
        for one in np.unique(queue):
            mine = queue[span] == one
            at[mine] = self.position(int(one), j[mine])
        a = np.maximum(start[span], j * q)
        n = np.minimum((start + length)[span], (j + 1) * q) - a
        pos, a = at + a - j * q, a - start[span]
        done = []
        while len(n):
            fit = np.minimum(n, window - pos % window)
            done.append((span, a, fit, pos))
            more = n > fit
            span, a, n, pos = span[more], (a + fit)[more], (n - fit)[more], (pos + fit)[more]
        span, a, n, pos = (np.concatenate(c) for c in zip(*done, strict=True))
        order = np.lexsort((a, span))
        span, a, n, pos = span[order], a[order], n[order], pos[order]
        new = np.ones(len(span), dtype=bool)
        new[1:] = (span[1:] != span[:-1]) | (pos[1:] != pos[:-1] + n[:-1]) | (pos[1:] % window == 0)
        heads = np.nonzero(new)[0]
        return span[heads], a[heads], np.add.reduceat(n, heads), pos[heads]


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    enc = tokens.encoder(vocabulary, tokens.word_parts)
    end, size = np.array([end_id], dtype=enc.dtype).tobytes(), enc.dtype.itemsize
    part = TaskContext.get().partitionId()
    at: dict[str | None, int] = {}

    def flush(rows):
        cols = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = ("doc_id", "source", "source_null", "part", "start_in_part", "doc_tokens", "ids")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    for batch in batches:
        rows, held = [], 0
        for doc_id, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                        batch.column(2), strict=True):
            raw = enc.encode(text.as_py() or "") + end
            n = len(raw) // size
            rows.append((doc_id, source or "", source is None, part, at.get(source, 0), n, raw))
            at[source] = at.get(source, 0) + n
            held += len(raw)
            if held >= _BATCH_BYTES:
                yield flush(rows)
                rows, held = [], 0
        if rows:
            yield flush(rows)


def _cut(batches: Iterator[pa.RecordBatch], sources: dict, turns: Turns, window: int, id_type: str) -> Iterator[pa.RecordBatch]:
    size = np.dtype(id_type).itemsize
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {c: batch.column(batch.schema.get_field_index(c)) for c in
                ("doc_id", "source", "source_null", "start_in_part", "base", "doc_tokens", "ids")}
        names = [None if null else s for s, null in
                 zip(cols["source"].to_pylist(), cols["source_null"].to_pylist(), strict=True)]
        tokens_of = cols["doc_tokens"].to_numpy()
        start = cols["base"].to_numpy() + cols["start_in_part"].to_numpy()
        span, a, n, pos = turns.pieces(np.array([sources[s] for s in names]), start, tokens_of, window)
        raw = np.frombuffer(b"".join(cols["ids"].to_pylist()), dtype=f"<u{size}").astype("<u4")
        view = memoryview(raw).cast("B")
        begin = (np.cumsum(tokens_of) - tokens_of)[span] + a
        crc = [zlib.crc32(view[x:y]) for x, y in zip((begin * 4).tolist(), ((begin + n) * 4).tolist(), strict=True)]
        pick = pa.array(span)
        yield pa.RecordBatch.from_arrays(
            [cols["doc_id"].take(pick), pa.array(names, pa.string()).take(pick), pa.array(a), pa.array(n),
             pa.array(crc, pa.int64()), cols["doc_tokens"].take(pick), pa.array(pos // window), pa.array(pos % window)],
            ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", source_col: str = "source",
                   text_col: str = "text", shares: dict[str | None, float] | None = None,
                   window: int = WINDOW, quantum: int = QUANTUM, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents in windows of ``window`` ids, mixed to target shares.

    ``shares``: target proportions by source; by default each source's part of
    all tokens, with which every window keeps the mix until all queues end
    together.  A queue that ends early leaves its turns to the others.
    Returns ``doc_id, source, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``: each id of each document lies in exactly one piece,
    windows are filled from offset 0 without gaps, and only the last window of
    all may be short.

    Null text is empty: the document is the end id alone.  A null source is a
    queue of its own, last.  Repeated rows are documents of their own.  An
    empty table gives no pieces.  Other columns are not read.
    """
    encoded = materialize(
        docs.select(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.col(text_col))
        .mapInArrow(lambda b: _encode(b, vocabulary, end_id), _IDS_SCHEMA), "pack")
    totals = encoded.groupBy("source_null", "source", "part").agg(F.sum("doc_tokens").alias("n"))
    totals = materialize(totals, "pack-totals")
    per_source = {(None if r["source_null"] else r["source"]): r["n"] for r in
                  totals.groupBy("source_null", "source").agg(F.sum("n").alias("n")).collect()}
    order = sorted(per_source, key=lambda s: (s is None, s or ""))
    amounts = [per_source[s] for s in order]
    turns = Turns(amounts, [shares[s] for s in order] if shares else amounts, quantum)
    sources = {s: i for i, s in enumerate(order)}
    id_type = tokens.encoder(vocabulary, tokens.word_parts).dtype.str
    before = Window.partitionBy("source_null", "source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = encoded.join(bases, ["source_null", "source", "part"])
    return placed.mapInArrow(lambda b: _cut(b, sources, turns, window, id_type), _PIECE_SCHEMA)
