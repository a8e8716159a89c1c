"""Substring dedup with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words.  A word goes if a window that covers
it also stands in a document with a smaller id.

1. Winnowing marks every window with the smallest hash among its ``GRAM``-word
   runs; equal windows have equal marks.  Consecutive windows with the same
   mark make a segment, keyed by the mark.  Marks found in one document only
   end here.
2. Equal segments of one mark go with the first document that holds them; all
   later copies are removed whole.  This is an aggregation, so a passage in a
   third of all documents costs one row per task.
3. What is left are first copies of different segments under one mark: a
   reference shard.  Its segments, in ascending id order, are streamed through
   the suffix automaton of the segments before them; the matching statistics
   (longest suffix that stands in the reference, at every word) give the
   maximal spans of ``WINDOW`` words or more, which are removed.  The segment
   then joins the automaton.
4. A shard beyond ``SHARD_SEGMENTS`` segments (the edges of a very common passage) is
   split by window hash instead, with the first id by aggregation: as exact, and
   without a group of unbounded size.

The automata are not broadcast to all documents: the reference is the corpus
itself and grows with it, so segments are routed to their shard by mark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresight.llm.common import materialize, words

WINDOW = 50
#: Words of the runs whose smallest hash marks a window.
GRAM = 16
#: Segments of one mark that one automaton serves at most; larger shards are split by window hash.
SHARD_SEGMENTS = 200

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SEGMENTS = "doc long, version long, lo int, hi int, mark long, content long"
_WORDS = "mark long, doc long, version long, lo int, words array<long>"
_WINDOWS = "window long, doc long, version long, lo int"
_SPANS = "doc long, version long, lo int, hi int"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class _Ranges:
    """Hashes of word ranges of one document: a polynomial over the words' hashes modulo 2^64."""

    _powers = np.ones(1, dtype=np.uint64)
    _inverse = np.ones(1, dtype=np.uint64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        if len(_Ranges._powers) < n:
            size = 1 << n.bit_length()
            steps = np.full(size, _BASE, dtype=np.uint64)
            steps[0] = 1
            _Ranges._powers = np.multiply.accumulate(steps)
            steps[1:] = np.uint64(pow(int(_BASE), -1, 1 << 64))
            _Ranges._inverse = np.multiply.accumulate(steps)
        terms = hashes * _Ranges._powers[:n - 1]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * _Ranges._inverse[start]
        return _mix(raw + (end - start).astype(np.uint64) * _MIX2)


def segments(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(lo, hi, mark, content) of a document's segments: windows lo..hi have one mark.

    Equal windows get equal marks in any two documents; ``content`` hashes the
    words lo .. hi + window.
    """
    n_windows = len(hashes) - window + 1
    if n_windows <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    ranges = _Ranges(hashes)
    starts = np.arange(len(hashes) - gram + 1)
    grams = ranges(starts, starts + gram)
    wide = window - gram + 1
    at = np.empty(n_windows, dtype=np.int64)
    for a in range(0, n_windows, 1 << 16):
        b = min(n_windows, a + (1 << 16))
        view = np.lib.stride_tricks.sliding_window_view(grams[a:b + wide - 1], wide)
        at[a:b] = np.arange(a, b) + view.argmin(axis=1)
    new = np.concatenate(([True], at[1:] != at[:-1]))
    lo = np.nonzero(new)[0]
    hi = np.concatenate((lo[1:], [n_windows])) - 1
    return lo, hi, grams[at[lo]].view(np.int64), ranges(lo, hi + window).view(np.int64)


class Automaton:
    """Suffix automaton of word sequences, grown word by word."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0
        self.added = 0

    def _extend(self, symbol) -> None:
        nxt, link, length = self.next, self.link, self.length
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[self.last] + 1)
        p = self.last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(symbol) == q:
                    nxt[p][symbol] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur

    def add(self, sequence: Sequence[int]) -> None:
        """Add a sequence; a symbol of its own keeps matches from running over its end."""
        for w in sequence:
            self._extend(w)
        self.added += 1
        self._extend(("end", self.added))

    def matching_statistics(self, sequence: Sequence[int]) -> list[int]:
        """At every word, the length of the longest run ending there that was added before."""
        nxt, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for w in sequence:
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                size += 1
            out.append(size)
        return out


def runs(starts: Iterable[int]) -> list[tuple[int, int]]:
    """Ascending numbers as (first, last) of their runs."""
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s == out[-1][1] + 1:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def earlier_spans(shard: Sequence[tuple], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """(doc, version, lo, hi): windows of a shard's segments that stand in a smaller document.

    ``shard``: (doc, version, lo, words), ascending by doc.
    """
    automaton, out, same, doc = Automaton(), [], [], None
    for d, version, lo, sequence in shard:
        if d != doc:
            for s in same:
                automaton.add(s)
            same, doc = [], d
        if automaton.added:
            found = [i - window + 1 for i, m in enumerate(automaton.matching_statistics(sequence)) if m >= window]
            out += [(d, version, lo + a, lo + b) for a, b in runs(found)]
        same.append(sequence)
    return out


def _hashes(column: pa.Array) -> Iterator[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    cuts = (column.offsets.to_numpy() - column.offsets[0].as_py()).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield flat[a:b]


def _find_segments(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    names = ("doc", "version", "lo", "hi", "mark", "content")
    for b in batches:
        docs, versions = b.column(0).to_numpy(), b.column(1).to_numpy()
        found = [segments(h, window) for h in _hashes(b.column(2))]
        counts = [len(f[0]) for f in found]
        if not sum(counts):
            continue
        lo, hi, mark, content = (np.concatenate([f[i] for f in found]) for i in range(4))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(docs, counts)), pa.array(np.repeat(versions, counts)), pa.array(lo.astype(np.int32)),
             pa.array(hi.astype(np.int32)), pa.array(mark), pa.array(content)], names)


def _segment_words(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("mark", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("lo", pa.int32()),
                        ("words", pa.list_(pa.int64()))])
    for b in batches:
        rows = []
        for doc, version, h, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _hashes(b.column(2)),
                                           b.column(3).to_pylist(), strict=True):
            for s in wanted:
                rows.append({"mark": s["mark"], "doc": doc, "version": version, "lo": s["lo"],
                             "words": h[s["lo"]:s["hi"] + window].view(np.int64)})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _segment_windows(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[tuple] = []
        for doc, version, h, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _hashes(b.column(2)),
                                           b.column(3).to_pylist(), strict=True):
            starts = np.unique(np.concatenate([np.arange(s["lo"], s["hi"] + 1) for s in wanted]))
            out.append((_Ranges(h)(starts, starts + window).view(np.int64), np.full(len(starts), doc),
                        np.full(len(starts), version), starts.astype(np.int32)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             ["window", "doc", "version", "lo"])


def _stream_shards(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Automata over a partition sorted by mark and doc; holds one shard."""
    schema = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
    mark, shard = None, []

    def close() -> list[dict]:
        return [dict(zip(schema.names, r, strict=True)) for r in earlier_spans(shard, window)] if len(shard) > 1 else []

    for b in batches:
        rows = []
        for m, *segment in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if m != mark:
                rows += close()
                mark, shard = m, []
            shard.append(segment)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    if rows := close():
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, version, lo, hi``: windows lo..hi stand in a document with a smaller id.

    ``docs``: doc (long, not null), version (long), text.
    """
    hashed = docs.select("doc", "version", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    rows = materialize(hashed.filter(F.size("hashes") >= window)
                       .mapInArrow(lambda b: _find_segments(b, window), _SEGMENTS), "segments")
    # aggregated sides are written before they are joined: with a plain exchange on both sides a hot mark can be split
    marks = (rows.groupBy("mark").agg(F.min("doc").alias("a"), F.max("doc").alias("b"),
                                      (F.min("content") != F.max("content")).alias("several"))
             .filter("a < b").select("mark", "several"))
    shared = materialize(rows.join(materialize(marks, "marks"), "mark"), "segments-shared")
    firsts = materialize(shared.groupBy("mark", "content").agg(F.min("doc").alias("first")), "segment-firsts")
    placed = shared.join(firsts, ["mark", "content"])
    copies = placed.filter("doc > first").select("doc", "version", "lo", "hi")
    # equal rows (same id and text) are one from here on
    heads = materialize(placed.filter("doc = first AND several").select("mark", "doc", "version", "lo", "hi").distinct(),
                        "segment-heads")
    sizes = heads.groupBy("mark").agg(F.count("*").alias("n"), F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b")
    sizes = materialize(sizes.select("mark", (F.col("n") > SHARD_SEGMENTS).alias("split")), "shard-sizes")
    heads = materialize(heads.join(sizes, "mark"), "segment-shards")

    def with_words(part: DataFrame) -> DataFrame:
        wanted = part.groupBy("doc", "version").agg(F.collect_list(F.struct("mark", "lo", "hi")).alias("wanted"))
        # copies are dropped map-side, under the shuffle that the join needs anyway
        return (docs.dropDuplicates(["doc", "version"]).join(wanted, ["doc", "version"]).select(
            "doc", "version", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"), "wanted"))

    spans = (with_words(heads.filter("NOT split")).mapInArrow(lambda b: _segment_words(b, window), _WORDS)
             .repartition("mark").sortWithinPartitions("mark", "doc", "version", "lo")
             .mapInArrow(lambda b: _stream_shards(b, window), _SPANS))
    out = copies.unionByName(spans)
    if not heads.filter("split").isEmpty():
        windows = materialize(with_words(heads.filter("split"))
                              .mapInArrow(lambda b: _segment_windows(b, window), _WINDOWS), "segment-windows")
        first = windows.groupBy("window").agg(F.min("doc").alias("first"), F.max("doc").alias("b")).filter("first < b").drop("b")
        out = out.unionByName(windows.join(materialize(first, "window-firsts"), "window").filter("doc > first")
                              .select("doc", "version", "lo", F.col("lo").alias("hi")))
    return out


def _remove(batches: Iterable[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, counts, gone, digests, texts = b.column(0), [], [], [], []
        for text, spans in zip(b.column(1), b.column(2), strict=True):
            found = (text.as_py() or "").encode().split()
            counts.append(len(found))
            kept = found
            if spans.is_valid and len(spans):
                edge = np.zeros(len(found) + 1, dtype=np.int64)
                lo = spans.values.field("lo").to_numpy()
                hi = spans.values.field("hi").to_numpy()
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi + window, -1)
                kept = [found[i] for i in np.nonzero(np.cumsum(edge[:-1]) == 0)[0].tolist()]
            gone.append(len(found) - len(kept))
            joined = b" ".join(kept)
            digests.append(hashlib.sha256(joined).hexdigest())
            if with_text:
                texts.append(joined.decode())
        cols = [ids, pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            cols, names = [*cols, pa.array(texts, pa.string())], [*names, "kept_text"]
        yield pa.RecordBatch.from_arrays(cols, names)


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, if asked, ``kept_text`` for every row.

    ``kept_text`` are the kept words joined by one space; the digest is of its
    UTF-8.  Windows are judged on the input, not on what is left of it.

    Null, blank and short texts lose nothing (no words: digest of the empty
    string).  A null id is neither smaller nor larger than another: its row
    keeps everything and removes nothing.  Rows with equal ids remove nothing
    from each other; rows equal in id and text are searched once.  Empty tables give empty results; other columns are not read.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"))
    spans = (repeated_spans(keyed.filter(F.col("doc").isNotNull()), window).groupBy("doc", "version")
             .agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    schema = _RESULT + (", kept_text string" if with_text else "")
    return (keyed.join(spans, ["doc", "version"], "left").select("doc", "text", "spans")
            .mapInArrow(lambda b: _remove(b, window, with_text), schema))


#: The registered query in SQL for DuckDB, over a table ``documents`` with one row per id.
ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(array_to_string(ws[i:i+49], ' '))) AS first_doc FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM f WHERE first_doc < doc_id),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
k AS (
  SELECT doc_id, count(*) FILTER (gone.i IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone.i IS NULL) AS kept
  FROM word LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""
