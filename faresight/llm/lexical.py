"""Ranked lexical search of many items at once, by a dual tree.

Scores are integers: per term, the item's count times the document's impact
``w * ((10^9 tf) div (1000 tf + 8 m))``.  Items hang in a tree whose nodes hold
the largest count of each term below them; documents hang in trees whose nodes
hold the largest impact of each term.  The product of an item node and a
document node bounds every score between them, so a pair of nodes whose bound
is below the weakest k-th score of its items is left out with all that hangs
below it, exactly.

Jobs: (1) texts become the counts of those terms that items hold; (2) counts of
documents and terms; (3) impacts, dealt by their strongest terms so that
documents of one tree resemble each other; (4) a hashed part of the documents
is searched for scores that the k best reach at least; (5) all documents are
searched from these scores on, tree by tree, and the parts' best are merged.
Items are searched in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresight.llm.common import materialize

# ship this module's functions by value: executors need only numpy and pyarrow
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Items searched at a time, and bytes of item text that such a block may hold.
ITEM_BLOCK = 4_096
ITEM_BYTES = 16 << 20
#: Documents below a document tree's root, its inner nodes and its leaves; items of a group of groups and of a group.
DOC_LEVELS = (4_096, 256, 16)
LEAF_DOCS = DOC_LEVELS[-1]
SUPER_ITEMS = 64
GROUP_ITEMS = 8
#: Share of the documents (1 of so many, by hash) that first scores are taken from.
SEED_SHARE = 64
#: Doubles add integers exactly below this.
EXACT = 1 << 53
#: Stands for a null document id inside a task: after all others.
NULL_ID = (1 << 63) - 1

_SEPARATORS = bytes(b for b in range(128) if not re.match(rb"[0-9A-Za-z]", bytes([b])))
_TO_WORDS = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split(b" ") if text else []


def _count(text: str | None) -> tuple[int, Counter]:
    found = Counter(terms(text))
    found.pop(b"", None)
    return sum(found.values()), found


# ------------------------------------------------------------------ sparse rows and their products
@dataclass
class Sparse:
    """Rows of (column, value)."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def take(self, at: np.ndarray) -> "Sparse":
        sizes = np.diff(self.starts)[at]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes) + np.repeat(self.starts[:-1][at], sizes)
        return Sparse(starts, self.columns[place], self.values[place])

    def slice(self, a: int, b: int) -> "Sparse":
        lo, hi = self.starts[a], self.starts[b]
        return Sparse(self.starts[a:b + 1] - lo, self.columns[lo:hi], self.values[lo:hi])

    def maxima(self, size: int) -> "Sparse":
        """Coordinate maxima of every ``size`` consecutive rows."""
        node = self.rows() // size
        order = np.lexsort((self.columns, node))
        n, c, v = node[order], self.columns[order], self.values[order]
        first = np.ones(len(c), dtype=bool)
        first[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1])
        at = np.flatnonzero(first)
        count = -(-len(self) // size)
        starts = np.concatenate(([0], np.cumsum(np.bincount(n[at], minlength=count))))
        return Sparse(starts, c[at], np.maximum.reduceat(v, at) if len(at) else v)

    def turned(self, width: int) -> "Sparse":
        """Columns as rows."""
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=width))))
        return Sparse(starts, self.rows()[order], self.values[order])


@dataclass
class Side:
    """One level of the item tree: its rows by term, their number, the items of each and the largest sum of counts."""

    by_term: Sparse
    rows: int
    size: int
    most: int


def products(left: Sparse, side: Side) -> np.ndarray:
    """Inner products (rows of ``left``, rows of ``side``) as 64-bit integers."""
    hits = side.by_term.take(left.columns)
    cell = np.repeat(left.rows(), np.diff(hits.starts)) * side.rows + hits.columns
    values = np.repeat(left.values, np.diff(hits.starts)) * hits.values
    shape = len(left), side.rows
    if len(left.values) and int(left.values.max()) * side.most >= EXACT:
        out = np.zeros(shape[0] * shape[1], dtype=np.int64)
        np.add.at(out, cell, values)
        return out.reshape(shape)
    return np.bincount(cell, values, shape[0] * shape[1]).astype(np.int64).reshape(shape)


class Items:
    """A block of items and its tree: the items in order of likeness, groups of them and groups of groups."""

    def __init__(self, ids: list, counts: list[Counter]):
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        rows = [sorted((self.vocabulary[t], n) for t, n in c.items()) for c in counts]
        held = Counter(t for r in rows for t, _ in r)

        def telling(i: int) -> list:
            """The rarest terms that an item shares with another."""
            return [t for _, t in sorted((held[t], t) for t, _ in rows[i] if held[t] > 1)[:4]]

        order = sorted(range(len(rows)), key=lambda i: (telling(i), i))
        rows, self.ids = [rows[i] for i in order], [ids[i] for i in order]
        flat = [x for r in rows for x in r]
        leaf = Sparse(np.cumsum([0, *map(len, rows)]), np.array([t for t, _ in flat], dtype=np.int64),
                      np.array([n for _, n in flat], dtype=np.int64))
        #: From groups of groups down to the items.
        self.levels = []
        for size in (SUPER_ITEMS, GROUP_ITEMS, 1):
            node = leaf.maxima(size)
            most = np.bincount(node.rows(), node.values, len(node)).max() if len(flat) else 0
            self.levels.append(Side(node.turned(len(self.vocabulary)), len(node), size, int(most)))

    def __len__(self) -> int:
        return len(self.ids)


class Best:
    """The k best documents of each item, equal scores by ascending id, and the score that new ones must reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()
        self.found: list[list[tuple[int, int]]] = [[] for _ in floor]

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        best = sorted([*self.found[item], *zip((-scores).tolist(), docs.tolist(), strict=True)])[:self.k]
        self.found[item] = best
        if len(best) == self.k:
            self.floor[item] = max(self.floor[item], -best[-1][0])


def search_tree(docs: Sparse, ids: np.ndarray, items: Items, best: Best) -> int:
    """Dual descent of one tree of documents, in their order, and the tree of items; the number of scores computed.

    The bound of a pair of nodes is held against the weakest floor of its items.
    Equal bounds stay, since a smaller id may win a tie.
    """
    nodes, alive, scored = np.zeros(1, dtype=np.int64), np.ones((1, items.levels[0].rows), dtype=bool), 0
    bounds = None
    for i, (side, node) in enumerate(zip(items.levels, DOC_LEVELS, strict=True)):
        hulls = docs.maxima(node)
        if i:
            wide, deep = DOC_LEVELS[i - 1] // node, items.levels[i - 1].size // side.size
            nodes = (nodes[:, None] * wide + np.arange(wide)).ravel()
            alive = np.repeat(np.repeat(alive, wide, axis=0), deep, axis=1)[nodes < len(hulls), :side.rows]
            nodes = nodes[nodes < len(hulls)]
        bounds = products(hulls.take(nodes), side)
        weakest = np.minimum.reduceat(best.floor, np.arange(0, len(items), side.size))
        alive &= (bounds > 0) & (bounds >= weakest[None, :])
        kept = alive.any(axis=1)
        nodes, alive, bounds = nodes[kept], alive[kept], bounds[kept]
    order = np.argsort(-(bounds * alive).max(axis=1), kind="stable") if len(nodes) else []
    for j in order:
        open_items = np.flatnonzero(alive[j] & (bounds[j] >= best.floor))
        if not len(open_items):
            continue
        a, b = nodes[j] * LEAF_DOCS, min(len(docs), (nodes[j] + 1) * LEAF_DOCS)
        scores = products(docs.slice(a, b), items.levels[-1])[:, open_items]
        scored += scores.size
        good = (scores > 0) & (scores >= best.floor[open_items][None, :])
        for x in np.flatnonzero(good.any(axis=0)):
            rows = np.flatnonzero(good[:, x])
            best.add(open_items[x], scores[rows, x], ids[a + rows])
    return scored


# ------------------------------------------------------------------ the tasks' work
def _count_batches(batches: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, tfs) of documents with a term; ``terms`` are those of the vocabulary."""
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            ids, n, cols, tfs = [], [], [], []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                total, found = _count(text)
                if total:
                    known = [(vocabulary[t], found[t]) for t in found.keys() & vocabulary.keys()]
                    ids.append(doc)
                    n.append(total)
                    cols.append([t for t, _ in known])
                    tfs.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(cols, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], ["doc", "n", "terms", "tfs"])


def _sparse(terms_: pa.Array, values: pa.Array) -> Sparse:
    offsets = terms_.offsets.to_numpy().astype(np.int64)
    return Sparse(offsets - offsets[0], terms_.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(np.int64))


def _impact_batches(batches: Iterable[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    """(doc, strongest, second, terms, impacts) of documents with an impact above 0."""
    for b in batches:
        if not b.num_rows:
            continue
        tf = _sparse(b.column(2), b.column(3))
        m = np.array([25 + 75 * x * n_docs // n_terms for x in b.column(1).to_pylist()], dtype=np.int64)
        impact = weights[tf.columns] * ((1_000_000_000 * tf.values) // (1000 * tf.values + 8 * np.repeat(m, np.diff(tf.starts))))
        keep = impact > 0
        rows = tf.rows()[keep]
        order = np.lexsort((tf.columns[keep], -impact[keep], rows))
        rows, cols, impact = rows[order], tf.columns[keep][order], impact[keep][order]
        starts = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(tf)))))
        has = np.flatnonzero(np.diff(starts))
        first = starts[:-1][has]
        second = np.where(np.diff(starts)[has] > 1, cols[np.minimum(first + 1, len(cols) - 1)] if len(cols) else 0, -1)
        offsets = pa.array(np.concatenate((first, starts[-1:])).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(has)), pa.array(cols[first].astype(np.int32)), pa.array(second.astype(np.int32)),
             pa.ListArray.from_arrays(offsets, pa.array(cols.astype(np.int32))),
             pa.ListArray.from_arrays(offsets, pa.array(impact))], ["doc", "strongest", "second", "terms", "impacts"])


def _search_batches(batches: Iterable[pa.RecordBatch], items: Items, floor: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of this task for each item."""
    best, held = Best(floor, k), []

    def flush() -> None:
        t = pa.Table.from_batches(held).combine_chunks()
        docs = _sparse(t["terms"].chunk(0), t["impacts"].chunk(0))
        ids = t["doc"].fill_null(NULL_ID).to_numpy()
        search_tree(docs, ids, items, best)
        held.clear()

    for b in batches:
        at = 0
        while at < b.num_rows:
            held.append(b.slice(at, DOC_LEVELS[0] - sum(x.num_rows for x in held)))
            at += held[-1].num_rows
            if sum(x.num_rows for x in held) == DOC_LEVELS[0]:
                flush()
    if held:
        flush()
    out = [(items.ids[i], -s, None if d == NULL_ID else d) for i, found in enumerate(best.found) for s, d in found]
    if out:
        item, score, doc = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                         ["item_id", "doc_id", "score"])


# ------------------------------------------------------------------ the search
OUT = "item_id long, rank int, doc_id long, score long"


def _search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    vocabulary = items.vocabulary
    counted = materialize(docs.mapInArrow(lambda b: _count_batches(b, vocabulary),
                                          "doc long, n long, terms array<int>, tfs array<long>"), "lexical-counts")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in held.collect():  # a row per term of the block of items
        df[r["t"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    by_place = ["strongest", "second", F.xxhash64("doc")]
    impacts = materialize(
        counted.mapInArrow(lambda b: _impact_batches(b, weights, n_docs, n_terms),
                           "doc long, strongest int, second int, terms array<int>, impacts array<long>")
        .repartitionByRange(*by_place).sortWithinPartitions(*by_place), "lexical-impacts")
    by_item = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))

    def search(part: DataFrame, floor: np.ndarray) -> DataFrame:
        found = part.select("doc", "terms", "impacts").mapInArrow(lambda b: _search_batches(b, items, floor, k),
                                                                  "item_id long, doc_id long, score long")
        return found.withColumn("rank", F.row_number().over(by_item)).filter(F.col("rank") <= k)

    seeds = search(impacts.filter(F.pmod(F.xxhash64("doc", F.lit(12)), F.lit(SEED_SHARE)) == 0), np.zeros(len(items), dtype=np.int64))
    reached = {r["item_id"]: r["score"] for r in seeds.filter(F.col("rank") == k).collect()}  # a row per item of the block
    floor = np.array([reached.get(i, 0) for i in items.ids], dtype=np.int64)
    return materialize(search(impacts, floor).select("item_id", "rank", "doc_id", "score"), "lexical-found")


def rank_documents(items: DataFrame, docs: DataFrame, k: int = 10, item_col: str = "item_id", item_text: str = "text",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest scores above 0 of each item.

    Equal scores stand by ascending document id.  Null texts have no terms;
    documents without terms take no part in any count, items without terms get
    no rows.  Rows with equal ids are documents of their own; a null document id
    comes after all others.  Of rows with equal item ids the first by text is
    the item; a null item id is an item like any other.  Empty tables give no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    asked = materialize(items.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
                        .groupBy("item").agg(F.min("text").alias("text")), "lexical-items")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n_blocks = max(-(-size["n"] // ITEM_BLOCK), -(-size["bytes"] // ITEM_BYTES))
    found = None
    for i in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == i).collect()  # bounded by the block's size
        counts = [(r["item"], _count(r["text"])[1]) for r in block]
        counts = [(x, c) for x, c in counts if c]
        if counts:
            part = _search_block(texts, Items([x for x, _ in counts], [c for _, c in counts]), k)
            found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], OUT) if found is None else found


#: The same in SQL for DuckDB, over tables ``benchmark`` and ``documents``.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
q AS (
  SELECT item_id, t, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY ALL),
s AS (
  SELECT q.item_id, tf.doc_id, sum(q.c * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
         * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t) JOIN n ON n.doc_id = tf.doc_id, total GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""
