"""N-gram Jaccard join with set-relation skipping.

Sets are the distinct word shingles of whole texts.  Two sets whose Jaccard
similarity reaches the threshold t share a token among the first
n - ceil(t n) + 1 of either, under any one order of all tokens; the order here
puts tokens that were seen often in such prefixes last.

1. Equal sets are one class with one representative.
2. Prefix tokens are the index: one list of (set, position, size, bitmap) per token, sorted
   by size and position.  In a list, pairs are taken by growing distance, and
   rows whose size has left the window, or whose positions leave too
   few tokens to reach the threshold, are skipped together; a parity bitmap
   (its differing bits bound the symmetric difference from below) skips most
   of the rest, and sets that links found before join already are not compared again.  What
   remains are candidate links.  A list is cut into blocks of about ``LIST_BLOCK`` sets of one
   size bucket; a task compares two blocks of the same or of neighbouring buckets, since sets
   of other buckets differ too much in size.  Most lists are one block.
3. Candidate links make clusters.  Inside a cluster a set's answers, its
   overlaps with all members, are derived from those of the most similar set
   computed before: add the lists of the tokens it has more, subtract those
   it has less.  Large clusters are dealt out as pairs of chunks.
4. Links make components.

No pair is dropped on a guess: bounds are exact, so no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresight.llm.common import materialize
from faresight.llm.graph import components

SHINGLE = 3
#: Similarity threshold in percent.
PERCENT = 90
#: Tokens put last in the order, at most (they are sent to all tasks), and how often a batch must hold one.
FREQUENT_TOKENS = 100_000
FREQUENT_IN_BATCH = 2
FREQUENT_MIN = 12
#: Least bits of a set's parity bitmap; larger sets have the power of two from half their size on.
BITMAP = 512
#: 64-bit words of bitmaps that are compared at once; bounds a worker's memory.
COMPARED_WORDS = 1 << 20
#: Sets per block of a list; a task holds two blocks.
LIST_BLOCK = 2048
#: Sets, and shingles in them, per chunk of a cluster; a task holds two chunks.
CHUNK, CHUNK_SHINGLES = 512, 500_000
#: Distinct words whose hash a worker keeps.
MAX_WORDS = 500_000

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)
_SETS = "doc long, n long, c1 long, c2 long, bits binary, token long, seen long"
_PREFIX = "token long, doc long, n int, pos int"
_EDGES = "a long, b long"


class _WordHashes(dict):
    """Hash of each word's bytes; forgets all when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _C3
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, A-Z lower-cased; a shorter text is one shingle."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        out = (out * _C1 + h[i:len(h) - width + 1 + i]) * _C2
    return np.unique(_mix(out))


def parity_bitmap(s: np.ndarray) -> bytes:
    """Parity of the set's members per hash bucket.

    A differing bit needs a member that only one of two sets has.  With half as
    many buckets as members or more, unlike sets of any size differ visibly;
    folding the halves of a bitmap gives the one of half the size.
    """
    bits = BITMAP
    while 2 * bits < len(s):
        bits *= 2
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def _describe(batches: Iterable[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows for tokens that several prefixes of a batch hold."""
    names = ["doc", "n", "c1", "c2", "bits", "token", "seen"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    for b in batches:
        rows, prefixes = [], []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            s = shingle_set(text.as_py(), size)
            c1 = int(np.bitwise_xor.reduce(_mix(s * _C1))) if len(s) else 0
            c2 = int(np.add.reduce(_mix(s * _C2), dtype=np.uint64)) if len(s) else 0
            rows.append((doc, len(s), c1 - (c1 >> 63 << 64), c2 - (c2 >> 63 << 64), parity_bitmap(s), None, None))
            prefixes.append(s[:prefix_length(len(s), percent)])
        if prefixes:
            tokens, seen = np.unique(np.concatenate(prefixes), return_counts=True)
            often = seen >= FREQUENT_IN_BATCH
            rows += [(None, None, None, None, None, t, c) for t, c in
                     zip(tokens[often].view(np.int64).tolist(), seen[often].tolist(), strict=True)]
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def _prefixes(batches: Iterable[pa.RecordBatch], size: int, percent: int, frequent: np.ndarray,
              seen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Prefix tokens under the order (how often seen in prefixes, hash); ``frequent`` is sorted."""
    for b in batches:
        tokens, docs, sizes, places = [], [], [], []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            s = shingle_set(text.as_py(), size)
            if not len(s):
                continue
            p = prefix_length(len(s), percent)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                rank = np.where(frequent[at] == s, seen[at], 0)
                rare = s[rank == 0]
                if len(rare) < p:
                    late = rank > 0
                    s = np.concatenate((rare, s[late][np.lexsort((s[late], rank[late]))]))
                else:
                    s, n = rare, len(s)
                    tokens.append(s[:p])
                    docs.append(np.full(p, doc))
                    sizes.append(np.full(p, n))
                    places.append(np.arange(p))
                    continue
            tokens.append(s[:p])
            docs.append(np.full(p, doc))
            sizes.append(np.full(p, len(s)))
            places.append(np.arange(p))
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(docs).astype(np.int64)),
                 pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(places).astype(np.int32))],
                ["token", "doc", "n", "pos"])


class _Forest:
    """Union-find over any ids."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while up.get(root, root) != root:
            root = up[root]
        while up.get(x, x) != root:
            up[x], x = root, up[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> pa.RecordBatch | None:
        pairs = [(x, self.find(x)) for x in list(self.up)]
        pairs = [p for p in pairs if p[0] != p[1]]
        if not pairs:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["a", "b"])


def slack(n1: np.ndarray, n2: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Largest symmetric difference with which sets of these sizes still reach the threshold."""
    total = n1 + n2
    return total - 2 * (-(-percent * total // (100 + percent)))


def differing_bits(words: np.ndarray, at: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the bitmaps of row pairs; ``at`` and ``size`` place a row's words, the larger map is folded."""
    out = np.empty(len(a), dtype=np.int64)
    small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
    for pair_size in set(zip(small.tolist(), large.tolist(), strict=True)):
        lo, hi = pair_size
        mine = np.nonzero((small == lo) & (large == hi))[0]
        for i in range(0, len(mine), max(1, COMPARED_WORDS // hi)):
            part = mine[i:i + max(1, COMPARED_WORDS // hi)]
            total = None
            for side in (a[part], b[part]):
                for fold in range(0, hi, lo):
                    # a smaller map has no further folds
                    rows = np.where(size[side] > fold, at[side] + fold, -1)
                    piece = np.where(rows[:, None] >= 0, words[np.maximum(rows, 0)[:, None] + np.arange(lo)], np.uint64(0))
                    total = piece if total is None else total ^ piece
            out[part] = np.bitwise_count(total).sum(axis=1, dtype=np.int64)
    return out


def list_candidates(token: np.ndarray, n: np.ndarray, pos: np.ndarray, words: np.ndarray, at: np.ndarray,
                    size: np.ndarray, side: np.ndarray, label: np.ndarray,
                    percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one list that no bound excludes; rows are sorted by token, size and position.

    Rows of one ``side`` are compared elsewhere, rows of one ``label`` are joined already; the caller may
    join labels between two yields.
    """
    rows = np.arange(len(token) - 1)
    step = 1
    while len(rows):
        rows = rows[rows + step < len(token)]
        other = rows + step
        # sizes only grow along a list: a row past its size window is done with the rest of the list
        near = (token[rows] == token[other]) & (100 * n[rows] >= percent * n[other])
        rows, other = rows[near], other[near]
        wanted = (label[rows] != label[other]) & (side[rows] != side[other])
        a, b = rows[wanted], other[wanted]
        room = slack(n[a], n[b], percent)
        ok = np.abs(pos[a] - pos[b]) + np.abs((n[a] - pos[a]) - (n[b] - pos[b])) <= room
        a, b, room = a[ok], b[ok], room[ok]
        keep = differing_bits(words, at, size, a, b) <= room
        yield a[keep], b[keep]
        step += 1


def _changes(columns: Iterable[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the row before it in any column, from the second row on."""
    return np.logical_or.reduce([c[1:] != c[:-1] for c in columns])


def _search_lists(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate links of a partition's pairs of blocks (token, i, j), as a forest; holds a batch and two blocks."""
    forest = _Forest()

    def search(t: pa.Table, new: np.ndarray) -> None:
        t = t.combine_chunks()
        doc, i, j = (t[c].to_numpy() for c in ("doc", "i", "j"))
        maps = t["bits"].to_pylist()
        size = np.array([len(m) // 8 for m in maps], dtype=np.int64)
        # rows of a block that is compared with itself have sides of their own
        side = np.where(i == j, -1 - np.arange(len(doc)), t["block"].to_numpy())
        ids, place = np.unique(doc, return_inverse=True)
        label = np.unique([forest.find(d) for d in ids.tolist()], return_inverse=True)[1][place]
        up = np.arange(len(ids))
        for a, b in list_candidates(np.concatenate(([0], np.cumsum(new))), t["n"].to_numpy().astype(np.int64),
                                    t["pos"].to_numpy().astype(np.int64), np.frombuffer(b"".join(maps), dtype=np.uint64),
                                    np.cumsum(size) - size, size, side, label, percent):
            if not len(a):
                continue
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                p, q = int(label[x]), int(label[y])
                while up[p] != p:
                    p = int(up[p])
                while up[q] != q:
                    q = int(up[q])
                if p != q:
                    up[max(p, q)] = min(p, q)
                    forest.union(int(doc[x]), int(doc[y]))
            while (up[up] != up).any():
                up = up[up]
            label[:] = up[label]

    rest: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        new = _changes(t[c].to_numpy() for c in ("token", "i", "j"))
        ends = np.nonzero(new)[0]
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if cut:
            search(t.slice(0, cut), new[:cut - 1])
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        search(rest, np.zeros(rest.num_rows - 1, dtype=bool))
    edges = forest.edges()
    if edges is not None:
        yield edges


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets with all, each row derived from the most similar row before."""
    m = len(sets)
    tokens, ids = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.cumsum([0, *map(len, sets)])
    own = [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    order = np.argsort(ids, kind="stable")
    holders = np.repeat(np.arange(m), np.diff(bounds))[order]
    starts = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=len(tokens)))))

    def count(which: np.ndarray) -> np.ndarray:
        lengths = starts[which + 1] - starts[which]
        if not lengths.sum():
            return np.zeros(m, dtype=np.int64)
        skip = np.repeat(starts[which] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        return np.bincount(holders[skip + np.arange(lengths.sum())], minlength=m)

    out = np.zeros((m, m), dtype=np.int64)
    for i in range(m):
        parent = int(out[:i, i].argmax()) if i else -1
        if i and 2 * (len(own[i]) + len(own[parent]) - 2 * out[parent, i]) < len(own[i]):
            out[i] = (out[parent] + count(np.setdiff1d(own[i], own[parent], assume_unique=True))
                      - count(np.setdiff1d(own[parent], own[i], assume_unique=True)))
        else:
            out[i] = count(own[i])
    return out


def _link_groups(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Exact links inside the groups (root, i, j) of a sorted partition, as forests; holds one group."""
    key, docs, sets = None, [], []

    def close() -> pa.RecordBatch | None:
        if len(docs) < 2:
            return None
        forest = _Forest()
        n = np.array([len(s) for s in sets])
        shared = overlaps(sets)
        a, b = np.nonzero(np.triu(100 * shared >= percent * (n[:, None] + n[None, :] - shared), 1))
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            forest.union(docs[x], docs[y])
        return forest.edges()

    for batch in batches:
        flat = batch.column(4)
        values, cuts = flat.flatten().to_numpy(zero_copy_only=False).view(np.uint64), flat.offsets.to_numpy()
        cuts = cuts - cuts[0]
        keys = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
        for row, (k, doc) in enumerate(zip(keys, batch.column(3).to_pylist(), strict=True)):
            if k != key:
                if (edges := close()) is not None:
                    yield edges
                key, docs, sets = k, [], []
            docs.append(doc)
            sets.append(values[cuts[row]:cuts[row + 1]].copy())
    if (edges := close()) is not None:
        yield edges


def _as_sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t.as_py(), size).view(np.int64) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([*[b.column(i) for i in (0, 2, 3)], pa.array(sets, pa.list_(pa.int64()))],
                                         ["doc", "root", "chunks", "shingles"])


def _dealt_lists(entries: DataFrame, lengths: DataFrame, percent: int) -> DataFrame:
    """Rows of every list by the pairs of blocks (token, i, j) that a task compares, sorted by size and position."""
    # sets that can link fall into one size bucket or into neighbours
    width = math.log(100 / percent) + 1e-9
    entries = entries.withColumn("bucket", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)))
    long = lengths.filter(F.col("entries") > LIST_BLOCK).select("token")
    along = Window.partitionBy("token").orderBy("bucket")
    cells = (entries.join(long, "token").groupBy("token", "bucket")
             .agg(F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("blocks"))
             .withColumn("start", (F.sum("blocks").over(along) - F.col("blocks")).cast("int"))
             .withColumn("below", F.when(F.lag("bucket").over(along) == F.col("bucket") - 1, F.lag("start").over(along)))
             .withColumn("above", F.when(F.lead("bucket").over(along) == F.col("bucket") + 1, F.lead("blocks").over(along)))
             .select("token", "bucket", "blocks", "start", F.coalesce("below", "start").alias("lo"),
                     (F.col("start") + F.col("blocks") - 1 + F.coalesce("above", F.lit(0))).alias("hi")))
    none = F.lit(0)
    mine = F.coalesce("start", none) + F.pmod(F.xxhash64("doc"), F.coalesce("blocks", F.lit(1))).cast("int")
    return (entries.join(lengths, "token").join(materialize(cells, "jaccard-cells"), ["token", "bucket"], "left")
            .withColumn("block", mine)
            .withColumn("other", F.explode(F.sequence(F.coalesce("lo", none), F.coalesce("hi", none))))
            .select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                    "doc", "n", "pos", "bits")
            .repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "pos", "doc"))


def candidate_clusters(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc, n, rep of its class) for all documents, and (node, root) of candidate links between reps."""
    spark = docs.sparkSession
    described = materialize(docs.mapInArrow(lambda b: _describe(b, size, percent), _SETS), "jaccard-sets")
    often = (described.filter("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
             .filter(F.col("seen") >= FREQUENT_MIN).orderBy(F.desc("seen"), "token").limit(FREQUENT_TOKENS).collect())
    often = sorted((r["token"] & (1 << 64) - 1, r["seen"]) for r in often)
    frequent = spark.sparkContext.broadcast((np.array([t for t, _ in often], dtype=np.uint64),
                                             np.array([c for _, c in often], dtype=np.int64)))
    sets = described.filter("token IS NULL")
    classes = sets.filter("n > 0").groupBy("c1", "c2", "n").agg(F.min("doc").alias("rep"))
    # written first: with a plain exchange on both sides a class of very many copies can be split
    classes = materialize(classes, "jaccard-reps")
    members = materialize(sets.join(classes, ["c1", "c2", "n"], "left").select(
        "doc", "n", F.coalesce("rep", "doc").alias("rep"), F.when(F.col("doc") == F.col("rep"), F.col("bits")).alias("bits")),
        "jaccard-classes")
    index = materialize(docs.mapInArrow(lambda b: _prefixes(b, size, percent, *frequent.value), _PREFIX), "jaccard-index")
    lists = index.groupBy("token").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").select("token")
    entries = materialize(index.join(lists, "token").join(
        members.filter("bits IS NOT NULL").select("doc", "bits"), "doc").distinct(), "jaccard-entries")
    lengths = materialize(entries.groupBy("token").agg(F.count("*").alias("entries")).filter("entries > 1"), "jaccard-lists")
    return members, components(_dealt_lists(entries, lengths, percent).mapInArrow(lambda b: _search_lists(b, percent), _EDGES))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Documents link when 100 * intersection >= percent * union of their shingle
    sets; ``component_id`` is the smallest id reachable by links.

    Null or blank text: an empty set, linked with nothing.  Fewer words than a
    shingle: one shingle of all words.  Rows with equal ids are one node.  A
    null id links with nothing and gets a null component.  Empty tables give
    empty results; other columns are not read.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    known = keyed.filter(F.col("doc").isNotNull())
    members, clusters = candidate_clusters(known, size, percent)
    sizes = (clusters.join(members.select(F.col("doc").alias("node"), "n"), "node").groupBy("root")
             .agg(F.count("*").alias("members"), F.sum("n").alias("shingles")))
    chunks = F.greatest(F.ceil(F.col("members") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    wanted = clusters.join(materialize(sizes, "cluster-sizes"), "root").select(F.col("node").alias("doc"), "root", chunks.alias("chunks"))
    with_sets = (known.join(wanted, "doc").select("doc", "text", "root", "chunks")
                 .mapInArrow(lambda b: _as_sets(b, size), "doc long, root long, chunks int, shingles array<long>"))
    mine = F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int")
    dealt = (with_sets.withColumn("_mine", mine)
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("root", F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j"), "doc", "shingles"))
    links = (dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "doc")
             .mapInArrow(lambda b: _link_groups(b, percent), _EDGES))
    linked = components(links)
    out = (members.join(linked.select(F.col("node").alias("rep"), "root"), "rep", "left")
           .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                   F.coalesce("root", "rep").alias("component_id")))
    nameless = (keyed.filter(F.col("doc").isNull()).mapInArrow(lambda b: _describe(b, size, percent), _SETS)
                .filter("token IS NULL").select("doc", "n", F.lit(None).cast("long")))
    return out.union(nameless)


#: The registered query in SQL for DuckDB, over a table ``documents`` with one row per id.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL"""
