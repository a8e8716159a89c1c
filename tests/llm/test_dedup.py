import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import jaccard_join, line_spread, substring_dedup
from faresight.llm.graph import components
from faresight.llm.jaccard_join import jaccard_components
from faresight.llm.line_spread import remove_boilerplate
from faresight.llm.substring_dedup import Automaton, earlier_spans, remove_repeated_passages


def split(text):
    return (text or "").encode().split()


# ---------------------------------------------------------------- lines

def brute_lines(rows, min_sites):
    sites, first = defaultdict(set), {}
    for doc, text, _, source in rows:
        for pos, line in enumerate((text or "").split("\n")):
            bare = line.strip(" \t\n\x0b\x0c\r")
            if bare:
                sites[bare].add(source)
                place = (doc is None, doc or 0, hashed(text), pos)
                first[bare] = min(first.get(bare, place), place)
    out = []
    for doc, text, _, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for pos, x in enumerate(lines)
                if len(sites[b := x.strip(" \t\n\x0b\x0c\r")]) < min_sites or not b
                or first[b] == (doc is None, doc or 0, hashed(text), pos)]
        gone = len(lines) - len(kept)
        out.append((doc, len(lines), gone, text if not gone else "\n".join(kept)))
    return Counter(out)


def hashed(text):
    import xxhash
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("near", [0.1, 10.0])
def test_lines_match_brute_force(with_null_id, near, monkeypatch):
    """With a wide band every line's sites are counted exactly; with a narrow one the sketch decides."""
    monkeypatch.setattr(line_spread, "NEAR", near)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in with_null_id.collect()]
    out = remove_boilerplate(with_null_id)
    assert out.columns == [*with_null_id.columns, "n_lines", "n_removed"]
    got = out.collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == brute_lines(rows, 10)
    assert {(r._text, r._lines, r.removed) for r in got} == {("t", "l", 3)}


def test_lines_empty(empty):
    assert remove_boilerplate(empty).collect() == []


def test_lines_run_no_python(docs):
    plan = remove_boilerplate(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ------------------------------------------------------------- substrings

def brute_passages(rows, window):
    first = {}
    for doc, text in rows:
        w = split(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if doc is not None:
                first[k] = min(first.get(k, doc), doc)
    out = Counter()
    for doc, text in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()] += 1
    return out


@pytest.mark.parametrize(("window", "shard"), [(50, 200), (50, 2), (20, 200)])
def test_passages_match_brute_force(with_null_id, window, shard, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_SEGMENTS", shard)
    rows = [(r.doc_id, r.text) for r in with_null_id.select("doc_id", "text").collect()]
    got = remove_repeated_passages(with_null_id, window=window).collect()
    want = brute_passages(rows, window)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == want
    assert sum(r.n_removed for r in got) > 500


def test_passages_empty(empty):
    assert remove_repeated_passages(empty).collect() == []


def test_many_equal_rows_do_not_multiply(spark):
    """Rows equal in id and text are one segment of a shard, not one per pair of rows."""
    rng, copies = random.Random(21), 400
    one = [f"w{rng.randrange(500)}" for _ in range(300)]
    two = one[:100] + ["x"] + one[100:200] + ["y"] + one[200:]
    rows = [(1, " ".join(one))] * copies + [(2, " ".join(two))] * copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = remove_repeated_passages(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute_passages(rows, 50)
    assert {(r.doc_id, r.n_removed) for r in got} == {(1, 0), (2, 300)}
    keyed = docs.selectExpr("doc_id AS doc", "xxhash64(text) AS version", "text")
    assert substring_dedup.repeated_spans(keyed).count() <= 60 * copies


def test_matching_statistics_are_longest_earlier_runs():
    rng = random.Random(5)
    added = [[rng.randint(0, 3) for _ in range(rng.randint(1, 40))] for _ in range(6)]
    probe = [rng.randint(0, 4) for _ in range(200)]
    a = Automaton()
    for s in added:
        a.add(s)
    for i, n in enumerate(a.matching_statistics(probe)):
        def found(k, i=i):
            run = probe[i - k + 1:i + 1]
            return any(run == s[j:j + k] for s in added for j in range(len(s) - k + 1))
        assert n == max((k for k in range(1, i + 2) if found(k)), default=0)


def test_a_document_does_not_remove_its_own_repeats():
    run = list(range(60))
    shard = [(1, 0, 0, run), (1, 0, 100, run), (2, 0, 0, run)]
    assert earlier_spans(shard, 50) == [(2, 0, 0, 10)]


# ---------------------------------------------------------------- Jaccard

def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}


def brute_components(rows, percent):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return Counter((d, len(s), find(d)) for d, s in sets)


@pytest.mark.parametrize(("block", "chunk"), [(64, 64), (2, 3)])
def test_jaccard_matches_brute_force(docs, block, chunk, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_components(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 90)


def test_jaccard_chain_and_threshold_ties(spark):
    """Links at exactly 90 of 100, and a chain whose ends do not link."""
    base = [f"w{i}" for i in range(300)]
    chain = [" ".join([f"e{k}x{j}" if j < 4 * k else w for j, w in enumerate(base)]) for k in range(5)]
    exact = [f"q{i}" for i in range(97)]
    rows = [(10 + k, t) for k, t in enumerate(chain)]
    rows += [(50, " ".join(exact)), (51, " ".join(exact + [f"r{i}" for i in range(10)])),
             (52, " ".join(exact + [f"s{i}" for i in range(11)]))]
    rows += [(60 + i, " ".join(f"z{i}y{j}" for j in range(i + 1))) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_components(frame).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 90)


@pytest.mark.parametrize("block", [7, 2048])
def test_a_list_in_blocks_is_searched_whole(spark, block, monkeypatch):
    """One token that 150 sets of many sizes hold: chains of near sizes, unlike sets and a group of near copies."""
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT_TOKENS", 1)
    rng = random.Random(6)
    common = "the very same"
    rows = [(i, " ".join([common, *[f"a{j}" for j in range(4 + i)]])) for i in range(50)]
    rows += [(100 + i, " ".join([common, *[f"b{rng.randrange(10**6)}" for _ in range(4 + i)]])) for i in range(50)]
    near = [f"c{j}" for j in range(60)]
    rows += [(200 + i, " ".join([common, *near[:50 + i % 7], f"d{i}"])) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_components(frame).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 90)
    assert 2 < len({r.component_id for r in got}) < 150


def test_block_pairs_meet_once(spark, monkeypatch):
    """Every two sets of a list whose sizes can link meet in one task that may compare them."""
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 5)
    rows = [(7, d, 1 + d % 40, 0, b"") for d in range(90)] + [(8, d, 10, 0, b"") for d in range(4)]
    entries = spark.createDataFrame(rows, "token long, doc long, n int, pos int, bits binary")
    lengths = entries.groupBy("token").agg(F.count("*").alias("entries"))
    groups = {}
    for r in jaccard_join._dealt_lists(entries, lengths, 90).collect():
        groups.setdefault((r.token, r.i, r.j), []).append((r.doc, r.block))
    met = Counter((t, *sorted((a, b))) for (t, i, j), g in groups.items() for x, (a, p) in enumerate(g)
                  for b, q in g[:x] if i == j or p != q)
    assert set(met.values()) == {1}
    assert all((t, a, b) in met for t, a, n, *_ in rows for u, b, m, *_ in rows
               if t == u and a < b and 100 * min(n, m) >= 90 * max(n, m))


def test_jaccard_null_ids_and_empty(with_null_id, empty):
    got = [r for r in jaccard_components(with_null_id).collect() if r.doc_id is None]
    assert len(got) == 2 and all(r.component_id is None and r.n_shingles > 50 for r in got)
    assert jaccard_components(empty).collect() == []


def test_overlaps_derived_from_similar_sets():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 200, dtype=np.uint64))
    sets = []
    for i in range(40):
        s = base if i % 3 else np.unique(rng.integers(0, 1 << 60, 50 + i, dtype=np.uint64))
        sets.append(np.unique(np.concatenate((s[rng.random(len(s)) > 0.03], rng.integers(0, 1 << 60, i % 5, dtype=np.uint64)))))
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert jaccard_join.overlaps(sets).tolist() == want


def test_bitmaps_bound_the_difference_and_fold():
    rng = np.random.default_rng(3)
    sets = []
    for n in (1, 90, 1000, 1030, 1100, 2100, 4000, 4200, 9000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate((base[: n - n // 40], rng.integers(0, 1 << 63, n // 30, dtype=np.uint64))))]
    maps = [np.frombuffer(jaccard_join.parity_bitmap(s), dtype=np.uint64) for s in sets]
    size = np.array([len(m) for m in maps])
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if max(size[i], size[j]) <= 2 * min(size[i], size[j])]
    a, b = (np.array(c) for c in zip(*pairs, strict=True))
    assert len(set(size)) > 3 and (size[a] != size[b]).any()
    got = jaccard_join.differing_bits(np.concatenate(maps), np.cumsum(size) - size, size, a, b)
    for i, j, bits in zip(a, b, got, strict=True):
        apart = len(np.setxor1d(sets[i], sets[j]))
        lo = min(size[i], size[j]) * 64
        parity = np.bincount((np.setxor1d(sets[i], sets[j]) & np.uint64(lo - 1)).astype(np.int64), minlength=lo) & 1
        assert bits == parity.sum() <= apart


def test_prefix_filter_loses_no_pair():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = set(range(n))
        b = {x if rng.random() > 0.05 else x + 1000 for x in a}
        order = {x: rng.random() for x in a | b}
        if 100 * len(a & b) >= 90 * len(a | b):
            pa = set(sorted(a, key=order.get)[:jaccard_join.prefix_length(len(a))])
            pb = set(sorted(b, key=order.get)[:jaccard_join.prefix_length(len(b))])
            assert pa & pb


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(1000, 1080)] + [(3, 3), (-4, 1079), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: -4 for i in range(1000, 1080)}, 5: -4, -4: -4, 7: 7, 8: 7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
