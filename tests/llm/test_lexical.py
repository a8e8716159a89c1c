import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import lexical
from faresight.llm.lexical import Best, Items, Sparse, products, rank_documents, search_tree, terms

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, k=10):
    counted = [(i, Counter(t)) for i, t in ((i, brute_terms(x)) for i, x in docs) if t]
    n_docs, words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 25 + 75 * sum(c.values()) * n_docs // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in brute_terms(text) if t in c)
            if score > 0:
                scored.append((-score, math.inf if doc is None else doc))
        out += [(item, r, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def collected(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=repr)


def test_terms_are_the_contracts():
    for text in ("", None, "It's 9 o'clock_é漢字 x\x7fY", "ÀB c\t\n--d", " 0aZ@[`{~"):
        assert [t.decode() for t in terms(text) if t] == brute_terms(text)


@pytest.mark.parametrize("block", [4096, 7])
def test_ranks_against_brute_force(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BLOCK", block)
    rng = random.Random(5)
    held = [(r[0], r[1]) for r in rows]
    texts = [t for _, t in held if t and len(t) < 4000]
    items = [(i, " ".join(rng.choice(texts).split()[:rng.randint(1, 40)])) for i in range(25)]
    items += [(30, None), (31, ""), (32, "zzz unknown"), (33, "word word WORD"), (None, "shared line of the site here"), (34, "漢 é")]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, doc_id long")
    assert collected(rank_documents(asked, docs)) == brute(items, held)


def test_null_ids_repeats_ties_and_empty_tables(spark, with_null_id, empty):
    rows = [(r.doc_id, r.text) for r in with_null_id.select("doc_id", "text").collect()]
    items = [(1, "the very same text again and again"), (2, dict((i, t) for i, t in rows)[55])]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert collected(rank_documents(asked, with_null_id)) == brute(items, rows)
    assert rank_documents(asked, empty).collect() == [] and rank_documents(asked.filter("false"), with_null_id).collect() == []
    twice = asked.unionByName(asked).unionByName(spark.createDataFrame([(1, "zz")], "item_id long, text string"))
    assert collected(rank_documents(twice, with_null_id)) == brute(items, rows)


def sparse(rows):
    flat = [x for r in rows for x in r]
    return Sparse(np.cumsum([0, *map(len, rows)]), np.array([t for t, _ in flat], dtype=np.int64), np.array([v for _, v in flat], dtype=np.int64))


@pytest.mark.parametrize("largest", [1000, 1 << 50])
def test_bounds_hold_and_pruning_is_exact(largest):
    rng = random.Random(8)
    words = [b"w%d" % i for i in range(400)]
    items = Items(list(range(150)), [Counter({words[(i % 10) * 40 + rng.randrange(40)]: rng.randint(1, 3) for _ in range(8)}) for i in range(150)])
    docs = sparse([sorted({(d // 150 * 40 + rng.randrange(40)) % len(items.vocabulary): rng.randint(1, largest) for _ in range(12)}.items())
                   for d in range(1500)])
    exact = products(docs, items.levels[-1])
    for side in items.levels:
        for size in lexical.DOC_LEVELS:
            bounds = products(docs.maxima(size), side)
            assert (np.repeat(np.repeat(bounds, size, axis=0)[:len(docs)], side.size, axis=1)[:, :len(items)] >= exact).all()
    best = Best(np.zeros(len(items), dtype=np.int64), 10)
    scored = search_tree(docs, np.arange(len(docs)), items, best)
    assert scored < exact.size / 2
    for i in range(len(items)):
        order = sorted((-s, d) for d, s in enumerate(exact[:, i].tolist()) if s > 0)[:10]
        assert best.found[i] == order


def test_plan_has_no_cross_join(spark, docs):
    plan = rank_documents(docs.select(F.col("doc_id").alias("item_id"), "text").limit(3), docs)
    assert "Cartesian" not in plan._jdf.queryExecution().executedPlan().toString()
