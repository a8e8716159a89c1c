import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import mih
from faresight.llm.mih import Substrings, fit_codes, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3.0)
                                  for i, v in vectors], SCHEMA).repartition(4)


def brute(vectors, k=10):
    ok = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in vectors
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for q, x in ok:
        if q % 100 == 0:
            out[q] = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in ok if i != q)[:k]
    return out


@pytest.mark.parametrize("blocks", [4096, 2])
def test_recall_scores_and_ties(spark, blocks, monkeypatch):
    monkeypatch.setattr(mih, "QUERY_BLOCK", blocks)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    vectors = [(i, centres[i % 12] + 0.4 * rng.normal(size=24)) for i in range(900)]
    vectors += [(2000 + i, vectors[100][1]) for i in range(15)]  # ties at distance 0 and beyond k
    vectors += [(3000, None), (3100, [0.0] * 24), (3200, [float("nan")] * 24), (3001, [1.0] * 23 + [None]),
                (3002, [1.0] * 23 + [float("inf")]), (None, [1.0] * 24), (3003, [1.0] * 5), (3004, [])]
    usable = [v for v in vectors if v[0] not in (3003, 3004)]
    got = {}
    for r in nearest(frame(spark, vectors), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    want = brute(usable)
    assert set(got) == set(want)
    hit = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [(s, i) for _, s, i in rows] == sorted((s, i) for _, s, i in rows)
        truth = {i: s for s, i in want[q]}
        hit += len(truth.keys() & {i for _, _, i in rows})
        assert all(s == pytest.approx(truth[i], rel=1e-12) for _, s, i in rows if i in truth)
    assert hit / (10 * len(want)) >= 0.9
    assert [i for _, _, i in got[100]][:10] == list(range(2000, 2010))


def test_few_rows_return_all_candidates(spark):
    vectors = [(0, [1, 2]), (1, [1, 2]), (2, [5, 5]), (100, [0, 1])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest(frame(spark, vectors), F.col("vec_id") % 100 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 100), (0, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)]


def test_no_vectors_and_no_queries(spark):
    columns = ["query_id", "rank", "vec_id", "score"]
    for vectors in ([], [(0, None)], [(1, [1.0]), (2, [2.0])]):
        out = nearest(frame(spark, vectors), F.col("vec_id") % 100 == 0)
        assert out.columns == columns and out.collect() == []


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    codes[:500] = codes[0] ^ (np.uint64(1) << rng.integers(0, 63, 500, dtype=np.uint64))
    tables = Substrings(codes)
    for radius in (0, 3, 9, 17, 26, 63, 64):
        for query in codes[:20]:
            assert (tables.within(query, radius) == np.nonzero(np.bitwise_count(codes ^ query) <= radius)[0]).all()


def test_learned_rotation_beats_a_random_one():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64)) * np.linspace(3, 0.2, 64)
    learned = fit_codes(np.arange(3000), x, 10)
    assert learned.projection.shape == (64, 64) and 0 < learned.margin < 64
    q = x[0]
    near = np.argsort(((x - q) ** 2).sum(axis=1))[1:11]
    far = np.bitwise_count(learned.encode(x) ^ learned.encode(x[:1])[0])
    assert far[near].mean() < far.mean() - 5


def test_radii_follow_the_sample_around_each_query():
    """k sample rows lie within each radius; rows with the query's id do not count."""
    rng = np.random.default_rng(7)
    ids = np.arange(400)
    ids[:30] = 0
    x = rng.normal(size=(400, 16))
    x[:30] = x[0]
    codes = fit_codes(ids, x, 10)
    code = codes.encode(x)
    for i, r in enumerate(codes.radii(ids, code, 10)):
        assert (np.bitwise_count(code ^ code[i])[ids != ids[i]] <= r).sum() >= 10
    few = fit_codes(ids[30:38], x[30:38], 10)
    assert (few.radii(ids[30:38], code[30:38], 10) == 64).all()


def test_only_a_small_part_is_reranked_on_clustered_vectors():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(100, 32))
    x = centres[np.arange(8000) % 100] + 0.05 * rng.normal(size=(8000, 32))
    codes = fit_codes(np.arange(2000), x[:2000], 10)
    code, tables = codes.encode(x), Substrings(codes.encode(x))
    asked = np.arange(0, 8000, 100)
    radii = codes.radii(asked, code[asked], 10)
    got = [tables.within(code[q], int(r)) for q, r in zip(asked, radii, strict=True)]
    assert np.mean([len(g) for g in got]) < 0.1 * len(x)
    hits = [len(set(g) & set(np.argsort(((x - x[q]) ** 2).sum(axis=1))[1:11])) for q, g in zip(asked, got, strict=True)]
    assert np.mean(hits) >= 9


def test_every_query_gets_k_rows_on_skewed_vectors(spark):
    """Radii inside tight clusters leave outliers without rows; outliers have wider ones of their own."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 32))
    vectors = [(i, centres[i % 60] + 1e-4 * rng.normal(size=32)) for i in range(3600)]
    far = [i for i in range(0, 3600, 100)][:8]
    for i in far:
        vectors[i] = (i, 3 * rng.normal(size=32))
    sample = np.array([v for _, v in vectors])
    codes = fit_codes(np.arange(3600), sample, 10)
    code = codes.encode(sample)
    radii = codes.radii(np.arange(3600), code, 10)
    usual = int(np.median(radii))
    inside = [(np.bitwise_count(code ^ code[i]) <= usual).sum() - 1 for i in far]
    assert usual < 64 and min(inside) < 10
    got = {}
    for r in nearest(frame(spark, vectors), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == set(range(0, 3600, 100))
    for q, rows in got.items():
        assert sorted(n for n, _ in rows) == list(range(1, 11))
        assert len({i for _, i in rows} - {q}) == 10
