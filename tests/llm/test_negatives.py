import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import negatives
from faresight.llm.negatives import Found, Walkers, clusters, directions, hard_negatives, shared_list, walk_shard

SCHEMA = "vec_id long, label int, embedding array<double>, rank int, anchor long, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, b, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x")
                                  for i, b, v in rows], SCHEMA).repartition(5)


def brute(rows):
    ok = {}
    for i, b, v in sorted(rows, key=repr):
        if i is not None and b is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault(i, ((b + 1) % 10 if i % 7 == 0 else b, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in ok.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, b) for i, (b, w) in ok.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            band = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a, i, r, j, -p, -s) for r, (s, j, _) in enumerate(band, 1)]
    return sorted(out)


def collected(out):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect())


@pytest.mark.parametrize("block,shard,scale", [(2048, 8192, 1.0), (5, 64, 1.0), (2048, 300, 1e6)])
def test_against_brute_force(spark, block, shard, scale, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(9, 12))
    rows = [(i, int(rng.integers(0, 10)), scale * (centres[i % 9] + 0.3 * rng.normal(size=12))) for i in range(1500)]
    rows += [(2000 + i, i % 3, rows[100][2]) for i in range(40)]  # ties
    rows += [(3000, None, [1.0] * 12), (3100, 1, None), (3200, 2, [float("nan")] * 12), (3300, 3, [1.0] * 11 + [None]),
             (3400, 4, [float("inf")] * 12), (3500, 5, [0.0] * 12), (None, 1, [1.0] * 12)]
    assert collected(hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows)


def test_repeats_other_lengths_and_empty(spark):
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [2.0, 2.0]), (2, 2, [1.0, 2.2]), (3, 3, [-1.0, 0.0]), (100, 2, [0.0, 0.0])]
    odd = [(4, 2, [9.0]), (5, 2, []), (6, 2, [1e30, 1.0])]
    assert collected(hard_negatives(frame(spark, rows + rows + odd), F.col("vec_id") % 100 == 0)) == brute(rows)
    for few in ([], [(0, None, [1.0])], [(1, 1, [1.0])], [(0, 1, [1.0])]):
        out = hard_negatives(frame(spark, few), F.col("vec_id") % 100 == 0)
        assert out.collect() == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_bounds_certify_and_lists_end_early():
    rng = np.random.default_rng(2)
    centres = 40 * rng.normal(size=(30, 16))
    x = np.floor(256 * (centres[np.arange(6000) % 30] + rng.normal(size=(6000, 16)))).astype(np.int64)
    anchors = x[:600]
    unit, lengths = directions(x.astype(float))
    own = clusters(anchors.astype(float))
    for c in np.unique(own)[:5]:
        members = unit[:600][own == c]
        order, bound = shared_list(members, unit, lengths)
        assert (np.diff(bound) <= 0).all() and ((members @ (unit * lengths[:, None])[order].T).max(axis=0) <= bound).all()
    n = len(anchors)
    walks = Walkers(np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), anchors, np.full(n, negatives.LOWEST), np.full(n, (1 << 63) - 1), True, own)
    found = Found(n, 5)
    scored = walk_shard(walks, np.arange(6000), np.zeros(6000, np.int64), x, found)
    assert scored < 0.6 * n * 6000
    for i in range(0, n, 37):
        scores = x @ anchors[i]
        assert found.best[i] == sorted((-s, j) for j, s in enumerate(scores.tolist()) if j != i)[:5]
