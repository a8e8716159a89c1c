import math
from collections import Counter

import pytest
import xxhash
import zlib

from faresight.llm import mixing
from faresight.llm.mixing import capped_targets, mix_sources, sainte_lague
from faresight.llm.sharding import Shard, shard_documents, uniform_tree

WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return (text or "").encode().split()


def test_capped_targets_reshare_the_excess():
    sizes, weights = [100, 10, 40], [3, 1, 2]
    t = capped_targets(sizes, weights, 225, 2)
    assert t[1] <= 20 and t[2] <= 80 and sum(t) == pytest.approx(225)
    assert capped_targets([10, 10], [1, 1], 1000, 2) == [20, 20]
    assert capped_targets([0, 10], [3, 1], 15, 2) == [0, 15]
    assert capped_targets([], [], 0, 2) == []


def brute_sainte_lague(wanted, limits, house):
    seats = [0] * len(wanted)
    for _ in range(house):
        open_ = [i for i, s in enumerate(seats) if s < limits[i] and wanted[i] > 0]
        if not open_:
            break
        i = max(open_, key=lambda i: (wanted[i] / (2 * seats[i] + 1), -i))
        seats[i] += 1
    return seats


def test_sainte_lague_is_the_highest_quotients_method():
    wanted, limits = [53.2, 24.7, 16.1, 6.0, 0.0], [200, 15, 200, 200, 5]
    before = [0] * 5
    for house in range(0, 130, 7):
        seats = sainte_lague(wanted, limits, house)
        assert seats == brute_sainte_lague(wanted, limits, house)
        assert all(b <= s for b, s in zip(before, seats, strict=True))
        before = seats


def test_mix_hits_targets_and_repeats_at_most_twice(docs, rows):
    out = mix_sources(docs, block_words=4).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    size, took = Counter(), Counter()
    for r in out:
        assert r.taken <= 2 * r.size
        assert r.taken == sum(p.length for p in r.picks)
        assert all(0 <= p.start and p.length > 0 and p.start + p.length <= r.size for p in r.picks)
        size[r.source] += r.size
        took[r.source] += r.taken
    assert sum(size.values()) == sum(len(words(r[1])) for r in rows)
    for r in out:
        assert r.source_size == size[r.source]
        assert abs(took[r.source] - r.target) <= 5
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = capped_targets([size[s] for s in order], mixing.cyclic_weights(order), 1.5 * sum(size.values()), 2)
    assert {r.source: r.target for r in out} == pytest.approx(dict(zip(order, want, strict=True)))


def independent_targets(sizes, weights, budget, epochs=2):
    """min(epochs * size, level * weight) with the level, found by bisection, that spends the budget."""
    budget = min(budget, sum(epochs * s for s, w in zip(sizes, weights, strict=True) if w > 0))
    low, high = 0.0, 1.0 + max((epochs * s / w for s, w in zip(sizes, weights, strict=True)), default=0.0)
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(epochs * s, level * w) for s, w in zip(sizes, weights, strict=True)) < budget:
            low = level
        else:
            high = level
    return [min(epochs * s, high * w) for s, w in zip(sizes, weights, strict=True)]


@pytest.mark.parametrize("block_words", [4, 32])
def test_mix_targets_and_taken_word_by_word(docs, rows, block_words):
    """Streams as lists of words, blocks as slices, one take after the other."""
    per_source = {}
    for doc_id, text, _, source in rows:
        per_source.setdefault(source, []).append((doc_id, len(words(text))))
    order = sorted(per_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, n in per_source[s]) for s in order]
    targets = independent_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(sizes))
    blocks = [max(1, round(n / block_words)) if n else 0 for n in sizes]
    wanted = [t * b / n if n else 0.0 for t, b, n in zip(targets, blocks, sizes, strict=True)]
    seats = brute_sainte_lague(wanted, [2 * b for b in blocks], round(sum(wanted)))

    def place(doc_id):
        h = xxhash.xxh64_intdigest((20).to_bytes(4, "little"), seed=xxhash.xxh64_intdigest(
            doc_id.to_bytes(8, "little", signed=True), seed=42))
        return (h - (1 << 64) if h >> 63 else h)

    taken = Counter()
    for i, s in enumerate(order):
        stream = [d for d, n in sorted(per_source[s], key=lambda x: (place(x[0]) % 1024, place(x[0]), x)) for _ in range(n)]
        if not stream:
            continue
        base, rem = divmod(len(stream), blocks[i])
        cuts = [0]
        for b in range(blocks[i]):
            cuts.append(cuts[-1] + base + (b < rem))
        mult, shift = mixing._permutation(blocks[i], f"20:{s!r}")
        turn = {(mult * b + shift) % blocks[i]: b for b in range(blocks[i])}
        assert len(turn) == blocks[i]
        for t in range(seats[i]):
            b = turn[t % blocks[i]]
            taken.update(stream[cuts[b]:cuts[b + 1]])
    out = mix_sources(docs, block_words=block_words).collect()
    got = Counter()
    for r in out:
        got[r.doc_id] += r.taken
        assert r.target == pytest.approx(targets[order.index(r.source)], abs=1e-6)
    assert +got == taken


def test_mix_reruns_agree_on_another_layout(docs):
    def got(d):
        return sorted((r.doc_id, r.size, r.taken) for r in mix_sources(d).collect())
    assert got(docs) == got(docs.repartition(3))


def test_mix_shards_hold_the_mix(docs):
    """Every output shard's quota per source is its part of the seats, to a block."""
    out = mix_sources(docs, block_words=4, shards=4).collect()
    target = {r.source: r.target for r in out}
    per_shard = Counter()
    for r in out:
        for p in r.picks:
            per_shard[r.source, p.shard] += p.length
    for source, t in target.items():
        for shard in range(4):
            assert abs(per_shard[source, shard] - t / 4) <= 15


def test_mix_empty(empty):
    assert mix_sources(empty).collect() == []


def brute_shard(doc_id, tree, seed=9):
    def spark_hash(value, state):
        return xxhash.xxh64_intdigest(value, seed=state)

    key = 42 if doc_id is None else spark_hash(doc_id.to_bytes(8, "little", signed=True), 42)
    key = spark_hash(seed.to_bytes(4, "little"), key)  # the seed is an int column
    signed = key - (1 << 64) if key >> 63 else key

    def draw(level, node, weight):
        h = spark_hash(signed.to_bytes(8, "little", signed=True), 42)
        h = spark_hash(f"{level}{node}".encode(), h)
        return -math.log(((h >> 11) + 0.5) / 2 ** 53) / weight, node

    def best(level, weights):
        return min(draw(level, n, w) for n, w in weights.items())[1]

    def total(shards, attr):
        out = {}
        for s in shards:
            out[getattr(s, attr)] = out.get(getattr(s, attr), 0) + s.weight
        return out

    region = best("region", total(tree, "region"))
    rack = best("rack", total([s for s in tree if s.region == region], "rack"))
    return best("shard", {s.number: s.weight for s in tree if s.rack == rack})


def test_shards_match_brute_force(with_null_id):
    old, new = uniform_tree(40), uniform_tree(41)
    source = with_null_id.select("doc_id", "text").collect()
    out = shard_documents(with_null_id, old, new).collect()
    assert len(out) == len(source)
    crcs = Counter((r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 16) for r in source)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in out) == crcs
    slots = {}
    for r in out:
        assert r.law == "key" and r.shard == brute_shard(r.doc_id, old)
        assert r.grown_shard == brute_shard(r.doc_id, new) and r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_movement_stays_between_changed_subtrees(spark):
    ids = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    old = uniform_tree(40)
    heavier = [Shard(s.number, s.region, s.rack, 3.0 if s.number == 7 else 1.0) for s in old]
    out = shard_documents(ids, old, heavier).collect()
    moved = [r for r in out if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 7 or r.grown_shard // 5 == 1 or r.grown_shard // 10 == 0 for r in moved)
    assert all(r.shard // 10 == 0 or r.grown_shard // 10 == 0 for r in moved)
    share = Counter(r.grown_shard for r in out)
    assert share[7] / 20000 == pytest.approx(3 / 42, rel=0.15)
    assert max(Counter(r.shard for r in out).values()) < 1.25 * 500


def test_shards_empty_and_bad_trees(empty, docs):
    assert shard_documents(empty, uniform_tree(3)).collect() == []
    with pytest.raises(ValueError):
        shard_documents(docs, [Shard(0, 0, 0), Shard(0, 0, 0)])
    with pytest.raises(ValueError):
        shard_documents(docs, [Shard(0, 0, 0, 0.0)])
