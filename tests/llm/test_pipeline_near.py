"""The pipeline's Jaccard stage against brute force at five words and 0.8."""

import random
from collections import Counter

import corpus_pipeline as pipeline


def shingles(text, size):
    w = text.lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b, size=5):
    a, b = shingles(a, size), shingles(b, size)
    return len(a & b) / len(a | b) if a and b else 0.0


def edited(words, n, tag):
    """``words`` with ``n`` of them replaced, spread evenly."""
    out = list(words)
    for i in range(n):
        out[(2 * i + 1) * len(out) // (2 * n)] = f"{tag}{i}"
    return " ".join(out)


def corpus():
    rng = random.Random(11)
    rows = []
    for g in range(6):
        words = [f"g{g}w{rng.randrange(10_000)}" for _ in range(300)]
        rows += [(100 * g + n, edited(words, n, f"e{g}x{n}y")) for n in (0, 2, 4, 6, 9, 14)]
    return rows + [(900, "one two three"), (901, "one two three"), (902, "one two four"), (903, ""), (904, None)]


def kept_by_brute_force(rows):
    head = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, a in rows:
            for j, b in rows:
                if head[i] < head[j] and jaccard(a or "", b or "") >= 0.8:
                    head[j], changed = head[i], True
    return sorted(i for i in head if head[i] == i)


def test_near_copies_at_five_words_and_080(spark):
    rows = corpus()
    base, near = rows[0][1], rows[3][1]
    assert jaccard(base, near) >= 0.8 and jaccard(base, near, 3) < 0.9
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = sorted(r.doc_id for r in pipeline.near_duplicates(spark, docs, "").collect())
    assert got == kept_by_brute_force(rows)
    assert 6 not in got and 14 in got


def test_texts_under_one_id_are_judged_by_their_own_links(spark):
    rng = random.Random(12)
    one, two, three = (" ".join(f"{g}{rng.randrange(10_000)}" for _ in range(80)) for g in "abc")
    rows = [(1, one), (2, two), (7, one + " more"), (7, two + " more"), (7, three), (7, three), (None, one)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = {(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == {(1, one), (2, two), (7, three), (None, one)}


def test_mixing_takes_each_of_equal_rows_for_itself(spark):
    rng = random.Random(13)
    one, two = (" ".join(f"{g}{rng.randrange(10_000)}" for _ in range(600)) for g in "ab")
    rows = ([(1, one, "en", "s")] * 40 + [(1, one, "en", None), (1, one, None, "s"), (1, two, "en", "s"), (None, two, "en", "s")] * 2
            + [(3, "", "en", "s"), (4, None, "en", "s")])
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    held, took = Counter(), Counter()
    for r in rows:
        held[r[0], r[2], r[3]] += len((r[1] or "").split())
    out = pipeline.mix(spark, docs, "").collect()
    for r in out:
        took[r.doc_id, r.lang, r.source] += len(r.text.split())
    assert len(out) <= 2 * len(rows) and all(took[x] <= 2 * held[x] for x in took)
    # the two sources' 150 %: s takes what its weight of 3 of 4 and the rest of the capped null source give it
    total = sum(held.values())
    unsourced = sum(n for (_, _, s), n in held.items() if s is None)
    want = 1.5 * total - min(2 * unsourced, 1.5 * total / 4)
    assert abs(sum(n for (_, _, s), n in took.items() if s == "s") - want) <= 2 * pipeline.MIX_BLOCK_WORDS


def test_stages_of_an_empty_table(spark, empty, check_dir):
    docs = empty.select(pipeline.COLUMNS)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, check_dir)
        assert out.columns == pipeline.COLUMNS and out.collect() == []
    assert pipeline.pack(spark, docs, check_dir).collect() == []
