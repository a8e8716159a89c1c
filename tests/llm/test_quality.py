import random
import re
from collections import Counter

import pytest

from faresight.llm import quality
from faresight.llm.quality import FEATURES, learn_rules, quality_rules, text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(set(w)))


def test_statistics_match_brute_force(spark, docs, rows):
    texts = [r[1] for r in rows] + ["a a a a a a", "a b c d e a b c d e", "l\nl\n\n l\nl", "é é\té\x0b漢\x0c\U0001f600 x",
                                    "x y z v w q x y z v w " * 30, "\n\n", "a b c d e", "p q r s t p q r s"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in text_statistics(frame).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_distinct_words) == brute(text), text


def labelled(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        bad = rng.random() < 0.3
        kind = rng.random() < 0.5
        row = {"mean_word_chars": rng.uniform(4, 6), "symbols_per_word": rng.uniform(0, 0.05), "dup_line_share": 0.0,
               "repeat_share": rng.uniform(0, 0.1), "distinct_share": rng.uniform(0.5, 0.9), "words": rng.uniform(20, 500)}
        if bad and kind:
            row["symbols_per_word"] = rng.uniform(0.2, 1)
        elif bad:
            row["mean_word_chars"], row["words"] = rng.uniform(8, 12), rng.uniform(20, 60)
        out.append({**row, "bad": int(bad), "prune": int(rng.random() < 1 / 3)})
    return out


def verdict(rules, row):
    return next((i for i, rule in enumerate(rules, 1) if all(c.holds(row) for c in rule)), 0)


def test_rules_generalise_to_held_out_rows():
    rules = learn_rules(labelled(1500, 1))
    held = labelled(3000, 2)
    assert 2 <= len(rules) <= quality.MAX_RULES and all(len(r) <= quality.MAX_CONDITIONS for r in rules)
    assert sum((verdict(rules, r) > 0) == bool(r["bad"]) for r in held) / len(held) > 0.98


def test_noise_learns_nothing_and_one_class_learns_nothing():
    rng = random.Random(3)
    rows = labelled(600, 4)
    for r in rows:
        r["bad"] = int(rng.random() < 0.5)
    assert len(learn_rules([{**r, **{f: rng.random() for f in FEATURES}} for r in rows])) <= 1
    assert learn_rules([{**r, "bad": 0} for r in rows]) == []
    assert learn_rules([]) == []


def test_verdicts_follow_the_list(spark, docs, rows):
    text = {}
    for i in range(300):
        rng = random.Random(i)
        words = [rng.choice("abcdefgh") * rng.randint(2, 6) + str(rng.randint(0, 99)) for _ in range(30)]
        text[1000 + i] = " ".join(w + "|" for w in words) if i % 3 == 0 else " ".join(words)
    frame = spark.createDataFrame([(k, v) for k, v in text.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 != 1), 9) for k in text] + [(5000, 0, 1), (None, 0, 1), (1001, None, 0)],
                                   "doc_id long, quality int, n_words int")
    got = {r.doc_id: r for r in quality_rules(frame, labels).collect()}
    assert len(got) == 300
    for k, r in got.items():
        assert not r.base_failed and r.kept == (r.rule == 0) == (k % 3 != 1)
    kinds = {r.rule for r in got.values()}
    assert kinds == {0, 1}


def test_base_rule_alone_without_labels(spark, docs, empty, rows):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules(docs, labels).collect()
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        n, *_, repeat, _ = brute(r[1])
        want[r[0], n, n < 10 or 100 * repeat > 20 * n] += 1
    assert Counter((r.doc_id, r.n_words, r.base_failed) for r in got) == want
    assert all(r.kept != r.base_failed for r in got)
    assert quality_rules(empty, labels).collect() == []


def test_verdict_is_one_native_expression(docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 40)], "doc_id long, quality int")
    plan = quality_rules(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("n", [4, 5, 6, 9, 10])
def test_short_texts(spark, n):
    frame = spark.createDataFrame([(1, " ".join(["w"] * n))], "doc_id long, text string")
    r = text_statistics(frame).first()
    assert r.n_repeat_words == brute(" ".join(["w"] * n))[4]
