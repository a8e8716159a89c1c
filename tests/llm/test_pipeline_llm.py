import re
from collections import Counter

import corpus_pipeline as pipeline
from faresight.llm import queries, tokens
from faresight.llm.line_spread import MIN_SITES
from faresight.llm.packing import WINDOW
from faresight.sources.tables import read_table


def test_stages_and_run(spark, check_dir):
    docs = read_table(spark, check_dir, "documents")
    seen = [docs.collect()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, check_dir)
        assert docs.columns == pipeline.COLUMNS
        docs = pipeline.materialize(docs, "test-stage")
        seen.append(docs.collect())
    start, good, lines, unique, mixed = seen
    ids = [[r.doc_id for r in rows] for rows in seen]

    # base rule: too short or too repetitive; labels: two bad rows of which 123 also repeats itself
    assert {1, 2, 3, 4, 5, 6, 121, 122, 123} <= set(ids[0]) - set(ids[1])
    assert {10, 50, 80, 120}.issubset(ids[1])

    spread = {}
    for r in good:
        for x in r.text.split("\n"):
            spread.setdefault(x, set()).add(r.source)
    wide = {x for x, s in spread.items() if len(s) >= MIN_SITES}
    after = Counter(x for r in lines for x in r.text.split("\n"))
    assert "shared line of the site here" in wide and all(after[x] == 1 for x in wide)
    assert all(r.n_chars == len(r.text) or r.n_chars == 0 for r in lines)

    assert len(ids[3]) == len(set(ids[3])) and set(ids[3]) <= set(ids[2])
    assert 80 in ids[3] and len({i for i in ids[3] if 80 <= i < 94}) < len({i for i in ids[2] if 80 <= i < 94})
    assert {r.doc_id: r.text for r in unique}.items() <= {r.doc_id: r.text for r in lines}.items()

    per_doc, size = Counter(), {r.doc_id: len(r.text.split()) for r in unique}
    for r in mixed:
        per_doc[r.doc_id] += len(r.text.split())
        assert set(r.text.split()) <= set({x.doc_id: x.text for x in unique}[r.doc_id].split())
    assert all(per_doc[d] <= 2 * size[d] for d in per_doc) and max(Counter(ids[4]).values()) == 2

    pieces = pipeline.run(spark, check_dir).collect()
    enc = tokens.encoder(tokens.vocabulary_path("word_bpe_49k.json"), tokens.word_parts)
    want = Counter()
    for r in mixed:
        want[r.doc_id] += len(enc.encode(r.text)) // enc.dtype.itemsize + 1
    got, filled = Counter(), Counter()
    for p in pieces:
        got[p.doc_id] += p.length
        filled[p.sequence_id] += p.length
    assert got == want
    assert all(n == WINDOW for s, n in filled.items() if s < len(filled) - 1)


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES)
    assert numbers == list(range(1, 14))
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is pipeline.run and set(entry.oracle_sql()) <= set(entry.queries())
