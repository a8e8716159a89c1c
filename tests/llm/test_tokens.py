import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faresight.llm import token_files, tokens
from faresight.llm.common import shared_path
from faresight.llm.packing import Turns, pack_documents

BYTE, WORD = tokens.vocabulary_path("byte_bpe_50k.json"), tokens.vocabulary_path("word_bpe_49k.json")


@pytest.mark.parametrize(("path", "parts"), [(BYTE, tokens.byte_parts), (WORD, tokens.word_parts)])
@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(text=st.text(alphabet=st.one_of(
    st.sampled_from(list(" \t\n\r\x0b\x0c\x1c\x85  ​'’.,!1²ªéÉİßſЖ漢é<|>_")), st.characters(codec="utf-8")), max_size=60))
def test_parts_encode_like_the_whole_text(path, parts, text):
    enc = tokens.encoder(path, parts)
    assert tokens.same(enc.tokenizer.encode(text, add_special_tokens=False).ids, enc.encode(text), enc.dtype)


@pytest.mark.parametrize(("path", "parts"), [(BYTE, tokens.byte_parts), (WORD, tokens.word_parts)])
def test_special_strings_and_full_cache(path, parts, monkeypatch):
    enc = tokens.Encoder(path, parts)
    monkeypatch.setattr(tokens, "MAX_PARTS", 8)
    for text in ("a  <|endoftext|> b", "It's we'll DON'T  two\n\n three", "x" * 5000, "", " ", "one two three four five six seven eight nine"):
        assert tokens.same(enc.tokenizer.encode(text, add_special_tokens=False).ids, enc.encode(text), enc.dtype)


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark, with_null_id):
    folder = shared_path(spark, "test-tokens")
    manifest = token_files.write_token_files(with_null_id, folder, BYTE, parts=6)
    source = with_null_id.select("doc_id", "text").collect()
    tok = tokens.encoder(BYTE, tokens.byte_parts).tokenizer
    want = sorted((-1 if r.doc_id is None else r.doc_id, crc(ids := [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]), len(ids))
                  for r in source)
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(x[0] for x in want)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert manifest["ids"] == at and manifest["docs"] == len(source) and manifest["id_type"] == "<u2"
    assert len(manifest["parts"]) > 1


def test_token_files_empty(spark, empty):
    folder = shared_path(spark, "test-tokens")
    assert token_files.write_token_files(empty, folder, BYTE)["docs"] == 0
    assert token_files.read_token_files(spark, folder).collect() == []


def check_pieces(rows, source, window):
    tok = tokens.encoder(WORD, tokens.word_parts).tokenizer
    want = {}
    for r in source:
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.setdefault(r.doc_id, []).append(ids)
    windows, covered = {}, {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
        assert any(len(ids) == r.doc_tokens and crc(ids[r.start:r.start + r.length]) == r.ids_crc32 for ids in want[r.doc_id])
    assert covered == {d: sum(map(len, v)) for d, v in want.items()}
    assert sorted(windows) == list(range(len(windows)))
    for s, pieces in windows.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or s == len(windows) - 1
    return windows


def test_packing_covers_every_id_once(docs):
    source = docs.select("doc_id", "text").collect()
    for window, quantum in ((256, 32), (64, 64)):
        check_pieces(pack_documents(docs, WORD, window=window, quantum=quantum).collect(), source, window)


def test_windows_keep_the_mix(docs):
    rows = pack_documents(docs, WORD, window=512, quantum=32).collect()
    total = sum(r.length for r in rows)
    share = {}
    for r in rows:
        share[r.source] = share.get(r.source, 0) + r.length / total
    n = max(r.sequence_id for r in rows)
    for until in range(1, n, 5):
        for source, p in share.items():
            have = sum(r.length for r in rows if r.source == source and r.sequence_id < until)
            assert abs(have - p * 512 * until) <= 64 + 32 * len(share) * p


def test_other_targets_and_queues_that_end(docs):
    sources = {r.source for r in docs.select("source").distinct().collect()}
    shares = {s: 5.0 if s == "hot" else 1.0 for s in sources}
    rows = pack_documents(docs, WORD, shares=shares, window=128, quantum=16).collect()
    check_pieces(rows, docs.select("doc_id", "text").collect(), 128)


def test_packing_empty(empty):
    assert pack_documents(empty, WORD).collect() == []


def test_turns_are_a_permutation_of_all_ids():
    totals, shares = [1000, 37, 512, 1], [0.5, 0.2, 0.2, 0.1]
    turns = Turns(totals, shares, 16)
    seen = []
    for q, n in enumerate(totals):
        _, a, m, pos = turns.pieces(np.array([q]), np.array([0]), np.array([n]), 64)
        assert a.tolist() == np.concatenate(([0], np.cumsum(m)[:-1])).tolist()
        seen += [p + i for p, k in zip(pos.tolist(), m.tolist(), strict=True) for i in range(k)]
    assert sorted(seen) == list(range(sum(totals)))
    with pytest.raises(ValueError):
        Turns([1], [0.0], 16)
