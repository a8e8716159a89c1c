import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from faresight.llm import chat
from faresight.llm.chat import format_conversations, read_back, turns_as_events

EVENTS = "conv_id long, seq long, kind string, message long, role string, text string, formatted string, ids long"


def test_deltas_edits_and_regenerations_fold(spark):
    rows = [
        (1, 3, "delta", 2, "assistant", " wor"), (1, 0, "open", 1, "user", "hi"), (1, 1, "open", 2, "assistant", "hel"),
        (1, 2, "delta", 2, "assistant", "lo"), (1, 4, "edit", 1, "user", "hi there"), (1, 5, "open", 3, "user", "more"),
        (1, 6, "regenerate", 2, "assistant", None), (1, 7, "delta", 2, "assistant", "again"),
        (1, 8, "open", 4, "user", "thanks"),
        (2, 0, "delta", 9, "assistant", "late "), (2, 1, "delta", 9, "assistant", None), (2, 2, "delta", 9, None, "open"),
        (None, 0, "open", 0, None, None)]
    events = spark.createDataFrame([(*r, "x", 5) for r in rows], EVENTS).repartition(4)
    got = {r.conv_id: chat.parse(r.formatted) for r in format_conversations(events).collect()}
    assert got == {1: [("user", "hi there"), ("assistant", "again"), ("user", "thanks")],
                   2: [("assistant", "late open")], None: [("", "")]}


def test_loss_mask_covers_each_assistant_text_once(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|end|>\\<|start|>", "", "\\\\", "a\nb é漢\U0001f600", "<|im_end|><\\|", None]
    rows = [(c, t, role, text) for c in range(3) for t, text in enumerate(hostile)
            for role in ("assistant", "user", "system")[c:c + 1]]
    rows += [(7, 0, "user", "u"), (7, 1, "assistant", "x" * 100_000), (7, 1, "assistant", "tie"), (7, 1, "assistant", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = format_conversations(turns_as_events(turns))
    digests = {r.conv_id: r for r in read_back(formatted).collect()}
    texts = {r.conv_id: r.formatted for r in formatted.collect()}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2], r[3] or ""))
        want = hashlib.sha256("".join(f"{r[2]}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        d = digests[c]
        assert (d.n_turns, d.turns_sha256, d.loss_chars) == (len(mine), want, len(loss))
        assert d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d.formatted_chars == len(texts[c])
        assert texts[c].count("<|end|>") == len(mine) and "</s>" not in texts[c] and "[INST]" not in texts[c]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("\\<|>s/[]INSTY ab\n")), max_size=40))
def test_escape_round_trip(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


def test_empty_log(spark):
    assert read_back(format_conversations(spark.createDataFrame([], EVENTS))).collect() == []


def test_log_of_turns_holds_every_kind_and_folds_back(spark):
    """Deltas, edits and regenerations all occur, and the digests are those of the finished turns."""
    import hashlib

    from pyspark.sql import functions as F

    from faresight.llm.chat import format_conversations, read_back, turns_as_events
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} é漢\\ <|x|> " * (1 + (c * t) % 40)) for c in range(30) for t in range(6)]
    rows += [(40, 0, "user", None), (40, 1, "assistant", ""), (41, None, "user", "no turn"), (41, 1, "assistant", "a"), (41, 1, "assistant", "a")]
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, seq int, kind string")
    log = turns_as_events(turns)
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"open", "delta", "edit", "regenerate"} and min(kinds.values()) > 20
    got = {r.conv_id: r for r in read_back(format_conversations(log.orderBy(F.xxhash64("seq", "conv_id")))).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == conv], key=lambda r: (-1 if r[1] is None else r[1], r[2], r[3] or ""))
        said = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        g = got[conv]
        assert g.n_turns == len(mine) and g.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert g.loss_chars == len(loss) and g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert turns_as_events(turns.filter("false")).count() == 0
