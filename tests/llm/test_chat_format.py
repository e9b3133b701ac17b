import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from merchlens.llm import chat_format as q

PIECES = ["\\", "<", "s", ">", "/", "[", "]", "INST", *q.TEMPLATE.controls, "é", "\n", "a"]


@given(st.lists(st.sampled_from(PIECES), max_size=10).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_hides_marks(text):
    escaped = q.TEMPLATE.escape(text)
    assert q.TEMPLATE.unescape(escaped) == text
    assert not any(c in escaped for c in q.TEMPLATE.controls)


def test_round_trip_of_odd_rows(spark):
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "b"), (1, 0, "user", None),
            (2, 0, None, "no role"), (2, 0, "tool\n[SAYS]", "x"), (2, 0, "tool\n[SAYS]", "x"), (3, None, "system", ""), (None, 5, "assistant", "orphan")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seg", "2 as loss")
    got = {r.conv_id: r for r in q.digest_segments(q.format_conversations(df)).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [got[c].valid for c in (-1, 1, 2, 3, None)] == [True, True, False, False, False]
    assert (got[2].first_bad_turn, got[3].first_bad_turn) == (0, 1)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert q.digest_segments(q.format_conversations(df)).count() == 0
