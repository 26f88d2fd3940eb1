import hashlib

import pytest
from folioscope.llm import chat
from hypothesis import given, settings
from hypothesis import strategies as st

T = chat.Template()
PIECES = st.lists(st.sampled_from(["\\", "### ", ": ", " </turn>\n", "a", " ", "#", "</turn>", "\n", "é"]), max_size=12).map("".join)


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=5))
def test_escaping_is_reversible(turns):
    codec = chat.Codec(T)
    text = "".join(s for role, body in turns for s, _ in codec.segments(role, body))
    assert [(r, b) for r, b, _, _ in codec.read(text)] == turns


@pytest.mark.parametrize("body", ["ends with:", "ends with ###", "####", ": </turn>\n", "### </turn>\n", "\\", "\\### Assistant: </turn> ok", ""])
def test_boundaries(body):
    codec = chat.Codec(T)
    text = "".join(s for _ in range(2) for s, _ in codec.segments("user:", body))
    assert [(r, b) for r, b, _, _ in codec.read(text)] == [("user:", body)] * 2


def test_templates():
    for bad in ({"escape": "\\\\"}, {"opening": ""}, {"opening": "a\\"}, {"closing": "x: y"}):
        with pytest.raises(ValueError, match="control|escape"):
            chat.Template(**bad)


def _want(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    masked = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    return len(rows), hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows).encode()).hexdigest(), len(masked), hashlib.sha256(masked.encode()).hexdigest()


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "FRAGMENT_CHARS", 50)
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i} \\### ") for i in range(200)]
    rows += [(2, 0, "assistant", "first"), (2, 1, "user", None), (2, 1, "user", ""), (2, None, None, "early"), (None, 0, "user", "x"), (3, 0, "user", "y" * 100_000), (3, 0, "user", "y" * 100_000)]
    rows += [(4, t, "user", x) for t in (0, None) for x in ("b", "a", "ä", "Z", "", "a" * 300 + "2", "a" * 300 + "1", "a" * 99, "a" * 101, None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    for conv in {r[0] for r in rows}:
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _want([x for x in rows if x[0] == conv])
    assert got[1].n_out_of_order == 0 and got[2].n_out_of_order == 3 and got[3].n_out_of_order == 1
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0
