"""Chat formatting: exact round trips, and masks that hold each reply once."""

from __future__ import annotations

import hashlib

from trackloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
NASTY = ["\\### Assistant: </turn> ok", "### user: hi</turn>\n", "\\\\h\\l\\\\", "#<:\\", "", None, "é𝄞\r\n", "\\", "a" * 60000 + "\\#"]
ROLES = ["user", "assistant", "sys: tem\n###", "", None, "assistant ", "\\c:", "user", "assistant"]


def rows():
    out = [(1, i, r, t, "clash") for i, (r, t) in enumerate(zip(ROLES, NASTY, strict=True))]
    out += [(2, 0, "user", "alone", ""), (3, 0, "assistant", "only", ""), (4, 5, "assistant", "b", ""), (4, 5, "assistant", "a", ""), (4, 5, "assistant", "a", ""), (4, None, "user", "first", "")]
    return out + [(None, 0, "user", "no id", ""), (None, 1, "assistant", "yes", "")]


def test_round_trip(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = {r["conv_id"]: r for r in chat.read_back(chat.examples(df)).collect()}
    for conv in {r[0] for r in rows()}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows() if r[0] == conv))
        said = "".join(f"{role}\n{text}\n" for *_, role, text in own)
        loss = "".join(text for *_, role, text in own if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_examples(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi", ""), (1, 1, "assistant", "yo #1", ""), (1, 2, "user", "bye", "")], SCHEMA)
    got = [(r["example"], r["formatted"], r["formatted"][r["loss_start"] : r["loss_end"]]) for r in chat.examples(df).orderBy("example").collect()]
    assert got == [(1, "### user: hi</turn>\n### assistant: yo \\h1</turn>\n", "yo \\h1"), (2, "### user: hi</turn>\n### assistant: yo \\h1</turn>\n### user: bye</turn>\n", "")]
    assert chat.read_back(chat.examples(df.limit(0))).count() == 0
    assert [r["n_turns"] for r in chat.read_back(chat.examples(chat.with_probe(df))).filter("conv_id = -7").collect()] == [2]
