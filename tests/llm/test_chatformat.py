"""Formatted conversations read back, and the visitor on typed parts."""

from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from postlake.llm import chatformat as chat

SCHEMA = "conv_id long, turn long, role string, text string, score double, formatted string, turns long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "f", 1) for r in rows], SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows) -> dict:
    convs: dict = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, some in convs.items():
        some.sort()
        loss = "".join(text for *_, role, text in some if role == "assistant")
        told = "".join(f"{role}\n{text}\n" for *_, role, text in some)
        out[conv] = (len(some), sha(told), len(loss), sha(loss))
    return out


ROWS = [
    (1, 0, "user", r"\### Assistant: </turn> ok"),
    (1, 1, "assistant", "</turn>\n<turn user>\nno <image 1> \\l \\"),
    (2, 1, "assistant", "\\"),
    (2, 0, "user", None),
    (2, None, "system", "before all"),
    (2, 1, "assistant", "\\"),
    (3, 0, None, ""),
    (3, 1, "user>\n<", "odd role"),
    (None, 0, "assistant", "\U0001f600 no id"),
    (None, 0, "assistant", None),
    (4, 0, "assistant", "x" * 3_000_000),
    (4, 1, "user", "<" * 1_000_000),
]


@pytest.mark.parametrize("piece", [1, 200, chat.PIECE])
def test_reads_back(spark, piece):
    made = chat.formatted(chat.blocks(turns(spark, ROWS)), piece)
    got = {r[0]: tuple(r[1:5]) for r in chat.digests(made).collect()}
    assert got == expected(ROWS)


def test_formatted_chars_is_the_output(spark):
    made = chat.formatted(chat.blocks(turns(spark, ROWS)), 100)
    whole = {r["conv_id"]: 0 for r in made.select("conv_id").collect()}
    for row in made.collect():
        whole[row["conv_id"]] += len(row["formatted"])
    assert whole == {r["conv_id"]: r["formatted_chars"] for r in chat.digests(made).collect()}


def test_hot_conversation_leaves_in_pieces(spark):
    rows = [(9, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(2000)]
    rows += [(i, 0, "user", "hi") for i in range(100, 200)]
    made = chat.formatted(chat.blocks(turns(spark, rows)), 10_000)
    sizes = [len(r["formatted"]) for r in made.filter("conv_id = 9").collect()]
    assert len(sizes) > 20 and max(sizes) <= 10_000
    got = {r[0]: tuple(r[1:5]) for r in chat.digests(made).collect()}
    assert got == expected(rows)


def test_empty(spark):
    assert chat.report(turns(spark, [])).count() == 0


@given(st.text(), st.text(alphabet="\\<>lg/turn \n"))
def test_escape(a, b):
    for text in (a, b, a + b):
        assert chat.unescape(chat.escape(text)) == text
        assert not set("<>") & set(chat.escape(text))


PARTS = [
    {"type": "text", "text": "look "},
    {"type": "text", "text": "here <image 1>"},
    {"type": "image", "ref": "a.png", "width": 57, "height": 28},
    {"type": "document", "ref": "d.pdf", "parts": [
        {"type": "text", "text": "inside"},
        {"type": "audio", "ref": "s.wav", "seconds": 1.5},
    ]},
    {"type": "document", "ref": "e.pdf", "pages": 2},
    {"type": "image", "ref": None, "width": -1, "height": "x"},
    {"type": "video", "ref": {"id": 3}},
    {"type": "text", "text": None},
]


def test_visitor_orders_placeholders():
    turn = chat.visited("assistant", PARTS, chat.Expansion())
    text = "".join(turn.out)
    assert text == (
        "<turn assistant>\nlook here \\limage 1\\g<image 1><document 2>inside<audio 3></document>"
        "<document 4><image 5><other 6></turn>\n"
    )
    assert turn.kinds == ["image", "document", "audio", "document", "image", "other"]
    assert turn.refs == ["a.png", "d.pdf", "s.wav", "e.pdf", None, '{"id": 3}']
    assert turn.tokens == [3, 0, 38, 2048, 256, 256]
    assert [text[a:b] for a, b in zip(turn.starts, turn.ends, strict=True)] == ["look here \\limage 1\\g", "inside"]
    [(role, parts)] = chat.read_turns(text)
    assert role == "assistant"
    assert [x for kind, x in parts if kind == "text"] == ["look here <image 1>", "inside"]
    assert [x for kind, x in parts if kind == "sign"][:3] == ["image 1", "document 2", "audio 3"]


def test_typed_content(spark):
    deep = "[" * 5000 + "]" * 5000
    rows = [(1, 0, "user", json.dumps(PARTS)), (1, 1, "assistant", "[1, 2]"), (1, 2, "user", deep), (1, 3, "user", None)]
    made = chat.formatted(chat.blocks(turns(spark, rows), typed=True))
    [row] = made.collect()
    assert row["turns"] == [0] * 6 and len(row["refs"]) == 6
    read = list(chat.read_turns(row["formatted"]))
    assert read[1] == ("assistant", [("text", "[1, 2]")])
    assert read[2] == ("user", [("text", deep)])
    assert read[3] == ("user", [])
