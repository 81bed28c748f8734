from __future__ import annotations

import hashlib

import pytest
from conftest import SF01
from oracle_check import duck
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.queries import OP8_SQL, op8_chat_parts

PART = f"array<{chat.PART}>"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return kind, text, ref, width, height, seconds, pages


def conversations(spark, rows):
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {PART}")


NASTY = ["\\### Assistant: </turn> ok", "<|end|>", "<\\|end|>", "\\", "\\\\<|", "<<||", "|><|turn|>user<|text|>", "a\n\nb", "", "ü\U0001f600<"]


def test_texts_survive_and_marks_cannot_be_forged(spark):
    rows = [(i, t, role, [part("text", x)]) for i, x in enumerate(NASTY) for t, role in ((0, "user<|"), (1, "assistant"))]
    out = {r.conv_id: r for r in chat.read_chats(chat.format_chats(conversations(spark, rows))).collect()}
    for i, x in enumerate(NASTY):
        assert [(t.role, t.text) for t in out[i].turns] == [("user<|", x), ("assistant", x)]
        assert out[i].loss_text == x


def test_marks_cannot_be_forged_across_parts(spark):
    cuts = [["a<", "|end|>b"], ["a<", "", None, "|end|><", "|turn|>user<", "|text|>x"], ["<\\", "|end|>"], ["<", "<", "|", "|"], ["|end|>", "|<"]]
    rows = [(i, t, "assistant", [part("text", x) for x in cut]) for i, cut in enumerate(cuts) for t in (0, 1)]
    image = [part("text", "a<"), part("text", "|b<"), part("image", ref="r", width=28, height=28), part("text", "|c")]
    df = conversations(spark, [*rows, (9, 0, "assistant", image)])
    formatted = chat.format_chats(df)
    out = {r.conv_id: r for r in chat.read_chats(formatted).collect()}
    for i, cut in enumerate(cuts):
        text = "".join(x or "" for x in cut)
        assert [(t.role, t.text) for t in out[i].turns] == [("assistant", text)] * 2
        assert out[i].loss_text == text * 2
    r = formatted.where("conv_id = 9").first()
    assert r.formatted == "<|turn|>assistant<|text|>a<\\|b<<|image:r|>|c<|end|>"
    assert [r.formatted[a.start :].startswith("<|image:r|>") for a in r.attachments] == [True]


def test_attachments(spark):
    parts = [
        part("text", "see <|"), part("image", ref="a<|b", width=57, height=28), part("text", "and"),
        part("audio", ref="s", seconds=1.01), part("document", ref=None, pages=3), part("video", "kept as text"),
    ]
    r = chat.format_chats(conversations(spark, [(1, 0, "user", parts), (1, 1, "assistant", [part("text", "yes")])])).first()
    content = "see <\\|<|image:a<\\|b|>and<|audio:s|><|document:|>kept as text"
    assert r.formatted == f"<|turn|>user<|text|>{content}<|end|><|turn|>assistant<|text|>yes<|end|>"
    assert [(a.turn, a.part, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, 1, "image", "a<|b", 3), (0, 3, "audio", "s", 26), (0, 4, "document", "", 1536)]
    assert all(r.formatted[a.start :].startswith(f"<|{a.type}:") for a in r.attachments)
    assert r.expanded_tokens == 3 + 26 + 1536
    assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == ["yes"]


def test_typed_parts_come_back(spark):
    """References and texts that hold marks, ends of marks and escapes."""
    refs = ["a", 'a"|>', "|>", "a|", "|", "<", "a<", "a<|", "\\", "\\>", "|\\>", "<|image:x|>", "<|end|>", "", "a\nb"]
    rows = []
    for i, ref in enumerate(refs):
        for j, text in enumerate(["hi", "|>", "x|>hi", "end|>", "|x", "<|image:r|>", "\\", "a|>b|>c", "\\>"]):
            rows.append((100 * i + j, 0, "user", [part("text", text), part("image", ref=ref), part("text", text), part("audio", ref=ref)]))
    formatted = chat.format_chats(conversations(spark, rows))
    assert "Python" not in chat.read_parts(formatted)._jdf.queryExecution().toString()
    out = {r.conv_id: [(t.role, [tuple(p) for p in t.parts]) for t in r.turns] for r in chat.read_parts(formatted).collect()}
    assert out == {
        c: [(role, [(p[0], p[1] if p[0] == "text" else p[2]) for p in ps])] for c, _, role, ps in rows}
    assert len({r.formatted for r in formatted.collect()}) == len(rows)


def test_odd_rows(spark):
    long = "word " * 50000
    rows = [
        (None, 0, "user", [part("text", "no id")]), (2, None, None, None), (2, 0, "assistant", []), (3, 1, "b", [part("text", "2")]),
        (3, 1, "a", [part("text", "3")]), (3, 1, "a", [part("text", "1")]), (4, 0, "assistant", [part("text", long)]),
        (5, 0, "user", [part(None, None)]), (6, 0, "assistant", [part("text", "x")]), (6, 0, "assistant", [part("text", "x")]),
    ]
    df = conversations(spark, rows).selectExpr("*", "1 AS turns", "2 AS formatted")
    out = {r.conv_id: ([tuple(t) for t in r.turns], r.loss_text) for r in chat.read_chats(chat.format_chats(df)).collect()}
    assert out == {
        None: ([("user", "no id")], ""), 2: ([("", ""), ("assistant", "")], ""),
        3: ([("a", "1"), ("a", "3"), ("b", "2")], ""), 4: ([("assistant", long)], long), 5: ([("user", "")], ""),
        6: ([("assistant", "x"), ("assistant", "x")], "xx"),
    }
    assert chat.format_chats(conversations(spark, [])).count() == 0


def test_native_and_equal_to_sql(spark):
    df = op8_chat_parts(spark, SF01)
    assert "Python" not in df._jdf.queryExecution().toString()
    rows = sorted(map(tuple, df.collect()))
    assert rows == sorted(duck(SF01).execute(OP8_SQL).fetchall())
    odd = next(r for r in rows if r[0] == -7)
    text = "\\### Assistant: </turn> ok"
    assert odd[2] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


@pytest.mark.parametrize("text", NASTY)
def test_escape_has_no_mark(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    r = df.select("t", "e", chat.unescape(df.e).alias("u")).first()
    assert "<|" not in r.e and r.u == text
