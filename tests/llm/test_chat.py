import hashlib
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pageloom.llm import chat as C


@settings(max_examples=300, deadline=None)
@given(st.text(), st.lists(st.text(), max_size=3))
def test_round_trip(role, texts):
    parts = []
    for t in texts:
        parts += [{"type": "text", "text": t, "ref": None, "size": None}, {"type": "image", "text": None, "ref": "r", "size": 5}]
    row, number = C._format_turn(role, parts, 0, len)
    assert number == len(texts)
    got_role, got = C.parse_turn(row["formatted"])
    assert got_role == role and "".join(got) == "".join(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\</turn>:\n### Assistant", max_size=40))
def test_control_strings_are_never_left_in_a_text(text):
    assert C.unescape(C.escape(text)) == text
    row, _ = C._format_turn("assistant", [{"type": "text", "text": text, "ref": None, "size": None}], 0, len)
    assert re.sub(r"\\.", "", row["formatted"], flags=re.DOTALL).count("<") == 2
    assert "".join(C.unescape(row["formatted"][s["start"] : s["end"]]) for s in row["loss"]) == text


def test_attachments_are_numbered_and_counted(spark):
    part = "struct<type:string,text:string,ref:string,size:bigint>"
    rows = [
        (1, 1, "assistant", [("text", "seen", None, None), ("audio", None, "b.wav", 81)], 5),
        (1, 0, "user", [("text", "look <image:9>", None, None), ("image", None, "a.png", 784 * 2 + 1), ("document", None, "c.pdf", 2), ("video", None, "d", 7)], 5),
        (2, None, None, None, 5),
        (2, None, None, [("text", None, None, None)], 5),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>, seq int")
    got = {(r["conv_id"], r["seq"]): r for r in C.format_chats(turns).collect()}
    first = got[1, 0]
    assert first["formatted"] == "<turn:user>\nlook \\<image:9><image:1><document:2><other:3></turn>\n"
    assert [(a["number"], a["type"], a["ref"], a["tokens"]) for a in first["attachments"]] == [(1, "image", "a.png", 3), (2, "document", "c.pdf", 1024), (3, "other", "d", 0)]
    assert got[1, 1]["attachments"][0]["number"] == 4 and got[1, 1]["attachments"][0]["tokens"] == 3
    assert got[1, 1]["begin"] == len(first["formatted"]) and got[1, 1]["n_tokens"] > 3
    assert got[2, 0]["formatted"] == "<turn:>\n</turn>\n" and len(got) == 4


def test_digests_of_all_conversations(spark):
    rows = [(1, 1, "assistant", "b\\<"), (1, 0, "user", None), (1, 1, "assistant", "b\\<"), (None, 0, "assistant", "é😀"), (3, 0, "system", ""), (4, 0, "assistant", "x" * 300_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", C.text_parts())
    got = {r["conv_id"]: r for r in C.read_back(C.format_chats(turns)).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role, text or ""))
    for conv, own in by_conv.items():
        own.sort()
        loss = "".join(t for _, r, t in own if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x}\n{t}\n" for _, x, t in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert C.read_back(C.format_chats(turns.limit(0).where(F.lit(False)))).collect() == []
