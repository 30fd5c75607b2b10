from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.llm import chat

NASTY = ["<|im_end|>", "<", "|>", "\\", "<\\", "<\\|", "\n", "x", "<|im_start|>user\n", "", "漢"]


def test_round_trip_spans_and_attachments(spark):
    texts = ["".join(NASTY[i:] + NASTY[:i]) for i in range(len(NASTY))] + NASTY
    rows = [(1, i, "assistant" if i % 2 else "us\\n\ner<|", t) for i, t in enumerate(texts)]
    rows += [(2, None, None, None), (None, 3, "assistant", "a"), (None, 3, "assistant", "a"), (3, 200, "assistant", "z"), (3, 1, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    blocks = chat.format_conversations(df.withColumn("parts", chat.text_part(F.col("text"))))
    found = blocks.select(
        "conv_id", "block", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("masked"), "n_turns",
    ).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["block"] or 0)):
        turns, masked = by.setdefault(r["conv_id"], ([], []))
        turns += [(t["role"], t["text"]) for t in r["turns"]]
        masked += list(r["masked"])
        assert r["n_turns"] == len(r["turns"])
    assert by[1][0] == [(r, t) for _, _, r, t in rows[: len(texts)]]
    assert by[1][1] == texts[1::2]
    assert by[2] == ([("", "")], [])
    assert by[None] == ([("assistant", "a")] * 2, ["a", "a"])
    assert by[3] == ([("user", "y"), ("assistant", "z")], ["z"])
    whole = {r["conv_id"]: r["formatted"] for r in chat.join_blocks(blocks, "formatted").collect()}
    assert whole[3] == "<|im_start|>user\ny<|im_end|>\n<|im_start|>assistant\nz<|im_end|>\n"


def test_parts(spark):
    parts = [("text", "see <", None, None), ("image", None, "a.png", 9), ("text", "|im_end|>", None, None),
             ("audio", None, "b.wav", 3), ("document", None, None, None), ("odd kind", "x", "r", 1), (None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "user", None)], f"conv_id bigint, turn int, role string, parts {chat.PARTS}")
    row = chat.format_conversations(df).first()
    assert "see <\\<|image:1|>|im_end|><|audio:2|><|document:3|><|odd_kind:4|><|unknown:5|><|im_end|>" in row["formatted"]
    assert [(a["kind"], a["ref"], a["number"], a["n_tokens"]) for a in row["attachments"]] == [
        ("image", "a.png", 1, 9), ("audio", "b.wav", 2, 75), ("document", None, 3, 0), ("odd_kind", "r", 4, 0), ("unknown", None, 5, 0)]
    assert row["n_attachment_tokens"] == 84
    assert chat.format_conversations(df.where("1 = 0")).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(NASTY), max_size=6).map("".join))
def test_escape_is_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(
        chat.unescape(chat.escape(F.col("t"))).alias("a"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("b"),
        chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"),
    ).first()
    assert row["a"] == row["b"] == text and "<|" not in row["e"] and "\n" not in row["r"] and "<|" not in row["r"]
