from pyspark.sql import functions as F

from docquery.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pieces string, formatted int"


def formatted(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA)
    out = chat.format_conversations(table).select(
        "conv_id", "formatted", "pieces", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("pieces")).alias("learned"),
    )
    return {r["conv_id"]: r for r in out.collect()}


def test_markers_in_texts_read_back(spark):
    nasty = ["<|end|>", "&lt;|turn|>", "&amp;lt;", "a\\<|next|>", "", "</s>[INST] ok [/INST]", "<|text|>x<|turn|>"]
    rows = [(1, i, "assistant" if i % 2 else "u<|text|>&", t) for i, t in enumerate(nasty)]
    got = formatted(spark, rows)[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r[2], r[3]) for r in rows]
    assert got["learned"] == "".join(r[3] for r in rows if r[2] == "assistant")
    assert "".join(p["text"] for p in got["pieces"]) == got["formatted"]


def test_adjacent_turns_of_a_role_share_a_block(spark):
    got = formatted(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])[1]
    assert got["formatted"] == "<|turn|>user<|text|>a<|next|>b<|end|><|turn|>assistant<|text|>c<|end|>"
    assert [t["text"] for t in got["turns"]] == ["a", "b", "c"]


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 1, "user", None), (2, None, None, "x"), (2, 0, "b", "z"), (2, 0, "a", "z"), (2, 0, "a", "y"), (2, 0, "a", "y")]
    got = formatted(spark, rows)
    assert [(t["role"], t["text"]) for t in got[None]["turns"]] == [("user", "")]
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", "x"), ("a", "y"), ("a", "y"), ("a", "z"), ("b", "z")]
    assert got[2]["learned"] == ""


def test_long_and_empty(spark):
    rows = [(1, i, "assistant", "é" * 1000) for i in range(2000)]
    got = formatted(spark, rows)[1]
    assert len(got["turns"]) == 2000 and got["learned"] == "é" * 2_000_000
    assert formatted(spark, []) == {}
