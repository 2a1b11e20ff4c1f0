"""Chat formatting with column expressions only: conversations become marked text with a loss mask.

A conversation is `<|turn|>role<|text|>text<|next|>text<|end|>` once per block; adjacent turns of
one role share a block. In roles and texts `&` and `<` are written `&amp;` and `&lt;`, so no
marker can occur inside them and the original turns can be read back exactly.

Defined cases: a null role or text counts as empty; turns with the same number are ordered by
role, then text; a null turn number comes first; rows with a null conversation id form one
conversation; repeated rows are repeated turns; an empty table gives no rows. Only the four named
columns are used, whatever else the table has.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def format_conversations(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text",
    learned_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: `(key, pieces, formatted)`.

    `pieces` are the consecutive parts of `formatted` as `(text, loss)`; `loss` is true for the
    texts of `learned_role`, the only part a model should be trained on.
    """
    ordered = turns.select(
        F.col(key).alias("key"),
        F.struct(
            F.col(order).alias("n"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    ).groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    def block(turn: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        opening = F.concat(F.lit(TURN), escape(turn["role"]), F.lit(TEXT))
        head = F.when(before.eqNullSafe(turn["role"]), F.lit(NEXT)).otherwise(opening)
        tail = F.when(after.eqNullSafe(turn["role"]), F.lit("")).otherwise(F.lit(END))
        return F.array(
            piece(head, F.lit(False)),
            piece(escape(turn["text"]), turn["role"] == learned_role),
            piece(tail, F.lit(False)),
        )

    pieces = ordered.select("key", F.flatten(F.transform("turns", block)).alias("pieces"))
    return pieces.select(
        F.col("key").alias(key), "pieces", _joined(F.transform("pieces", lambda p: p["text"])).alias("formatted")
    )


def read_turns(formatted: Column) -> Column:
    """The original turns of a formatted conversation, as an array of `(role, text)`."""
    marked = lambda marker: marker.replace("|", r"\|")
    blocks = F.slice(F.split(formatted, marked(TURN)), 2, 1 << 30)

    def turns_of(block: Column) -> Column:
        role = unescape(F.substring_index(block, TEXT, 1))
        texts = F.split(F.replace(F.substring_index(block, TEXT, -1), F.lit(END), F.lit("")), marked(NEXT))
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def learned_text(pieces: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return _joined(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])))
