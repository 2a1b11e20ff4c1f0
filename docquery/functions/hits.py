"""Row-local work on the ranked hits of one question.

Hits travel as a short array (at most `top_k` entries) on the question's row, so
scoring, context building and grading need no further shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.text import three_decimals

HIT = (
    "struct<chunk_id: string, text: string, score: double, source: string, "
    "parent: string, title: string, rerank_score: double>"
)
NO_HITS = f"cast(array() as array<{HIT}>)"

# Layout of the context handed to a generator or judge.
BLOCK_GAP = "\n\n---\n\n"
NO_CONTEXT = "(no documents retrieved)"
UNKNOWN_SOURCE = "?"


def top_score(hits: Column) -> Column:
    first = F.get(hits, F.lit(0))
    return F.coalesce(first["rerank_score"], first["score"], F.lit(0.0))


def _passage(hit: Column) -> Column:
    return F.coalesce(F.nullif(hit["parent"], F.lit("")), hit["text"])


def passages(hits: Column) -> Column:
    """Parent text of each hit, falling back to the matched text."""
    return F.transform(hits, _passage)


def context(hits: Column) -> Column:
    """Headed blocks of distinct passages, each kept where it ranks first."""
    texts = passages(hits)

    def block(hit: Column) -> Column:
        section = F.when(hit["title"] != "", F.concat(F.lit(" | section: "), hit["title"]))
        return F.concat(
            F.lit("[source: "), hit["source"], F.coalesce(section, F.lit("")),
            F.lit(" | score: "), three_decimals(hit["score"]), F.lit("]\n"), _passage(hit),
        )

    first_seen = F.filter(hits, lambda h, i: F.array_position(texts, _passage(h)) == i + 1)
    return F.array_join(F.transform(first_seen, block), BLOCK_GAP)


def prompt(question: Column, hits: Column) -> Column:
    body = F.when(F.size(hits) > 0, context(hits)).otherwise(F.lit(NO_CONTEXT))
    return F.concat(F.lit("Context:\n"), body, F.lit("\n\nQuestion: "), question)


def squash(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))
