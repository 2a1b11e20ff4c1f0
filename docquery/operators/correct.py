"""Grading of retrieved hits and the bounded rewrite-and-retry loop."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.functions.hits import context, top_score
from docquery.functions.text import three_decimals
from docquery.hooks import Hook, Hooks
from docquery.operators.gating import decide
from docquery.operators.retrieve import Index, retrieve
from docquery.settings import DEFAULTS, Settings
from docquery.shared import materialize

NO_DOCUMENTS = "no documents retrieved"


def grade(rows: DataFrame, judge: Hook, gate: float = DEFAULTS.grade_gate) -> DataFrame:
    """Add `top_score` and `grade STRUCT<relevant, reason, used_llm>` to `(question, hits, ...)`.

    No hits: not relevant. Best score at the gate or above: relevant without a
    judge. Only the rest is judged, on the context a generator would see.
    """
    scored = rows.withColumn("top_score", top_score(F.col("hits")))
    empty = F.size("hits") == 0
    passed = F.col("top_score") >= gate
    judged = decide(
        scored,
        settled=empty | passed,
        otherwise=~empty,
        hook=judge,
        inputs=[F.col("question"), context(F.col("hits"))],
        name="relevant",
    )
    shown = three_decimals(F.col("top_score"))
    verdict = F.when(F.col("relevant"), "yes").otherwise("no")
    reason = (
        F.when(empty, NO_DOCUMENTS)
        .when(passed, F.concat(F.lit("top score "), shown, F.lit(f" >= {gate} (pre-gate)")))
        .otherwise(
            F.concat(F.lit("top score "), shown, F.lit(" below gate; LLM judge said "), verdict)
        )
    )
    return judged.withColumn(
        "grade",
        F.struct(
            F.col("relevant"), reason.alias("reason"), (~empty & ~passed).alias("used_llm")
        ),
    ).drop("relevant")


def correction_loop(
    questions: DataFrame,
    find: Callable[[DataFrame], DataFrame],
    judge: Hook,
    rewriter: Hook,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """`(question_id, question, hits, top_score, correction)` after at most `max_rewrites` retries.

    Each round answers the rows that are graded relevant and carries the weak ones
    into the next with a query rewritten from the original question. The last
    round's hits count, even if they are worse. A round is written out before it is
    split, so its retrieval runs once and the lineage stays short.
    """
    open_rows = questions.select("question_id", "question", F.col("question").alias("query"))
    answered = []
    for attempt in range(1, settings.max_rewrites + 2):
        last = attempt == settings.max_rewrites + 1
        graded = materialize(grade(find(open_rows), judge, settings.grade_gate), "round")
        settled = graded if last else graded.filter(F.col("grade.relevant"))
        answered.append(_trace(settled, attempt))
        if last:
            break
        weak = graded.filter(~F.col("grade.relevant"))
        open_rows = weak.select(
            "question_id", "question", rewriter(F.col("question"), F.col("hits")).alias("query")
        )
        open_rows = materialize(open_rows, "rewritten") if rewriter.costly else open_rows
    result = answered[0]
    for part in answered[1:]:
        result = result.unionByName(part)
    return result


def _trace(rows: DataFrame, attempt: int) -> DataFrame:
    rewritten = F.col("query") if attempt > 1 else F.lit(None).cast("string")
    return rows.select(
        "question_id",
        "question",
        "hits",
        "top_score",
        correction(
            F.lit(attempt), F.col("grade.relevant"), F.col("grade.reason"), rewritten
        ).alias("correction"),
    )


def correction(attempts: Column, relevant: Column, reason: Column, rewritten: Column) -> Column:
    return F.struct(
        attempts.cast("int").alias("attempts"),
        relevant.alias("graded_relevant"),
        reason.alias("grade_reason"),
        rewritten.cast("string").alias("rewritten_query"),
    )


def no_correction() -> Column:
    return correction(F.lit(1), F.lit(True), F.lit(""), F.lit(None))


def corrected_hits(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS
) -> DataFrame:
    return correction_loop(
        questions,
        lambda rows: retrieve(rows, index, hooks, settings),
        hooks.grade_judge,
        hooks.rewriter,
        settings,
    )


def linear_hits(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS
) -> DataFrame:
    """One retrieval round without grading."""
    asked = questions.select("question_id", "question", F.col("question").alias("query"))
    return retrieve(asked, index, hooks, settings).select(
        "question_id", "question", "hits",
        top_score(F.col("hits")).alias("top_score"),
        no_correction().alias("correction"),
    )
