"""Scoring of answers by three judges."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.functions.hits import passages
from docquery.hooks import Hooks

# The metric names, as dashboards show them.
METRICS = ["faithfulness", "answer_relevancy", "context_precision"]


def with_context(answers: DataFrame) -> DataFrame:
    """Add `context`: the passages of the hits in order, else the SQL, else nothing."""
    from_hits = F.when(F.size("hits") > 0, F.array_join(passages(F.col("hits")), "\n"))
    return answers.withColumn("context", F.coalesce(from_hits, F.col("sql"), F.lit("")))


def judged_items(answers: DataFrame, hooks: Hooks) -> DataFrame:
    """`(question, route, faithfulness, answer_relevancy, context_precision)` as 0 or 1 per answer."""
    rows = with_context(answers)
    question, text, context = F.col("question"), F.col("text"), F.col("context")
    verdicts = [
        hooks.faithfulness(text, context),
        hooks.relevancy(question, text),
        hooks.precision(question, context),
    ]
    scores = [
        F.coalesce(v.cast("double"), F.lit(0.0)).alias(m) for m, v in zip(METRICS, verdicts)
    ]
    keys = [c for c in ("question_id",) if c in rows.columns]
    return rows.select(*keys, "question", "route", *scores)


def mean_scores(items: DataFrame) -> DataFrame:
    """`(metric, score, n)`: three rows, with score 0 over an empty set."""
    means = [F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in METRICS]
    whole = items.agg(F.count("*").alias("n"), *means)
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in METRICS]
    )
    return whole.select(F.explode(pairs).alias("p"), "n").select("p.metric", "p.score", "n")
