"""A batch of questions from screening to masked answers."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.functions.guards import BLOCKED_TEXT
from docquery.functions.hits import NO_HITS, prompt
from docquery.hooks import Hooks
from docquery.operators.correct import corrected_hits, linear_hits, no_correction
from docquery.operators.firewall import input_firewall, output_firewall
from docquery.operators.retrieve import Index
from docquery.operators.statements import route_questions, structured_branch
from docquery.settings import DEFAULTS, Settings
from docquery.shared import materialize

ANSWER = [
    "question_id", "question", "text", "hits", "top_score", "correction", "route", "sql",
    "row_count", "status", "request_id", "risk_reason", "guard_findings", "pii_masked",
]


def grounded_prompts(found: DataFrame) -> DataFrame:
    """Add `prompt`, what a generating model is given."""
    return found.withColumn("prompt", prompt(F.col("question"), F.col("hits")))


def document_answers(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """`(question_id, question, text, hits, top_score, correction)` from the documents.

    Each distinct question is answered once and joined back, so a question that
    makes up much of the log costs one retrieval. The answers are written out, and
    their size then decides between sending them along and shuffling. `finish` adds to the
    distinct answers what follows from their text alone, such as its masking.
    """
    finish = finish or (lambda rows: rows)
    # A null question is answered like an empty one and keeps its row.
    questions = questions.withColumn("_asked", F.coalesce("question", F.lit("")))
    asked = questions.select(F.col("_asked").alias("question")).distinct().select(
        F.sha2("question", 256).alias("question_id"), "question"
    )
    find = corrected_hits if settings.correction_enabled else linear_hits
    found = find(asked, index, hooks, settings)
    answers = materialize(
        finish(found.withColumn("text", hooks.generator(F.col("question"), F.col("hits")))), "answers"
    )
    found = answers.drop("question_id").withColumnRenamed("question", "_asked")
    return questions.select("question_id", "question", "_asked").join(found, "_asked").drop("_asked")


def answer_batch(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS
) -> DataFrame:
    """Answer rows (see ANSWER) for `(question_id, question, raw_sql)`.

    Blocked questions get the refusal and nothing else happens to them. The others
    take the statement branch or the document branch, and every answer is masked: each
    distinct one once, before it is joined back to the questions.
    `raw_sql` is the statement a model wrote for the question, if any.
    """
    screened = materialize(
        input_firewall(
            questions, "question", settings, hooks.injection_judge, hooks.toxicity_judge
        ),
        "screened",
    )
    refused = screened.filter(~F.col("allowed")).withColumn("route", F.lit("documents"))
    routed = screened.filter("allowed")
    if settings.sql_enabled:
        routed = route_questions(routed, hooks.classifier)
    else:
        routed = routed.withColumn("route", F.lit("documents"))

    nothing = {
        "hits": F.expr(NO_HITS),
        "top_score": F.lit(0.0),
        "correction": no_correction(),
    }
    no_sql = {
        "sql": F.lit(None).cast("string"),
        "row_count": F.lit(0),
        "status": F.lit("executed"),
        "request_id": F.lit(None).cast("string"),
        "risk_reason": F.lit(""),
    }

    def masked(rows: DataFrame) -> DataFrame:
        screened_rows = output_firewall(rows, "text", settings, hooks.toxicity_judge)
        return screened_rows.withColumnRenamed("findings", "guard_findings")

    from_documents = (
        document_answers(routed.filter(F.col("route") == "documents"), index, hooks, settings, masked)
        .withColumns(no_sql)
        .withColumn("route", F.lit("documents"))
    )
    log = routed.filter(F.col("route") == "structured").select(
        F.col("question_id").alias("request_id"), "question", "raw_sql"
    )
    from_tables = (
        structured_branch(log, settings, finish=masked)
        .withColumn("question_id", F.col("request_id"))
        .withColumn("request_id", F.col("request_id").cast("string"))
        .withColumns(nothing)
        .withColumn("route", F.lit("structured"))
    )
    refusals = refused.withColumns(
        {
            "text": F.lit(BLOCKED_TEXT),
            **nothing,
            **no_sql,
            "status": F.lit("blocked"),
            "guard_findings": F.col("reasons"),
            "pii_masked": F.lit(False),
        }
    )
    answered = from_documents.select(*ANSWER).unionByName(from_tables.select(*ANSWER))
    return answered.unionByName(refusals.select(*ANSWER))
