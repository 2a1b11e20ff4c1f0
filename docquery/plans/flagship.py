"""One question batch end to end: index, retrieve, grade, retry, answer, mask."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.operators.firewall import output_firewall
from docquery.plans.answering import document_answers
from docquery.plans.inputs import benchmark_questions
from docquery.plans.queries import HOOKS, SETTINGS, corpus_index


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    questions = benchmark_questions(spark, folder)
    answers = document_answers(questions, corpus_index(spark, folder), HOOKS, SETTINGS)
    return output_firewall(answers, "text", SETTINGS).select(
        "question_id", "text", "top_score", "correction.attempts",
        "correction.graded_relevant", "pii_masked", F.size("hits").alias("n_hits"),
    )
