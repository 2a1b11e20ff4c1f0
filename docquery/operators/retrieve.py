"""Two-stage retrieval of a batch of questions, ending in a short hit array per question."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.functions.hits import HIT, NO_HITS, UNKNOWN_SOURCE
from docquery.hooks import Hooks
from docquery.operators.rerank import question_terms, with_rerank_score
from docquery.operators.search import vector_top_k
from docquery.settings import DEFAULTS, Settings
from docquery.shared import materialize


@dataclass(frozen=True)
class Index:
    """A searchable corpus.

    chunks: `(chunk_id, source, chunk_no, parent_id, child, title, embedding)`, the
    vectors as `functions.vectors` packs them, or as lists;
    sections: `(parent_id, parent)`, one row per section rather than one copy per
    child; terms, size: word statistics for the default scorer.
    """

    chunks: DataFrame
    sections: DataFrame
    terms: DataFrame
    size: DataFrame


# Bytes that a row of ids and a score takes in a broadcast, with room to spare.
_ROW_BYTES = 512


def _sent(ids: DataFrame, settings: Settings) -> DataFrame:
    """Rows of ids, marked for every executor where they fit `broadcast_bytes`; a session's own limit may be far lower."""
    return F.broadcast(ids) if ids.count() * _ROW_BYTES <= settings.broadcast_bytes else ids


def candidates(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS
) -> DataFrame:
    """First stage: `(question_id, query, chunk_id, score, cosine_rank, child, source, ...)`.

    Only ids and scores go through the top-k; the wide text joins back afterwards.
    The ids are written out first: their number is then known, and a set that fits is
    sent to the chunk scan instead of shuffling the chunks.
    """
    asked = questions.select("question_id", "query")
    vectors = asked.select("question_id", hooks.embedder(F.col("query")).alias("embedding"))
    nearest = materialize(
        vector_top_k(index.chunks, vectors, settings.retrieve_k, settings), "nearest"
    )
    texts = index.chunks.select("chunk_id", "source", "parent_id", "child", "title")
    return _sent(nearest, settings).join(texts, "chunk_id").join(asked, "question_id")


def scored_candidates(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS
) -> DataFrame:
    pairs = candidates(questions, index, hooks, settings)
    if hooks.scorer is None:
        pairs = pairs.join(question_terms(questions, index.terms, index.size), "question_id", "left")
    return with_rerank_score(pairs, hooks.scorer).drop("weights", "mean_len")


def retrieve(
    questions: DataFrame, index: Index, hooks: Hooks, settings: Settings = DEFAULTS
) -> DataFrame:
    """The questions with their `hits`; a question without any gets an empty array."""
    if settings.rerank_enabled:
        pairs = scored_candidates(questions, index, hooks, settings)
        order = [(-F.col("rerank_score")).alias("by"), F.col("cosine_rank").alias("then")]
    else:
        pairs = candidates(questions, index, hooks, settings).withColumn(
            "rerank_score", F.lit(None).cast("double")
        )
        order = [F.col("cosine_rank").alias("by"), F.col("cosine_rank").alias("then")]
    # The pool per question is at most retrieve_k rows: rank and cut inside one array.
    ranked = pairs.select(
        "question_id",
        F.struct(
            *order, "chunk_id", "child", "score", "source", "title", "rerank_score",
            "parent_id",
        ).alias("c"),
    )
    chosen = (
        ranked.groupBy("question_id")
        .agg(F.array_sort(F.collect_list("c")).alias("pool"))
        .select("question_id", F.posexplode(F.slice("pool", 1, settings.top_k)).alias("rank", "c"))
        .select("question_id", "rank", "c.*")
    )
    # The few chosen parents are written out and looked up first, so that no other section is shuffled.
    chosen = materialize(chosen, "chosen")
    parents = index.sections.join(_sent(chosen.select("parent_id").distinct(), settings), "parent_id", "left_semi")
    with_parents = chosen.join(parents, "parent_id", "left")
    hit = F.struct(
        "rank",
        F.struct(
            "chunk_id",
            F.col("child").alias("text"),
            "score",
            F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source"),
            F.coalesce("parent", "child").alias("parent"),
            F.coalesce("title", F.lit("")).alias("title"),
            "rerank_score",
        ).cast(HIT).alias("hit"),
    )
    hits = with_parents.groupBy("question_id").agg(
        F.array_sort(F.collect_set(hit)).alias("ranked")
    ).select("question_id", F.col("ranked.hit").alias("hits"))
    return questions.join(hits, "question_id", "left").withColumn(
        "hits", F.coalesce("hits", F.expr(NO_HITS))
    )
