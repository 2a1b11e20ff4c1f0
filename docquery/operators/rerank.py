"""Second-stage scoring of (question, passage) pairs and the choice of the final hits."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquery.functions.hits import squash
from docquery.functions.text import let, words
from docquery.hooks import Hook
from docquery.shared import materialize

# Saturation and length weight of the word-statistics scorer (the usual BM25
# constants), and the spread of its logit around half coverage.
K1 = 1.2
B = 0.75
SPREAD = 8.0


def _batch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`(term, df, len)` of each batch of word lists; its size is the row of the term null."""
    for batch in batches:
        lists = batch.column(0).drop_null()
        if not len(lists):
            continue
        words_ = pc.list_flatten(lists).dictionary_encode()
        in_row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = words_.indices.to_numpy(zero_copy_only=False)
        kinds = len(words_.dictionary)
        once = np.unique(in_row * max(kinds, 1) + codes)
        df = np.bincount(once % max(kinds, 1), minlength=kinds)[:kinds]
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([words_.dictionary.cast(pa.string()), pa.nulls(1, pa.string())]),
                pa.array(np.append(df, len(lists)), pa.int64()),
                pa.array(np.append(np.zeros(kinds, np.int64), len(codes)), pa.int64()),
            ],
            names=["term", "df", "len"],
        )


def word_statistics(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(term, df)` over all chunks and one row `(n, total_len)`.

    Each text is cut into words once, and a batch of texts becomes one row per distinct
    word before Spark adds the rows up, so neither rows nor shuffle grow with the number
    of words. Both are sums, so the statistics of separate ingest runs may simply be stacked.
    """
    sums = materialize(
        chunks.select(words(F.col("child")).alias("w"))
        .mapInArrow(_batch_sums, "term string, df long, len long")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("len").alias("len")),
        "word-sums",
    )
    terms = sums.filter("term is not null").select("term", "df")
    size = sums.filter("term is null").agg(
        F.coalesce(F.sum("df"), F.lit(0)).alias("n"), F.coalesce(F.sum("len"), F.lit(0)).alias("total_len")
    )
    return terms, size


def question_terms(questions: DataFrame, terms: DataFrame, size: DataFrame) -> DataFrame:
    """`(question_id, weights MAP<term, idf>, mean_len)`; unseen words get df 0."""
    asked = questions.select(
        "question_id", F.explode(F.array_distinct(words(F.col("query")))).alias("term")
    )
    known = (
        terms.join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    # One row by construction, so safe to send everywhere.
    whole = F.broadcast(
        size.agg(
            F.sum("n").alias("n"), (F.sum("total_len") / F.sum("n")).alias("mean_len")
        )
    )
    idf = F.round(F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)), 9)
    return (
        asked.join(known, "term", "left")
        .fillna(0, ["df"])
        .join(whole, F.lit(True))
        .groupBy("question_id")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("term", idf.alias("idf")))).alias("weights"),
            F.first("mean_len").alias("mean_len"),
        )
    )


def word_score(weights: Column, child: Column, mean_len: Column) -> Column:
    """BM25 of one pair as a share of the question's total weight, as a logit around one half."""

    def scored(tokens: Column) -> Column:
        length = F.size(tokens) / mean_len
        seen = F.array_sort(F.array_intersect(F.map_keys(weights), tokens))

        def gain(term: Column) -> Column:
            tf = (F.size(tokens) - F.size(F.array_remove(tokens, term))).cast("double")
            return weights[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))

        total = F.aggregate(seen, F.lit(0.0), lambda acc, t: acc + gain(t))
        whole = F.aggregate(F.map_values(weights), F.lit(0.0), lambda acc, v: acc + v)
        return F.when(whole > 0, SPREAD * (total / whole - 0.5)).otherwise(F.lit(-SPREAD / 2))

    return F.coalesce(let(words(child), scored), F.lit(-SPREAD / 2))


def rerank_top_n(hits: DataFrame, top_n: int) -> DataFrame:
    """Keep the `top_n` best pairs per question by `rerank_score`, ties by `cosine_rank`.

    Candidates per question are few (the first-stage pool), so the window stays small.
    """
    best_first = Window.partitionBy("question_id").orderBy(
        F.col("rerank_score").desc(), F.col("cosine_rank")
    )
    return hits.withColumn("final_rank", F.row_number().over(best_first)).filter(
        F.col("final_rank") <= top_n
    )


def with_rerank_score(pairs: DataFrame, scorer: Hook | None) -> DataFrame:
    """Add `rerank_score` in [0, 1] to pairs `(query, child, weights, mean_len, ...)`."""
    logit = (
        scorer(F.col("query"), F.col("child"))
        if scorer
        else word_score(F.col("weights"), F.col("child"), F.col("mean_len"))
    )
    return pairs.withColumn("rerank_score", F.round(squash(logit), 6))
