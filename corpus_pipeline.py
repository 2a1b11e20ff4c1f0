"""From documents to packed training sequences: quality classifier, line rules, near-dedup, packing.

Each stage works on all that the stage before it kept, and its decisions take effect: rejected
documents go, frequent lines are cut out of the texts that stay, and one document of each group of
near-copies stays, the one with the smallest id. Documents without an id cannot be the smallest of a
group, but stay where no document of their group has one.

Defined cases: a null or empty text has no words, so it fails the line rules; a text of any length is
worked on whole and packed in pieces; equal rows get equal verdicts, and one of them stays after
near-dedup; a null source is the empty host; extra columns, whatever their names, are carried
through all stages but the last; a table without rows passes every stage empty.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import linerules, neardup, packing, quality
from docquery.llm.queries import vocabulary
from docquery.shared import materialize
from docquery.sources.tables import table

# SQL cannot fit the classifier; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, score="__score")
    return scored.filter(F.col("__score") >= 0.5).select(*docs.columns)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = linerules.clean_documents(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = neardup.duplicate_classes(docs, neardup.Forest())
    kept = classes.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_id").alias("__text"))
    keyed = docs.withColumn("__digest", neardup.text_digest(F.col("text")))
    stay = keyed.join(
        kept, keyed["doc_id"].eqNullSafe(kept["__id"]) & (keyed["__digest"] == kept["__text"]), "left_semi"
    )
    return stay.dropDuplicates(["doc_id", "__digest"]).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, vocabulary("word_bpe_49k.json"))
    return packing.pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality classifier", good_documents),
    ("quality rules", clean_lines),
    ("minhash near-dedup", one_of_each_group),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
