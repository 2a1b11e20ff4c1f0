"""The training-data operators over their whole tables, as registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import (
    ann, bpe, chat, collocations, licences, linerules, neardup, packing, prefixtrie, quality, shards, tokenfiles,
    toxicity,
)
from docquery.llm.labels import remainder
from docquery.shared import fresh_path, materialize
from docquery.sources.tables import table


def vocabulary(name: str) -> str:
    """Where the public vocabulary files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_dimension_scan(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, folder, "embeddings"), lambda i: i % 100 == 0)


def op2_shuffled_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.shuffled_shards(table(spark, folder, "documents").select("doc_id", "text"), 40)
    return placed.select(
        "record.doc_id", "size",
        F.crc32(F.coalesce("record.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents have no paths, so these are made of source, language and id.

    Every 40th document stands for the licence file of its directory, every 97th for its source's.
    """
    path = F.expr("""
        case when doc_id % 97 = 0 then concat(source, '/LICENSE-', doc_id, '.txt')
             when doc_id % 40 = 0 then concat(source, '/', lang, '/', doc_id % 50, '/LICENSE-', doc_id, '.txt')
             else concat(source, '/', lang, '/', doc_id % 50, '/', doc_id, '.txt') end
    """)
    files = table(spark, folder, "documents").select("doc_id", path.alias("path"), "text")
    return licences.scan_licences(files).drop("text")


def op4_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return linerules.rule_verdicts(table(spark, folder, "documents"))


def op5_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    columns = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], columns)
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_conversations(turns).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("pieces")).alias("learned"),
    )
    said_by = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said_by, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(remainder(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT, F.lit(False))
    return toxicity.score_toxicity(docs, model).withColumn("held_out", held_out)


def op8_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op9_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    held_out = F.coalesce(remainder(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT, F.lit(False))
    return quality.score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.duplicate_classes(table(spark, folder, "documents"), neardup.Forest(words=2)).drop(
        "text_id"
    )


def op11_orc_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    tokenfiles.write_token_files(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), path)
    return tokenfiles.id_checksums(tokenfiles.read_token_files(spark, path))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def rebuilt(paths: DataFrame) -> DataFrame:
    """Conversations that begin like the first of their five: `(conv_id, turns)` of turn paths."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    rows = paths.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 5, "taken": taken})
    bases = paths.filter(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.col("turns").alias("given"))
    none = F.slice("turns", 1, 0)
    turns = F.concat(
        F.slice(F.coalesce("given", none), F.lit(1), F.col("taken")),
        F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0))),
    )
    return rows.join(bases, "base", "left").select("conv_id", turns.alias("turns"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    paths = materialize(prefixtrie.turn_paths(table(spark, folder, "conversations")), "turn-paths")
    return prefixtrie.prefix_trie(rebuilt(paths))


QUERIES = {
    "op1_dimension_scan": op1_dimension_scan,
    "op2_shuffled_shards": op2_shuffled_shards,
    "op3_licence_scan": op3_licence_scan,
    "op4_line_rules": op4_line_rules,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_chat_format": op6_chat_format,
    "op7_compression_toxicity": op7_compression_toxicity,
    "op8_best_two_fit": op8_best_two_fit,
    "op9_rule_ensemble": op9_rule_ensemble,
    "op10_lsh_forest": op10_lsh_forest,
    "op11_orc_token_files": op11_orc_token_files,
    "op12_phrases": op12_phrases,
    "op13_prefix_trie": op13_prefix_trie,
}
