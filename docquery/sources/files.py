"""Folders of text documents, question sets and score reports."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.hooks import Hook

# The suffixes a document folder may hold. Only the text formats are
# read here; the two binary ones need a parser hook (see read_documents).
SUPPORTED = [".pdf", ".md", ".txt", ".xlsx"]
TEXT_SUFFIXES = [".md", ".txt"]


def _any_case(suffix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def _suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(_file_name(path), r".(\.[^./]+)\z", 1))


def _files(spark: SparkSession, root: str, suffixes: list[str] | None = None) -> DataFrame:
    """Files below `root`; a suffix filter is a path glob, so no other file is opened."""
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
    )
    if suffixes:
        reader = reader.option("pathGlobFilter", "*{" + ",".join(_any_case(x) for x in suffixes) + "}")
    return reader.load(root)


def decoded(content: Column) -> Column:
    """UTF-8 text without invalid bytes and with plain newlines."""
    valid = F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))
    return F.regexp_replace(valid, "\r\n?", "\n")


def read_text_documents(spark: SparkSession, root: str) -> DataFrame:
    """`(source, text)` of the text files below `root`; `source` is the file name.

    Unreadable files are skipped and empty ones give no row.
    """
    return _documents(_files(spark, root, TEXT_SUFFIXES), decoded(F.col("content")))


def read_documents(spark: SparkSession, root: str, parsers: dict[str, Hook]) -> DataFrame:
    """Text files, and those of other suffixes through their parser hook `content -> text`.

    Each parser gets its own scan, so it only ever sees files of its suffix.
    """
    found = read_text_documents(spark, root)
    for suffix, parser in parsers.items():
        if suffix not in SUPPORTED:
            raise ValueError(f"Unsupported file type: {suffix}")
        found = found.unionByName(
            _documents(_files(spark, root, [suffix]), parser(F.col("content")))
        )
    return found


def _documents(found: DataFrame, text: Column) -> DataFrame:
    return found.select(_file_name(F.col("path")).alias("source"), text.alias("text")).filter(
        F.col("text") != ""
    )


def rejected_files(spark: SparkSession, root: str) -> DataFrame:
    """`(path, reason)` of files with an unsupported suffix; contents are not read."""
    suffix = _suffix(F.col("path"))
    return (
        _files(spark, root)
        .filter(~suffix.isin(SUPPORTED))
        .select("path", F.concat(F.lit("Unsupported file type: "), suffix).alias("reason"))
    )


def skipped_files(spark: SparkSession, root: str, parsers: dict[str, Hook] | None = None) -> DataFrame:
    """`(path, reason)` of every file below `root` that `read_documents` gives no document for.

    Those are files of an unsupported suffix, of a suffix without a parser, without text, and files
    whose content cannot be read: they are listed, but their rows don't come back. Spark's reader
    does not list files of no bytes at all.
    """
    parsers = parsers or {}
    suffix = _suffix(F.col("path"))
    read = [*TEXT_SUFFIXES, *parsers]
    unread = [x for x in SUPPORTED if x not in read]
    listed = _files(spark, root).select("path")
    no_parser = listed.filter(suffix.isin(unread)).select(
        "path", F.concat(F.lit("No parser for file type: "), suffix).alias("reason")
    )
    texts = _files(spark, root, TEXT_SUFFIXES).select("path", decoded(F.col("content")).alias("text"))
    for kind, parser in parsers.items():
        texts = texts.unionByName(_files(spark, root, [kind]).select("path", parser(F.col("content")).alias("text")))
    has_text = texts.select("path", (F.coalesce("text", F.lit("")) != "").alias("full"))
    opened = listed.filter(suffix.isin(read)).join(has_text, "path", "left").filter(~F.coalesce("full", F.lit(False)))
    reason = F.when(F.col("full").isNull(), "Unreadable file").otherwise("No text in file")
    return rejected_files(spark, root).unionByName(no_parser).unionByName(opened.select("path", reason.alias("reason")))


QUESTION = "question string, expected_route string"
REPORT = "scores map<string, double>, n bigint"


def read_question_set(spark: SparkSession, path: str) -> DataFrame:
    """`(question, expected_route)` from files that each hold one JSON array."""
    return spark.read.schema(QUESTION).option("multiLine", True).json(path)


def write_report(scores: DataFrame, items: DataFrame, path: str) -> None:
    """Store `(metric, score, n)` as one JSON object and the judged items beside it, one per line."""
    one = scores.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "score"))).alias("scores"),
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
    )
    one.write.mode("overwrite").json(f"{path}/scores")
    items.write.mode("overwrite").json(f"{path}/items")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """`(metric, score)` rows of a report; none if it is missing or malformed."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], "metric string, score double")
    stored = (
        spark.read.schema(REPORT).option("mode", "PERMISSIVE").option("multiLine", True).json(path)
    )
    return stored.select(F.explode("scores").alias("metric", "score"))
