"""Chunk index: building, writing, reading, and the checks that guard it."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.functions.chunking import markdown_sections, parent_child_chunks, section_id
from docquery.functions.vectors import packed
from docquery.hooks import Hook
from docquery.operators.rerank import word_statistics
from docquery.operators.retrieve import Index
from docquery.settings import DEFAULTS, Settings
from docquery.shared import fresh_path


class EmbedderMismatchError(ValueError):
    """The index was built with another embedder than the one asking."""


class DimensionError(ValueError):
    """A vector does not have the configured number of dimensions."""


def chunk_id(source: Column, chunk_no: Column, child: Column, run: str = "") -> Column:
    """Repeatable within an ingest run, different between runs."""
    return F.sha2(F.concat_ws("\x1f", F.lit(run), source, chunk_no.cast("string"), child), 256)


def chunk_documents(
    documents: DataFrame, settings: Settings = DEFAULTS, with_parent: bool = False
) -> DataFrame:
    """`(source, chunk_no, parent_id, child, title[, parent])` of documents `(source, text)`.

    Row-local: no shuffle, and usable on a stream of documents as it is.
    """
    units = parent_child_chunks(
        F.col("text"), settings.child_size, settings.chunk_size, settings.chunk_overlap, with_parent
    )
    return documents.select(
        "source", F.posexplode(units).alias("chunk_no", "unit")
    ).select("source", "chunk_no", "unit.*")


def section_table(documents: DataFrame) -> DataFrame:
    """`(parent_id, parent)` of the documents that have more than one section, each text once."""
    found = F.when(F.col("text").contains("#"), markdown_sections(F.col("text")))
    return (
        documents.select(found.alias("sections"))
        .filter(F.size("sections") > 1)
        .select(F.explode("sections.body").alias("parent"))
        .select(section_id(F.col("parent")).alias("parent_id"), "parent")
        .dropDuplicates(["parent_id"])
    )


def embedded_chunks(
    documents: DataFrame, embedder: Hook, settings: Settings = DEFAULTS, run: str = ""
) -> DataFrame:
    """The chunks with their ids and stored vectors; the job fails at the first vector of another length."""
    return chunk_documents(documents, settings).select(
        chunk_id(F.col("source"), F.col("chunk_no"), F.col("child"), run).alias("chunk_id"),
        "*",
        packed(embedder(F.col("child")), settings.embed_dim).alias("embedding"),
    )


def wrong_dimensions(vectors: DataFrame, dim: int) -> DataFrame:
    """The rows whose vector length differs from `dim`; empty when all is well."""
    return vectors.filter(F.coalesce(F.size("embedding"), F.lit(-1)) != dim)


def assert_dimensions(vectors: DataFrame, dim: int) -> None:
    bad = wrong_dimensions(vectors, dim).select(F.size("embedding").alias("got")).head()
    if bad is not None:
        raise DimensionError(
            f"Embedder returned {bad['got']}-dim vectors but {dim} are configured; "
            "set embed_dim and rebuild the index"
        )


CHUNKS = (
    "chunk_id string, source string, chunk_no int, parent_id string, child string, "
    "title string, embedding binary"
)
SECTIONS = "parent_id string, parent string"
FINGERPRINT = "provider string, model string, dim int"


def write_fingerprint(spark: SparkSession, path: str, fingerprint: dict) -> None:
    row = [(fingerprint["provider"], fingerprint["model"], int(fingerprint["dim"]))]
    spark.createDataFrame(row, FINGERPRINT).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def read_fingerprint(spark: SparkSession, path: str) -> dict | None:
    if not _exists(spark, f"{path}/meta"):
        return None
    row = spark.read.schema(FINGERPRINT).parquet(f"{path}/meta").head()
    return row.asDict() if row else None


def assert_embedder(spark: SparkSession, path: str, current: dict) -> None:
    """Refuse an index stamped by another embedder; an unstamped one passes."""
    stored = read_fingerprint(spark, path)
    keys = ("provider", "model", "dim")
    if stored is None or all(stored[k] == current[k] for k in keys):
        return

    def name(f: dict) -> str:
        return f"{f['provider']}/{f['model']} ({f['dim']}-dim)"

    raise EmbedderMismatchError(
        f"This index was built with embedder {name(stored)}, but {name(current)} is asking. "
        "Rebuild the index or switch the embedder back."
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _parts(spark: SparkSession, path: str) -> list[str]:
    """The folders `run=…` of a stored table: at most one per ingest run."""
    if not _exists(spark, path):
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    names = [f.getPath().getName() for f in found]
    return [n.removeprefix("run=") for n in names if n.startswith("run=")]


_RUN_TABLES = ("chunks", "terms", "size")


def write_index(
    documents: DataFrame,
    path: str,
    embedder: Hook,
    settings: Settings = DEFAULTS,
    recreate: bool = False,
    run: str | None = None,
) -> None:
    """Chunk, embed and store documents `(source, text)` as one ingest run.

    `recreate` replaces everything stored; otherwise the run is added beside the
    others, after the stored fingerprint has been checked, so documents ingested
    in two runs appear twice. Repeating a run of the same name replaces it. What is
    replaced goes after the new run is stored: a run that fails leaves the index as it was.

    Sections are kept by their hash and belong to no run, so a section that several runs
    have is stored once. Only `recreate` removes sections.
    """
    spark = documents.sparkSession
    run = run or uuid.uuid4().hex
    if not recreate:
        assert_embedder(spark, path, settings.fingerprint())
    part = f"{run}~{uuid.uuid4().hex[:12]}"
    before = {name: _parts(spark, f"{path}/{name}") for name in (*_RUN_TABLES, "sections")}

    def store(table: DataFrame, name: str) -> None:
        table.write.option("compression", "zstd").parquet(f"{path}/{name}/run={part}")

    try:
        store(embedded_chunks(documents, embedder, settings, run), "chunks")
        stored = spark.read.schema(CHUNKS).parquet(f"{path}/chunks/run={part}")
        terms, size = word_statistics(stored)
        store(terms, "terms")
        store(size, "size")
        sections = section_table(documents)
        if before["sections"] and not recreate:
            known = spark.read.schema(SECTIONS).parquet(f"{path}/sections").select("parent_id")
            sections = sections.join(known, "parent_id", "left_anti")
        store(sections, "sections")
    except BaseException:
        for name in before:
            _delete(spark, f"{path}/{name}/run={part}")
        raise
    for name, parts in before.items():
        for old in parts:
            if recreate or (name in _RUN_TABLES and old.rpartition("~")[0] == run):
                _delete(spark, f"{path}/{name}/run={old}")
    if stored.head() is not None:
        write_fingerprint(spark, path, settings.fingerprint())
    elif recreate:
        # An index without a stamp takes any embedder.
        _delete(spark, f"{path}/meta")


def read_index(spark: SparkSession, path: str, settings: Settings = DEFAULTS) -> Index:
    assert_embedder(spark, path, settings.fingerprint())

    def table(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    return Index(
        chunks=table("chunks", CHUNKS),
        sections=table("sections", SECTIONS),
        terms=table("terms", "term string, df bigint"),
        size=table("size", "n bigint, total_len bigint"),
    )


def index_in_place(documents: DataFrame, embedder: Hook, settings: Settings = DEFAULTS) -> Index:
    """Build an index in the shared folder and open it."""
    path = fresh_path(documents.sparkSession, "index")
    write_index(documents, path, embedder, settings, recreate=True, run="0")
    return read_index(documents.sparkSession, path, settings)


def ingest_counts(chunks: DataFrame) -> DataFrame:
    """Chunks per source: what an ingest run reports."""
    return chunks.groupBy("source").agg(F.count("*").alias("n_chunks"))
