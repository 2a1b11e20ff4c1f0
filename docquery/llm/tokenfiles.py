"""Token ids of documents as ORC files in key order, with what is needed to find a part of them.

A file holds `(key, part, before, n_tokens, ids)` in key order: `ids` as run-length encoded integers,
`before` the ids in front of a document in its file, `part` the file's place among the files.
Row indexes cover `STRIDE` documents each and Bloom filters cover the keys, so a look-up by key skips
most row groups; a file is read by its stripes, several tasks at a time. A manifest with a row per
file says how many ids lie before it, which makes positions in the whole collection of the
positions in a file, and finds the files of a span of ids without opening the others.

Defined cases: a null or empty text has the end id only; a null key comes first; documents with
one key are ordered by a hash of their text, equal rows are interchangeable; a text of any length is
one row of a file (a row is bounded by 2 GB); a table without rows gives an empty manifest and no
documents; columns other than key and text are not used, so their names do not matter.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.memory import give_back
from docquery.llm.wordids import word_ids
from docquery.llm.words import slices

END_ID = 1
# Documents of a row group, bytes of a stripe, and what share of absent keys a Bloom filter lets through.
STRIDE, STRIPE_BYTES, FALSE_POSITIVES = 1000, 16 << 20, 0.01
# Bounds the manifest, whose rows of `(part, base)` are broadcast: 16 MB.
MOST_FILES = 1_000_000


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    encoder, part, before = word_ids(path), TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows in slices(batch, 1):
            ids, bounds = encoder.encode(rows.column(1), closing=end_id)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), pa.array(np.full(len(rows), part, np.int32)),
                    pa.array(before + bounds[:-1]), pa.array(np.diff(bounds)), lists,
                ],
                names=names,
            )
            before += int(bounds[-1])
        give_back()


def write_token_files(
    docs: DataFrame, vocabulary: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> None:
    """Write `path`/files, as many as `docs` has input splits, and `path`/manifest."""
    columns = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    files = min(max(1, columns.rdd.getNumPartitions()), MOST_FILES)
    # A key, or a document, that many rows repeat is divided as well.
    told = columns.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("key"), "tie", "row"]
    ordered = told.repartitionByRange(files, *order).sortWithinPartitions(*order).select("key", "text")
    ddl = f"key {columns.schema['key'].dataType.simpleString()}, part int, before long, n_tokens long, ids array<int>"
    names = ["key", "part", "before", "n_tokens", "ids"]
    encoded = ordered.mapInArrow(lambda batches: _encoded(batches, vocabulary, end_id, names), ddl)
    encoded.write.options(
        **{
            "compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": STRIDE,
            "orc.stripe.size": STRIPE_BYTES, "orc.bloom.filter.columns": "key", "orc.bloom.filter.fpp": FALSE_POSITIVES,
        }
    ).orc(f"{path}/files")
    written = docs.sparkSession.read.schema(encoded.schema).orc(f"{path}/files")
    per_file = written.groupBy("part").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"),
        F.min("key").alias("first_key"), F.max("key").alias("last_key"),
    )
    # A row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_file.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).write.orc(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """`(key, start, n_tokens, ids)` of every document; `start` counts the ids of all documents before it."""
    manifest = spark.read.orc(f"{path}/manifest").select("part", "base")
    rows = spark.read.orc(f"{path}/files").join(F.broadcast(manifest), "part")
    return rows.select(F.col("key").alias(key), (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def find_documents(spark: SparkSession, path: str, keys: list, key: str = "doc_id") -> DataFrame:
    """The documents with one of `keys`; row groups that cannot hold one are skipped."""
    return read_token_files(spark, path, key).filter(F.col(key).isin(keys))


def read_span(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """`(start, ids)`: the ids at the places `first` to `last` (not included) of the collection, by document.

    The manifest names the files that hold some of them, and in these the row indexes find the rows.
    """
    manifest = spark.read.orc(f"{path}/manifest").select("part", "base", "tokens")
    touched = manifest.filter((F.col("base") < last) & (F.col("base") + F.col("tokens") > first))
    found = touched.agg(F.min("part").alias("low"), F.max("part").alias("high")).head()
    rows = read_token_files(spark, path, "__key")
    if found["low"] is None:
        return rows.limit(0).select("start", "ids")
    within = spark.read.orc(f"{path}/files").filter(F.col("part").between(found["low"], found["high"]))
    rows = within.join(F.broadcast(touched.select("part", "base")), "part").withColumn(
        "start", F.col("base") + F.col("before")
    ).filter((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    skipped = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    wanted = F.least(F.lit(last) - F.col("start"), F.col("n_tokens")) - skipped
    return rows.select(
        (F.col("start") + skipped).alias("start"),
        F.slice("ids", (skipped + 1).cast("int"), wanted.cast("int")).alias("ids"),
    )


def _checked(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        ids, bounds = lists.values.to_numpy().astype("<u4", copy=False).tobytes(), lists.offsets.to_numpy()
        view = memoryview(ids)
        sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=names)


def id_checksums(read: DataFrame, key: str = "doc_id") -> DataFrame:
    """`(key, start, n_tokens, ids_crc32)` of what `read_token_files` gives; ids count as little-endian 32-bit integers."""
    kind = read.schema[key].dataType.simpleString()
    names = ["key", "start", "n_tokens", "ids_crc32"]
    checked = read.select(F.col(key).alias("key"), "start", "n_tokens", "ids").mapInArrow(
        lambda batches: _checked(batches, names), f"key {kind}, start long, n_tokens long, ids_crc32 long"
    )
    return checked.withColumnRenamed("key", key)
