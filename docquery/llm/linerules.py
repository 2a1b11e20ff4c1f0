"""Document quality rules: counts of a text's own repetition, and lines that many documents share.

Normalised lines are hashed, the distinct documents of each line are counted per host, lines above
the host's limit are removed, and a document that loses too much of itself is rejected.

Documents of a host with the same text count once, so exact copies don't turn their own lines into
boilerplate. Any two different texts count as two, however much else they share.

Defined cases: null texts are empty, null hosts are the empty host; an empty text has zero counts
and fails the base rules; equal rows get equal verdicts; extra columns are untouched; a table
without rows gives none.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.shared import materialize

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
# A line is frequent in a host above a share of its distinct documents, which counts as no fewer than
# the least and no more than the most of these numbers.
LEAST_DOCUMENTS, MOST_DOCUMENTS = 20, 1000
SHARE_OF_HOST = 0.002
# A document is depleted when more than this share of its words is in frequent lines.
MOST_REMOVED = 0.7

SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = "host string, digest binary, " + ", ".join(f"{c} long" for c in COUNTS)
_SCHEMA += ", line_hashes array<long>, line_words array<long>"


def _repeated_words(words: list[bytes]) -> int:
    """Words inside any run of `WINDOW` words that the text has more than once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n + i]
    ranked = np.sort(runs)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(runs, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def line_hash(words: list[bytes]) -> int:
    """64-bit hash of a line as its lower-cased words with single spaces."""
    return xxhash.xxh3_64_intdigest(b" ".join(words).lower()) - (1 << 63)


def measure(text: str) -> tuple:
    """The base counts of a text, and its distinct line hashes with their words."""
    words: list[bytes] = []
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    duplicates = 0
    for line in text.encode().split(b"\n"):
        own = line.split()
        if not own:
            continue
        duplicates += line in seen
        seen.add(line)
        words += own
        hashed = line_hash(own)
        lines[hashed] = lines.get(hashed, 0) + len(own)
    letters = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    counts = (len(words), letters, symbols, duplicates, _repeated_words(words))
    return *counts, list(lines), list(lines.values())


def _measured(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
            columns = list(zip(*map(measure, texts)))
            digests = [hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in texts]
            arrays = [*part.columns[:-1], pa.array(digests, pa.binary())]
            arrays += [pa.array(c, schema.field(len(arrays) + i).type) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def measured_documents(docs: DataFrame, key: str, host: str = "source", text: str = "text") -> DataFrame:
    """The stored `(key, host, digest, counts…, lines…)` of each row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    columns = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text)
    )
    kind = columns.schema["key"].dataType.simpleString()
    ddl = f"key {kind}, {_SCHEMA}"
    empty = docs.sparkSession.createDataFrame([], ddl)
    schema = to_arrow_schema(empty.schema)
    return materialize(columns.mapInArrow(lambda batches: _measured(batches, schema), ddl), "line-counts")


def frequent_lines(measured: DataFrame) -> DataFrame:
    """Per `(host, digest)` with any frequent line: `removed_words` and the `frequent` hashes."""
    texts = measured.groupBy("host", "digest").agg(
        *[F.first(c).alias(c) for c in ("line_hashes", "line_words")]
    )
    zipped = F.explode(F.arrays_zip("line_hashes", "line_words")).alias("line")
    lines = texts.select("host", "digest", zipped).select(
        "host", "digest", F.col("line.line_hashes").alias("hash"), F.col("line.line_words").alias("words")
    )
    per_host = texts.groupBy("host").agg(F.count("*").alias("documents"))
    # `texts` has a row per distinct document, and a document has a line's hash once.
    per_line = lines.groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") > LEAST_DOCUMENTS)
    limit = F.least(SHARE_OF_HOST * F.col("documents"), F.lit(float(MOST_DOCUMENTS)))
    frequent = per_line.join(per_host, "host").filter(F.col("n") > limit)
    return lines.join(frequent.select("host", "hash"), ["host", "hash"]).groupBy("host", "digest").agg(
        F.sum("words").alias("removed_words"), F.collect_list("hash").alias("frequent")
    )


def _verdict(rows: DataFrame) -> DataFrame:
    """Add `base_failed` and `kept` to rows with the counts and `removed_words`."""
    depleted = F.coalesce("removed_words", F.lit(0)) > MOST_REMOVED * F.col("n_words")
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~depleted)


def rule_verdicts(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """`(key, counts…, base_failed, removed_words, kept)` of each row."""
    measured = measured_documents(docs, key, host, text)
    lost = frequent_lines(measured).drop("frequent")
    rows = measured.select(F.col("key").alias(key), "host", "digest", *COUNTS)
    judged = _verdict(rows.join(lost, ["host", "digest"], "left"))
    return judged.select(
        key, *COUNTS, "base_failed", F.coalesce("removed_words", F.lit(0)).alias("removed_words"), "kept"
    )


def _without_lines(batches: Iterator[pa.RecordBatch], at: int, hashes: int) -> Iterator[pa.RecordBatch]:
    """Remove from the texts of column `at` the lines whose hashes are listed in the column `hashes`."""
    for batch in batches:
        texts = batch.column(at).to_pylist()
        for i, gone in enumerate(batch.column(hashes).to_pylist()):
            if gone and texts[i]:
                gone = set(gone)
                kept = [x for x in texts[i].split("\n") if not (w := x.encode().split()) or line_hash(w) not in gone]
                texts[i] = "\n".join(kept)
        columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns) if i != hashes]
        names = [n for i, n in enumerate(batch.schema.names) if i != hashes]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def clean_documents(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass, with their frequent lines removed; the columns stay as they are.

    Verdicts depend on host and text alone, so they join on these and a group of copies shares one.
    """
    measured = measured_documents(docs.withColumn("__none", F.lit(0)), "__none", host, text)
    lost = frequent_lines(measured)
    texts = measured.groupBy("host", "digest").agg(*[F.first(c).alias(c) for c in COUNTS])
    judged = _verdict(texts.join(lost, ["host", "digest"], "left")).filter("kept").select(
        F.col("host").alias("__host"), F.col("digest").alias("__digest"), F.col("frequent").alias("__frequent")
    )
    digest = F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    joined = docs.withColumns(
        {"__host": F.coalesce(F.col(host).cast("string"), F.lit("")), "__digest": digest}
    ).join(judged, ["__host", "__digest"]).select(*[docs[f"`{c}`"] for c in docs.columns], "__frequent")
    at, hashes = docs.columns.index(text), len(docs.columns)
    return joined.mapInArrow(lambda batches: _without_lines(batches, at, hashes), docs.schema)
