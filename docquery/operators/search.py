"""Exact cosine top-k of many queries against a large vector table."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquery.functions.vectors import unpack
from docquery.settings import DEFAULTS, Settings
from docquery.shared import fresh_path, materialize

_MERGE_WAYS = 32
_SLACK = 1e-6


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Unit rows from a column of lists or of stored vectors, without a Python object per vector."""
    if pa.types.is_binary(vectors.type) or pa.types.is_large_binary(vectors.type):
        matrix = unpack(vectors, dim)
    else:
        sizes = pc.list_value_length(vectors)
        if not pc.all(pc.equal(pc.fill_null(sizes, -1), dim)).as_py():
            raise ValueError(f"a vector does not have {dim} dimensions")
        flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False)
        matrix = flat.astype(np.float64).reshape(len(vectors), dim)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms > 0, norms, 1.0)


class _Best:
    """Running best `k` candidates per query: at most `k` rows each, ties kept by id."""

    def __init__(self, query_ids: pa.Array, queries: np.ndarray, k: int):
        self.ids = query_ids
        self.queries = queries
        self.k = k
        self.floor = np.full(len(query_ids), -np.inf)
        self.floor_id: np.ndarray | None = None
        self.kept: pd.DataFrame | None = None

    def add(self, chunk_ids: pa.Array, vectors: np.ndarray) -> None:
        exact = self.queries @ vectors.T
        # Only what may reach a query's last place is rounded: rounding raises a score by less than the slack.
        q, c = np.nonzero(exact >= (self.floor - _SLACK)[:, None])
        scores = np.round(exact[q, c], 6)
        at_least = self.floor[q]
        if len(q) > self.k * len(self.floor) and exact.shape[1] >= self.k:
            best = np.round(np.partition(exact, -self.k, axis=1)[:, -self.k], 6)
            at_least = np.maximum(at_least, best[q])
        near = scores >= at_least
        q, c, scores = q[near], c[near], scores[near]
        if not len(q):
            return
        ids = chunk_ids.take(pa.array(c)).to_numpy(zero_copy_only=False)
        found = pd.DataFrame({"q": q, "chunk_id": ids, "score": scores})
        if self.floor_id is not None:
            # Many copies may tie with a query's last place: only a smaller id displaces it.
            found = found[(found["score"] > self.floor[q]) | (ids < self.floor_id[q])]
        if self.kept is not None:
            found = pd.concat([self.kept, found], ignore_index=True)
        found = found.sort_values(["q", "score", "chunk_id"], ascending=[True, False, True])
        place = found.groupby("q").cumcount()
        self.kept = found[place < self.k]
        last = found[place == self.k - 1]
        self.floor[last["q"].to_numpy()] = last["score"].to_numpy()
        if len(last) == len(self.floor):
            self.floor_id = last["chunk_id"].to_numpy()

    def rows(self, chunk_type: pa.DataType) -> pa.RecordBatch:
        kept = self.kept
        if kept is None:
            kept = pd.DataFrame({"q": np.empty(0, dtype=int), "chunk_id": [], "score": []})
        return pa.RecordBatch.from_arrays(
            [
                self.ids.take(pa.array(kept["q"].to_numpy(), pa.int64())),
                pa.array(kept["chunk_id"].tolist(), chunk_type),
                pa.array(kept["score"].to_numpy(dtype=float)),
            ],
            names=["question_id", "chunk_id", "score"],
        )


def vector_top_k(
    corpus: DataFrame, queries: DataFrame, k: int | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """`(question_id, chunk_id, score, cosine_rank)`: the `k` nearest chunks of each query.

    corpus: `(chunk_id, embedding)`, its vectors as lists or as an index stores them
    (`functions.vectors`); queries: `(question_id, embedding)`. Scores are
    cosine similarities rounded to six places; ties go to the smaller chunk id.

    No pair table is built and the corpus never moves. Each task multiplies blocks of its
    own corpus rows with a query matrix and keeps `k` rows per query, so what is shuffled
    grows with the number of tasks, not with the corpus. The queries are stored once, so that
    each is embedded once, and sent to the executors in blocks of at most `broadcast_bytes`;
    every block passes over the corpus where it lies. A block holds so many queries that
    multiplying takes far longer than reading the corpus once more.
    """
    k = k or settings.top_k
    corpus = corpus.select("chunk_id", "embedding")
    queries = materialize(queries.select("question_id", "embedding"), "queries")
    out = (
        f"question_id {queries.schema['question_id'].dataType.simpleString()}, "
        f"chunk_id {corpus.schema['chunk_id'].dataType.simpleString()}, score double"
    )
    dim = settings.embed_dim
    fitting = max(1, settings.broadcast_bytes // (8 * dim))
    blocks = -(-queries.count() // fitting)
    if blocks <= 1:
        return _merge(_stream_past(corpus, queries.toArrow().combine_chunks(), k, dim, out), k)
    return _merge(_in_blocks(corpus, queries, blocks, fitting, k, dim, out), k)


def _in_blocks(
    corpus: DataFrame, queries: DataFrame, blocks: int, fitting: int, k: int, dim: int, out: str
) -> DataFrame:
    """Candidates of all queries, block by block; one block at a time is on the driver."""
    spark = corpus.sparkSession
    dealt = fresh_path(spark, "query-blocks")
    queries.withColumn("block", F.monotonically_increasing_id() % blocks).write.partitionBy("block").parquet(dealt)
    found = fresh_path(spark, "candidates")
    for block in range(blocks):
        some = spark.read.schema(queries.schema).parquet(f"{dealt}/block={block}").toArrow().combine_chunks()
        # Rows are dealt by partition, so a block may have a few more than fit.
        for at in range(0, some.num_rows, fitting):
            passed = _stream_past(corpus, some.slice(at, fitting), k, dim, out)
            passed.write.parquet(f"{found}/{block}-{at}")
    return spark.read.schema(out).parquet(f"{found}/*")


def _stream_past(corpus: DataFrame, queries: pa.Table, k: int, dim: int, out: str) -> DataFrame:
    spark = corpus.sparkSession
    if queries.num_rows == 0:
        return spark.createDataFrame([], out)
    ids = pa.concat_arrays(queries.column("question_id").chunks)
    vectors = pa.concat_arrays(queries.column("embedding").chunks)
    sent = spark.sparkContext.broadcast((ids, _matrix(vectors, dim)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        best = _Best(ids, matrix, k)
        step = max(256, (16 << 20) // (8 * max(len(ids), dim)))
        chunk_type = None
        for batch in batches:
            chunk_type = batch.schema.field("chunk_id").type
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                best.add(part.column("chunk_id"), _matrix(part.column("embedding"), dim))
        if chunk_type is not None:
            yield best.rows(chunk_type)

    return corpus.mapInArrow(scan, out)


def _merge(partial: DataFrame, k: int) -> DataFrame:
    """Two ranking steps, so that no task receives every task's candidates of a query."""
    order = [F.col("score").desc(), F.col("chunk_id")]
    way = F.pmod(F.xxhash64("chunk_id"), F.lit(_MERGE_WAYS))
    first = Window.partitionBy("question_id", "way").orderBy(*order)
    last = Window.partitionBy("question_id").orderBy(*order)
    return (
        partial.withColumn("way", way)
        .withColumn("place", F.row_number().over(first))
        .filter(F.col("place") <= k)
        .drop("way", "place")
        .withColumn("cosine_rank", F.row_number().over(last))
        .filter(F.col("cosine_rank") <= k)
    )
