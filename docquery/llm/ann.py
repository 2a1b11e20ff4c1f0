"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are rotated at random and kept in blocks of one list each, dimension by dimension. A query
scans the blocks of its nearest lists: after every column block of dimensions a hypothesis test on
the partial distance abandons the candidates that are too far with high confidence; survivors get
their exact distance on the original vectors. The list centres and the number of probed lists are
fitted on a bounded sample; every vector is indexed.

Defined cases: vectors that are null, zero, of another dimension than most, or hold null or
non-finite components take no part, as queries or candidates; equal distances go to the smaller
id; rows that repeat an id count once; rows with a null id take no part; a query with fewer than
`k` others gets them all; columns other than id and vector are not used; a table without rows
gives none.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.memory import received, send
from docquery.shared import materialize

# Centres and the number of probes come from at most so many vectors.
SAMPLE = 16_384
# A query's first radius comes from so many vectors, which also fill up what a short scan leaves.
PILOT = 128
ROWS_PER_LIST, MOST_LISTS = 1000, 1024
# The share of true neighbours that the probed lists hold on the sample.
TARGET_RECALL = 0.98
# How surely a candidate must be too far before it is abandoned, and dimensions between tests.
CONFIDENCE = 2.1
COLUMNS = 16
BLOCK_ROWS, BATCH_QUERIES, MOST_BUFFERED = 1024, 256, 65_536
MOST_OPEN_QUERIES = 20_000


@dataclass
class Index:
    """Everything fitted: centres of the lists, the rotation, the number of probes and the pilot vectors."""

    centres: np.ndarray
    rotation: np.ndarray
    probes: int
    pilot_ids: np.ndarray
    pilot: np.ndarray
    list_rows: np.ndarray | None = None


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `a` and `b`, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def exact_distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, the same for equal rows wherever they stand."""
    gaps = rows.astype(np.float64) - query.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", gaps, gaps))


def _nearest(distances: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` nearest, ties to the smaller id."""
    if len(ids) > k:
        bound = np.partition(distances, k - 1)[k - 1]
        chosen = np.flatnonzero(distances <= bound)
    else:
        chosen = np.arange(len(ids))
    return chosen[np.lexsort((ids[chosen], distances[chosen]))][:k]


def fit_index(ids: np.ndarray, vectors: np.ndarray, n_rows: int, k: int, seed: int = 11) -> Index:
    """Fit on sampled vectors of a table of `n_rows`."""
    random = np.random.default_rng(seed)
    dim = vectors.shape[1]
    rotation = np.linalg.qr(random.normal(size=(dim, dim)))[0]
    rows = vectors.astype(np.float64)
    n_lists = int(min(MOST_LISTS, max(1, n_rows // ROWS_PER_LIST), len(rows)))
    centres = rows[random.choice(len(rows), n_lists, replace=False)]
    for _ in range(12):
        nearest = _squares(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        sizes = np.bincount(nearest, minlength=n_lists)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
    nearest = _squares(rows, centres).argmin(1)
    tests = random.choice(len(rows), min(400, len(rows)), replace=False)
    apart = _squares(rows[tests], rows)
    apart[np.arange(len(tests)), tests] = np.inf
    true = np.argsort(apart, axis=1)[:, : min(k, len(rows) - 1)]
    order = np.argsort(np.argsort(_squares(rows[tests], centres), axis=1), axis=1)
    ranks = np.sort(np.take_along_axis(order, nearest[true], axis=1).ravel()) if true.size else np.zeros(1)
    probes = int(ranks[min(len(ranks) - 1, int(len(ranks) * TARGET_RECALL))]) + 1
    return Index(centres, rotation, probes, ids[:PILOT], vectors[:PILOT].astype(np.float32))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def _emit(lists: dict[int, list[tuple[int, np.ndarray]]], n: int, index: Index) -> list[tuple]:
    rows = lists.pop(n)
    ids = np.array([r[0] for r in rows], np.int64)
    exact = np.stack([r[1] for r in rows])
    turned = np.ascontiguousarray((exact.astype(np.float64) @ index.rotation).astype(np.float32).T)
    return [(n, ids.tobytes(), exact.tobytes(), turned.tobytes())]


_BLOCKS = "list int, ids binary, exact binary, turned binary"


def _as_batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _blocks(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    index: Index = received(sent)
    dim = index.centres.shape[1]
    names, kinds = ["list", "ids", "exact", "turned"], [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    lists: dict[int, list] = {}
    buffered = 0
    for batch in batches:
        vectors = _matrix(batch.column(1), dim)
        nearest = _squares(vectors.astype(np.float64), index.centres).argmin(1)
        for i, n, v in zip(batch.column(0).to_pylist(), nearest.tolist(), vectors):
            lists.setdefault(n, []).append((i, v))
            buffered += 1
            if len(lists[n]) >= BLOCK_ROWS:
                buffered -= len(lists[n])
                yield _as_batch(_emit(lists, n, index), names, kinds)
        if buffered >= MOST_BUFFERED:
            for n in list(lists):
                yield _as_batch(_emit(lists, n, index), names, kinds)
            buffered = 0
    for n in list(lists):
        yield _as_batch(_emit(lists, n, index), names, kinds)


_QUERIES = "list int, ids binary, queries binary, radii binary, found_ids binary, found_scores binary"


def _probes(batches: Iterator[pa.RecordBatch], sent: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    """Queries in batches by probed list; list -1 has what the pilot already found for them."""
    index: Index = received(sent)
    dim = index.centres.shape[1]
    names = [part.split()[0] for part in _QUERIES.split(", ")]
    kinds = [pa.int32(), *[pa.binary()] * 5]
    lists: dict[int, list] = {}

    def row(n: int) -> list[tuple]:
        rows = lists.pop(n)
        ids, vectors, radii = zip(*rows)
        return [(n, np.array(ids, np.int64).tobytes(), np.stack(vectors).tobytes(), np.array(radii).tobytes(), None, None)]

    for batch in batches:
        vectors = _matrix(batch.column(1), dim)
        order = np.argsort(_squares(vectors.astype(np.float64), index.centres), axis=1)
        for i, v, near in zip(batch.column(0).to_pylist(), vectors, order):
            others = np.flatnonzero(index.pilot_ids != i)
            scores = exact_distances(v, index.pilot[others])
            best = _nearest(scores, index.pilot_ids[others], k)
            radius = scores[best[-1]] if len(best) == k else np.inf
            found = index.pilot_ids[others][best], scores[best]
            yield _as_batch([(-1, np.int64(i).tobytes(), b"", b"", found[0].tobytes(), found[1].tobytes())], names, kinds)
            # As many lists as fitted, and more where these hold too few rows.
            enough = int(np.searchsorted(np.cumsum(index.list_rows[near]), k + 1)) + 1
            for n in near[: max(index.probes, enough)].tolist():
                lists.setdefault(n, []).append((i, v, radius))
                if len(lists[n]) >= BATCH_QUERIES:
                    yield _as_batch(row(n), names, kinds)
    for n in list(lists):
        yield _as_batch(row(n), names, kinds)


def scan_block(
    queries: np.ndarray, turned_queries: np.ndarray, turned: np.ndarray, exact: np.ndarray, radii: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the tests leave of all pairs of queries and block rows: query, row, and exact distance."""
    dim, n = turned.shape
    query, row = np.divmod(np.arange(len(queries) * n), n)
    partial = np.zeros(len(query))
    for at in range(0, dim, COLUMNS):
        gaps = turned[at : at + COLUMNS, row] - turned_queries.T[at : at + COLUMNS, query]
        partial += np.einsum("ij,ij->j", gaps, gaps)
        done = min(at + COLUMNS, dim)
        slack = 1 + CONFIDENCE / done**0.5 if done < dim else 1 + 1e-6
        near = partial <= (radii**2 * slack**2 * done / dim + 1e-9)[query]
        query, row, partial = query[near], row[near], partial[near]
        if not len(query):
            break
    return query, row, exact_distances(queries[query], exact[row])


def _scanned(batches: Iterator[pa.RecordBatch], sent: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    index: Index = received(sent)
    dim = index.centres.shape[1]
    names, kinds = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> pa.RecordBatch:
        rows = [(q, i, s) for q, (ids, scores) in best.items() for i, s in zip(ids.tolist(), scores.tolist())]
        best.clear()
        return _as_batch(rows, names, kinds)

    for batch in batches:
        for ids, exact, turned, queries, vectors, radii in zip(*[c.to_pylist() for c in batch.columns]):
            ids, queries = np.frombuffer(ids, np.int64), np.frombuffer(queries, np.int64)
            exact = np.frombuffer(exact, np.float32).reshape(-1, dim)
            turned = np.frombuffer(turned, np.float32).reshape(dim, -1).astype(np.float64)
            vectors = np.frombuffer(vectors, np.float32).reshape(-1, dim)
            turned_queries = vectors.astype(np.float64) @ index.rotation
            radii = np.minimum(np.frombuffer(radii, np.float64), [
                best[q][1][-1] if q in best and len(best[q][0]) == k else np.inf for q in queries.tolist()
            ])
            query, places, scores = scan_block(vectors, turned_queries, turned, exact, radii)
            other = ids[places] != queries[query]
            query, found, scores = query[other], ids[places[other]], scores[other]
            for at in np.unique(query).tolist():
                mine = query == at
                known = best.get(int(queries[at]), (np.zeros(0, np.int64), np.zeros(0)))
                near, first = np.unique(np.append(known[0], found[mine]), return_index=True)
                apart = np.append(known[1], scores[mine])[first]
                chosen = _nearest(apart, near, k)
                best[int(queries[at])] = near[chosen], apart[chosen]
            if len(best) >= MOST_OPEN_QUERIES:
                yield out()
    if best:
        yield out()


def _valid(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """`(id, vector)` of the rows that take part, and their dimension."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & ~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").head()
    dim = sizes["dim"] if sizes else 0
    return rows.filter(F.size("vector") == dim), dim


def nearest_neighbours(
    rows: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each row with `is_query(id)` its `k` nearest others found."""
    spark = rows.sparkSession
    valid, dim = _valid(rows, key, vector)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_rows = valid.count()
    sample = valid.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    vectors = _matrix(sample.column("vector").combine_chunks(), dim)
    index = fit_index(sample.column("id").to_numpy(), vectors, n_rows, k)
    sent = send(spark, index)
    blocks = materialize(valid.mapInArrow(lambda b: _blocks(b, sent), _BLOCKS), "blocks")
    # At most a row per list.
    counts = blocks.groupBy("list").agg(F.sum(F.expr("octet_length(ids) div 8")).alias("n")).collect()
    index.list_rows = np.zeros(len(index.centres), np.int64)
    for row in counts:
        index.list_rows[row["list"]] = row["n"]
    fitted = send(spark, index)
    queries = valid.filter(is_query(F.col("id"))).dropDuplicates(["id"])
    asked = materialize(queries.mapInArrow(lambda b: _probes(b, fitted, k), _QUERIES), "probes")
    pairs = blocks.join(asked.withColumnRenamed("ids", "query_ids"), "list").select(
        "ids", "exact", "turned", "query_ids", "queries", "radii"
    )
    scanned = pairs.mapInArrow(lambda b: _scanned(b, fitted, k), "query_id long, vec_id long, score double")
    known = asked.filter(F.col("list") == -1).mapInArrow(_known, "query_id long, vec_id long, score double")
    found = scanned.unionByName(known).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pilot found, as rows."""
    for batch in batches:
        rows = [
            (int(np.frombuffer(q, np.int64)[0]), int(i), float(s))
            for q, ids, scores in zip(*[batch.column(c).to_pylist() for c in ("ids", "found_ids", "found_scores")])
            for i, s in zip(np.frombuffer(ids, np.int64), np.frombuffer(scores, np.float64))
        ]
        if rows:
            yield _as_batch(rows, ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()])
