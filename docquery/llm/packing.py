"""Best-two-fit packing of token pieces into sequences of a fixed length.

A sequence is filled greedily, largest piece first; then its smallest piece gives way to two
unpacked pieces that fill the room better, as long as such a pair exists. Lengths are small
integers, so the decisions are taken on the number of pieces of each length (a row per length,
whatever the corpus), and one decision serves as many equal sequences as the counts allow. The
pieces then find their places by their rank among the pieces of their length, where they lie.

Defined cases: a null text is empty and has the closing id only; repeated rows are packed each; a
text longer than a sequence is cut, its last piece may be shorter; a table without rows gives
none; columns other than key and text are not carried.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.memory import give_back
from docquery.llm.wordids import word_ids
from docquery.llm.words import slices
from docquery.shared import materialize

SEQUENCE = 2048
CLOSING_ID = 0


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The rank of each piece among those of its length, after the `seen` ones, to which they are added."""
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=len(seen))
    ranks = np.empty(len(lengths), np.int64)
    ranks[order] = np.arange(len(lengths)) - np.repeat(np.cumsum(counts) - counts, counts)
    ranks += seen[lengths]
    seen += counts
    return ranks


def _cut(batches: Iterator[pa.RecordBatch], path: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    encoder = word_ids(path)
    task = TaskContext.get().partitionId()
    seen = np.zeros(SEQUENCE + 1, np.int64)
    for batch in batches:
        for part in slices(batch, 1):
            ids, bounds = encoder.encode(part.column(1), closing=CLOSING_ID)
            sizes = np.diff(bounds)
            pieces = -(-sizes // SEQUENCE)
            rows = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            lengths = np.minimum(sizes[rows] - piece * SEQUENCE, SEQUENCE)
            ends = np.append(0, 4 * np.cumsum(lengths)).astype(np.int32)
            data = pa.py_buffer(ids.astype("<u4", copy=False))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(piece * SEQUENCE),
                    pa.array(lengths), pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), data]),
                    pa.array(np.full(len(rows), task)), pa.array(_ranks(lengths, seen)),
                ],
                names=names,
            )
        give_back()


def token_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored pieces `(key, piece, start, length, ids, task, rank)` of every text.

    `ids` are little-endian unsigned 32-bit integers; `rank` counts the pieces of the same length
    that the same task wrote before.
    """
    columns = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = columns.schema["key"].dataType.simpleString()
    ddl = f"key {kind}, piece int, start long, length long, ids binary, task long, rank long"
    names = [part.split()[0] for part in ddl.split(", ")]
    cut = columns.mapInArrow(lambda b: _cut(b, path, names), ddl)
    return materialize(cut.withColumnRenamed("key", key), "pieces")


def plan_sequences(counts: np.ndarray) -> dict[int, np.ndarray]:
    """From the number of pieces of each length: the places of each length's pieces, in rank order.

    Rows are `(first rank, pieces per sequence, first sequence, offset in the sequence)`.
    """
    left = counts.astype(np.int64).copy()
    size = len(left) - 1
    lengths = np.arange(size + 1)
    used = np.zeros(size + 1, np.int64)
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    while left.any():
        free = left.copy()
        taken: dict[int, int] = {}
        gap = size
        fit = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        length = int(fit[gap])
        while length:
            n = min(int(free[length]), gap // length)
            if n:
                taken[length] = taken.get(length, 0) + n
                free[length] -= n
                gap -= n * length
            below = min(length - 1, gap) if free[length] == 0 or gap < length else gap
            length = int(fit[below])
        while gap:
            smallest = min(taken)
            room = gap + smallest
            # The best partner of each length: the longest one left that still fits beside it.
            fit = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            one = np.flatnonzero(free[: room + 1] > 0)
            two = fit[room - one]
            alone = (two == one) & (free[one] < 2)
            two[alone] = fit[one[alone] - 1]
            good = two > 0
            if not good.any():
                break
            sums = np.where(good, one + two, 0)
            best = int(sums.argmax())
            if sums[best] <= smallest:
                break
            taken[smallest] -= 1
            free[smallest] += 1
            if not taken[smallest]:
                del taken[smallest]
            for new in (int(one[best]), int(two[best])):
                taken[new] = taken.get(new, 0) + 1
                free[new] -= 1
            gap = room - int(sums[best])
        times = min(int(left[x]) // n for x, n in taken.items())
        offset = 0
        for x, n in taken.items():
            rows.setdefault(x, []).append((int(used[x]), n, sequence, offset))
            offset += n * x
            used[x] += n * times
            left[x] -= n * times
        sequence += times
    return {x: np.array(r, np.int64) for x, r in rows.items()}


def _placed(batches: Iterator[pa.RecordBatch], plan: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("place").to_numpy()
        sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            rows = plan[int(length)]
            first, each, sequence, offset = rows[np.searchsorted(rows[:, 0], ranks[at], "right") - 1].T
            done = ranks[at] - first
            sequences[at] = sequence + done // each
            offsets[at] = offset + done % each * length
        keep = [i for i, n in enumerate(batch.schema.names) if n != "place"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in keep], pa.array(sequences), pa.array(offsets)],
            names=[*[batch.schema.names[i] for i in keep], "sequence_id", "offset"],
        )


def pack_pieces(pieces: DataFrame) -> DataFrame:
    """Add `sequence_id` and `offset` to stored pieces that have `task`, `rank` and `length`."""
    counted = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        counted.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "starts"
    )
    counts = np.zeros(SEQUENCE + 1, np.int64)
    # At most a row per length.
    for row in starts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    plan = pieces.sparkSession.sparkContext.broadcast(plan_sequences(counts))
    ranked = pieces.join(starts.drop("n"), ["task", "length"]).withColumn("place", F.col("rank") + F.col("before"))
    ranked = ranked.drop("task", "rank", "before")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("place").schema)
    return ranked.mapInArrow(lambda b: _placed(b, plan.value), f"{kinds}, sequence_id long, offset long")
