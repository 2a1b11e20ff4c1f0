"""The trie of conversations by their turns: how many share each beginning, and what sharing it saves.

A conversation is a path of turn digests. Paths are dealt out by range, so a node's members stand
next to each other, and are worked on in blocks of bounded size: a matrix of turn ids, padded with
zeros, is sorted with `lexsort`; the accumulated change masks of its columns mark where the nodes of
each depth begin, and `reduceat` sums up every depth. Only the nodes above a block's first and
last row can go on in a neighbouring block. They are combined by their digest, together with what
neighbouring blocks count twice: the nodes of the common beginning of the two rows that meet.

Defined cases: a null role or text counts as empty; a null turn number comes first; turns with the
same number are ordered by a digest of role and text; rows without a conversation id are left out;
repeated rows are repeated turns; a conversation without turns ends at the root; an empty table has
no nodes, not even a root; a conversation is one row of 24 bytes a turn, whatever its texts; only
the named columns are used. Turns count as equal if their 128-bit digests are.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.shared import hot_keys, join_around_hot, materialize

# Cells of a block's matrix, unless one conversation has more, and turns of a range.
BLOCK_CELLS, RANGE_TURNS = 1 << 20, 1 << 21
# Rows of open nodes that may be broadcast, at some 50 bytes.
MOST_BROADCAST = 200_000

_DIGEST = 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_paths(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """`(key, turns)`: each conversation's turns in order, as `(digest, size)` with the text's size in bytes."""
    said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    size = F.octet_length(said[1]).cast("long")
    digest = F.md5(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said))
    rows = turns.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.struct(F.col(order).alias("n"), digest.alias("digest"), size.alias("size")).alias("t")
    )
    listed = rows.groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return listed.select(F.col("key").alias(key), plain.alias("turns"))


def _dense(digests: np.ndarray) -> np.ndarray:
    """Numbers from 1 that order like the 16-byte digests."""
    high, low = digests.view(">u8").reshape(-1, 2).T
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    ids = np.empty(len(order), np.int32)
    ids[order] = 1 + np.cumsum(np.append(False, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))[: len(order)]
    return ids


def _prefix_digests(path: bytes) -> list[bytes]:
    """The digest that names each beginning of a path, from the empty one on."""
    running = hashlib.md5(usedforsecurity=False)
    found = [running.digest()]
    for at in range(0, len(path), _DIGEST):
        running.update(path[at : at + _DIGEST])
        found.append(running.digest())
    return found


def _common(a: bytes, b: bytes) -> int:
    """Turns in which two paths agree from the beginning."""
    n = min(len(a), len(b)) // _DIGEST
    a, b = (np.frombuffer(x, np.uint64, 2 * n).reshape(-1, 2) for x in (a, b))
    differ = np.flatnonzero((a != b).any(axis=1))
    return int(differ[0]) if len(differ) else n


_COLUMNS = {
    "kind": pa.int8(), "part": pa.int32(), "node": pa.binary(), "parent": pa.binary(), "depth": pa.int64(),
    "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "first_end": pa.int64(),
    "ends": pa.binary(), "first": pa.binary(), "last": pa.binary(), "sizes": pa.list_(pa.int64()),
}
_DDL = """kind tinyint, part int, node binary, parent binary, depth long, conv_id long, parent_conv_id long,
    n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, first_end long,
    ends binary, first binary, last binary, sizes array<long>"""
CLOSED, OPEN, EDGE = 0, 1, 2


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [
        pa.array(columns[c], kind) if c in columns else pa.nulls(n, kind) for c, kind in _COLUMNS.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))


def _overlap(last: bytes, sizes: list[int], first: bytes) -> pa.RecordBatch:
    """What two blocks count twice if a row `last`, with texts of `sizes`, meets a row `first`."""
    depth = _common(last, first)
    names = _prefix_digests(last[: depth * _DIGEST])
    below = np.cumsum(np.array([0, *sizes[:depth]], np.int64)[::-1])[::-1]
    goes_on = depth == len(last) // _DIGEST
    return _rows(
        kind=[OPEN] * (depth + 1), node=names, parent=[None, *names[:-1]], depth=np.arange(depth + 1),
        n_convs=np.zeros(depth + 1, np.int64), n_children=-(np.arange(depth + 1) < depth).astype(np.int64),
        n_leaves=np.full(depth + 1, -int(goes_on)), saved_tokens=below,
    )


def block_nodes(keys: np.ndarray, paths: list[bytes], sizes: list[np.ndarray]) -> tuple[pa.RecordBatch, bytes, bytes, list[int]]:
    """The nodes of a block of conversations in any order, with its first and last path and the last's sizes.

    Nodes on the first and the last path are given as open: as if the block were all there is.
    """
    n, lengths = len(keys), np.fromiter(map(len, paths), np.int64, len(paths)) // _DIGEST
    width = int(lengths.max())
    filled = np.arange(width) < lengths[:, None]
    ids, bytes_of = np.zeros((n, width), np.int32), np.zeros((n, width), np.int64)
    ids[filled] = _dense(np.frombuffer(b"".join(paths), np.uint8))
    bytes_of[filled] = np.concatenate(sizes)
    order = np.lexsort((keys, *ids.T[::-1]))
    keys, lengths, ids, bytes_of = keys[order], lengths[order], ids[order], bytes_of[order]

    changed = np.zeros((n + 1, width + 1), bool)
    changed[0] = changed[n, 1:] = True
    np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1, out=changed[1:n, 1:])
    row = np.arange(n)
    leaf = changed[row + 1, lengths]
    leaf[-1] = True
    # What a row adds to the savings of its nodes of at least each depth.
    spared = np.zeros((n, width + 2), np.int64)
    spared[:, 1:-1] = np.where(changed[:n, 1:], 0, bytes_of)
    spared = np.cumsum(spared[:, ::-1], axis=1)[:, ::-1]

    first, last = paths[order[0]], paths[order[-1]]
    on_first, on_last = _prefix_digests(first), _prefix_digests(last)
    made: dict[str, list] = {c: [] for c in (
        "kind", "node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256", "first_end", "ends",
    )}
    before = np.zeros(n, np.int64), np.zeros(0, np.int64)
    for depth in range(width + 1):
        starts = np.flatnonzero(changed[:n, depth])
        least = np.minimum.reduceat(keys, starts)
        segment = np.cumsum(changed[:n, depth]) - 1
        here = lengths[starts] >= depth
        begins = changed[:n, depth + 1] & (lengths > depth) if depth < width else np.zeros(n, bool)
        ended = np.add.reduceat((lengths == depth).astype(np.int64), starts)[here]
        children = np.add.reduceat(begins.astype(np.int64), starts)[here]
        leaves = np.add.reduceat(leaf.astype(np.int64), starts)[here]
        saved = np.add.reduceat(spared[:, max(depth, 1)], starts)[here]
        ends_at = np.append(starts[1:], n)[here]
        starts = starts[here]
        opened = (starts == 0) | (ends_at == n)
        above = before[1][before[0][starts]] if depth else None
        above_open = np.zeros(len(starts), bool)
        if depth:
            # A parent is open if it holds the first or the last row.
            above_open = (before[0][starts] == before[0][0]) | (before[0][starts] == before[0][n - 1])
        made["kind"].append(np.where(opened, OPEN, CLOSED))
        for i, (a, e, is_open) in enumerate(zip(starts.tolist(), ended.tolist(), opened.tolist())):
            text = ",".join(map(str, keys[a : a + e].tolist())).encode() if e else b""
            made["node"].append((on_first if a == 0 else on_last)[depth] if is_open else None)
            made["ends_sha256"].append(None if is_open else hashlib.sha256(text).hexdigest() if e else _NO_ENDS)
            made["ends"].append(text if is_open and e else None)
            made["first_end"].append(int(keys[a]) if is_open and e else None)
            if depth:
                parent = (on_first if before[0][a] == before[0][0] else on_last)[depth - 1] if above_open[i] else None
                made["parent"].append(parent)
                made["parent_conv_id"].append(None if above_open[i] else int(above[i]))
            else:
                made["parent"].append(None)
                made["parent_conv_id"].append(None)
        made["depth"].append(np.full(len(starts), depth))
        made["conv_id"].append(least[here])
        made["n_convs"].append(ends_at - starts)
        made["n_children"].append(children)
        made["n_leaves"].append(leaves)
        made["saved_tokens"].append(saved)
        before = segment, least
    whole = {c: np.concatenate(v) if isinstance(v[0], np.ndarray) else v for c, v in made.items()}
    return _rows(**whole), first, last, bytes_of[-1, : lengths[-1]].tolist()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted `(key, path, sizes)` of one range, and the rows at its two edges."""
    opening, last, sizes = None, b"", []
    for batch in batches:
        lengths = np.fromiter(map(len, batch.column(1).to_pylist()), np.int64, len(batch)) // _DIGEST
        at = 0
        while at < len(batch):
            cells = np.maximum.accumulate(lengths[at:]) * np.arange(1, len(batch) - at + 1)
            n = max(1, int(np.searchsorted(cells, BLOCK_CELLS, "right")))
            part = batch.slice(at, n)
            at += n
            nodes, first, end, end_sizes = block_nodes(
                part.column(0).to_numpy(), part.column(1).to_pylist(), [np.array(s, np.int64) for s in part.column(2).to_pylist()]
            )
            yield nodes
            if opening is None:
                opening = first
            else:
                yield _overlap(last, sizes, first)
            last, sizes = end, end_sizes
    if opening is not None:
        yield _rows(kind=[EDGE], part=[TaskContext.get().partitionId()], first=[opening], last=[last], sizes=[sizes])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for last, sizes, first in zip(*(c.to_pylist() for c in batch.columns)):
            yield _overlap(last, sizes, first)


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the joined `ends` of each node, whose rows come one after the other."""
    node, running = None, None

    def said() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([running.hexdigest()])], names=["node", "ends_sha256"]
        )

    for batch in batches:
        for name, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name == node:
                running.update(b"," + ends)
                continue
            if node is not None:
                yield said()
            node, running = name, hashlib.sha256(ends)
    if node is not None:
        yield said()


def prefix_trie(paths: DataFrame, key: str = "conv_id") -> DataFrame:
    """A row for each node of the `(key, turns)`; `key` is a whole number.

    `conv_id` is the smallest member of the node and `parent_conv_id` that of its parent, `n_convs`
    counts the members, `n_leaves` the childless nodes of the subtree, `saved_tokens` what its nodes
    save if each text is kept once, and `ends_sha256` names the members that end here.
    """
    spark = paths.sparkSession
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    stored = materialize(
        paths.select(F.col(key).cast("long").alias("key"), joined.alias("path"),
                     F.transform("turns", lambda t: t["size"]).alias("sizes")),
        "paths",
    )
    turns = stored.agg(F.sum(F.size("sizes") + 1).alias("n")).head()["n"] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // RANGE_TURNS))
    ordered = stored.repartitionByRange(ranges, "path", "key").sortWithinPartitions("path", "key")
    found = materialize(ordered.mapInArrow(_blocks, _DDL), "prefix-nodes")

    numbers = "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
    # A number for each range that has rows.
    parts = sorted(r["part"] for r in found.filter(f"kind = {EDGE}").select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, next int")
    edges = found.filter(f"kind = {EDGE}")
    meeting = edges.select("part", "last", "sizes").join(after, "part").join(
        edges.select(F.col("part").alias("next"), "first"), "next"
    ).select("last", "sizes", "first").mapInArrow(_overlaps, _DDL)
    opened = found.filter(f"kind = {OPEN}")
    summed = opened.unionByName(meeting).groupBy("node").agg(
        F.first("parent", ignorenulls=True).alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    ends = opened.filter("ends is not null").select("node", "ends", "first_end").repartition("node").sortWithinPartitions(
        "node", "first_end"
    ).select("node", "ends").mapInArrow(_hashed_ends, "node binary, ends_sha256 string")
    whole = materialize(
        summed.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))), "open-nodes"
    )

    closed = found.filter(f"kind = {CLOSED}")
    under = closed.filter("parent is not null").select("parent", *numbers, "ends_sha256").unionByName(
        whole.filter("depth > 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(
            "parent", *numbers, "ends_sha256"
        )
    ).drop("parent_conv_id")
    names = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    if names.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        named = under.join(F.broadcast(names), "parent")
    else:
        counts = under.groupBy("parent").agg(F.count("*").alias("n"))
        named = join_around_hot(under, names, "parent", hot_keys(counts, "parent"))
    root = whole.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    rest = closed.filter("parent is null")
    return rest.select(*columns).unionByName(named.select(*columns)).unionByName(root.select(*columns))
