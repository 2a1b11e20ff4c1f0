"""Near-duplicates of word-shingle sets through an LSH forest, with every link confirmed on full sets.

Equal sets are one class. Each class has minhash values in several orders (trees); in the sorted
order of a tree, classes that share a prefix stand together, the longer the prefix the closer.
A class is compared with its neighbours there as far as they share a prefix, so the depth adapts:
sparse regions are compared at shallow depth, dense ones at greater depth.

Classes are compared by the parity of their shingles in a table of bits. The bits in which two
classes differ are never more than the shingles in which they do, so no link is lost by this test, and
few pairs far below the limit pass it. Only sets too large for the table are compared by minhash values,
with a margin of 4.5 standard deviations. The rows of the trees carry a brief form of half the size, the
table folded once, for which the same holds.

Links are confirmed twice. The first time confirms each class's best neighbours and joins them to
components. The second looks at all classes that share a prefix of the least depth in a tree, a
region: every pair of different components that passes the test is confirmed. A region of more than
`block` rows is compared in pairs of blocks. A link inside a component changes nothing and need not
be confirmed.

Texts and sketches are what weighs, so neither is shuffled where a key will do: of the texts only those of
classes that have a candidate pass a table of bits, where they lie, and sketches join a region's rows only
where it has rows of several components.

Defined cases: null or empty texts have empty sets and are linked with nothing; a text of fewer
words than a shingle is one shingle; repeated rows share a class; a null key counts as larger
than any other; very long texts are worked on whole, one at a time; columns other than key and text
are not used; a table without rows gives none.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.components import components
from docquery.shared import discard, materialize


@dataclass(frozen=True)
class Forest:
    """Two texts of similarity s share a prefix of length d in a tree with chance s^d.

    By chance, texts of one language share d values with about 0.03^d of the others, so among n
    texts a depth of log(n)/3.5 separates them: 3 or 4 for a million, 7 for 10^11, where more
    trees are needed.
    """

    words: int = 5
    percent: int = 80
    trees: int = 16
    depth: int = 8
    # Values that neighbours must share at least, near neighbours that are compared first, and the
    # rows of a region that are compared in one piece.
    least_depth: int = 2
    near: int = 16
    block: int = 4096
    best: int = 3

    def least_agreement(self, values: int) -> int:
        """Equal bytes of so many minhash values that a linked pair of large sets has but for 4.5 standard deviations."""
        s = self.percent / 100
        return max(1, int(values * s - 4.5 * (values * s * (1 - s)) ** 0.5))

    @property
    def least_large(self) -> int:
        """The size from which a set may be linked with one too large for the table of bits."""
        return PARITY_MOST * self.percent // 100


# Bits of the table, the size of a set up to which it is used, and minhash values that are compared beyond.
PARITY_BITS, PARITY_MOST, MINHASHES = 1024, 750, 128
_SKETCH = PARITY_BITS // 8 + MINHASHES
# The first half of a sketch is its brief form: the table folded once, and half of the minhash values.
_BRIEF, _FOLDED = _SKETCH // 2, PARITY_BITS // 16
# The table of bits of the texts that are wanted: so many for each, and never more than 16 MB.
_BITS_EACH, _BITS_MOST = 64, 27


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words; A-Z count as a-z."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    runs = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        runs = runs * _MIX[0] + hashes[i : len(words) - width + 1 + i]
        runs ^= runs >> np.uint64(31)
    runs *= _MIX[1]
    runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest of all shingles under each multiplicative hash, as its upper 32 bits."""
    least = np.full(len(multipliers), ~np.uint64(0))
    for at in range(0, len(shingles), 256):
        np.minimum(least, (shingles[at : at + 256, None] * multipliers).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(shingles: np.ndarray, minhashes: np.ndarray, forest: Forest) -> bytes:
    """What two sets are compared by: parities of a small set, minhash bytes of a large one, zeros for the rest.

    Its first half, the brief form, has the parities of a table of half the size, which is the exclusive or of the
    table's halves. The second half has what is left.
    """
    n = len(shingles)
    parities, low = np.zeros(PARITY_BITS // 8, np.uint8), np.zeros(MINHASHES, np.uint8)
    if n <= PARITY_MOST:
        place = (shingles * _MIX[2]) >> np.uint64(64 - (PARITY_BITS - 1).bit_length())
        parities = np.packbits(np.bincount(place.astype(np.int64), minlength=PARITY_BITS) & 1)
    if n >= forest.least_large:
        low = minhashes[:MINHASHES].astype(np.uint8)
    first, second = parities[:_FOLDED], parities[_FOLDED:]
    return np.concatenate([first ^ second, low[: MINHASHES // 2], second, low[MINHASHES // 2 :]]).tobytes()


class _Compared:
    """Rows with sketches, whole or brief, and sizes, and the test of pairs of them."""

    def __init__(self, sketches: np.ndarray, sizes: np.ndarray, forest: Forest):
        parities, self.low = sketches[:, :_FOLDED], sketches[:, _FOLDED:_BRIEF]
        if sketches.shape[1] == _SKETCH:
            second = sketches[:, _BRIEF : _BRIEF + _FOLDED]
            parities = np.concatenate([parities ^ second, second], axis=1)
            self.low = np.concatenate([self.low, sketches[:, _BRIEF + _FOLDED :]], axis=1)
        self.parities = np.ascontiguousarray(parities).view(np.uint64)
        self.sizes, self.forest = sizes, forest

    def test(self, a, b) -> tuple[np.ndarray, np.ndarray]:
        """Whether rows `a` and `b` may be linked, and about how similar they are, in thousandths.

        `a` and `b` are indexes of rows, pair by pair, or one of them a single row.
        """
        p = self.forest.percent
        x, y = self.sizes[a], self.sizes[b]
        both, larger = x + y, np.maximum(x, y)
        differ = np.bitwise_count(self.parities[a] ^ self.parities[b]).sum(axis=-1, dtype=np.int64)
        possible = (100 + p) * differ <= (100 - p) * both
        score = 1000 * (both - differ) // (both + differ)
        large = np.flatnonzero(larger > PARITY_MOST)
        if len(large):
            agree = (_picked(self.low, a, large) == _picked(self.low, b, large)).sum(axis=-1, dtype=np.int64)
            values = self.low.shape[1]
            possible[large] = agree >= self.forest.least_agreement(values)
            score[large] = 1000 * agree // values
        return possible & (100 * np.minimum(x, y) >= p * larger), score


def _picked(values: np.ndarray, rows, some: np.ndarray) -> np.ndarray:
    """The values of `some` of the `rows`, which may be a single one."""
    return values[rows] if np.ndim(rows) == 0 and not isinstance(rows, slice) else values[rows][some]


def _digest(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


def text_digest(text: Column) -> Column:
    """The `text_id` of a text."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _signed(batches: Iterator[pa.RecordBatch], forest: Forest, names: list[str]) -> Iterator[pa.RecordBatch]:
    multipliers = _multipliers(forest.trees * forest.depth)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [t or "" for t in part.column(1).to_pylist()]
            sets = [shingle_set(t, forest.words) for t in texts]
            signatures = [signature(s, multipliers) for s in sets]
            values = [x.reshape(forest.trees, forest.depth) for x in signatures]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([_digest(t.encode()) for t in texts], pa.binary()),
                    pa.array([x[:, : forest.least_depth].astype(">u4").tobytes() for x in values], pa.binary()),
                    pa.array([x[:, forest.least_depth :].astype(np.uint8).tobytes() for x in values], pa.binary()),
                    pa.array([sketch(s, x, forest) for s, x in zip(sets, signatures)], pa.binary()),
                ],
                names=names,
            )


def _places(batches: Iterator[pa.RecordBatch], mask: int) -> Iterator[pa.RecordBatch]:
    """Hashes `at` as the words and bits of the table that they set."""
    for batch in batches:
        at = batch.column(0).to_numpy() & mask
        bits = np.uint64(1) << (at & 63).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bits.view(np.int64))], names=["word", "bits"])


def _wanted_bits(wanted: DataFrame) -> tuple[Broadcast, int]:
    """The table of bits of the hashes `at`, and its mask. Where it fills up, more pass it, never fewer."""
    spark = wanted.sparkSession
    size = 1 << min(_BITS_MOST, max(16, (_BITS_EACH * wanted.count()).bit_length()))
    found = wanted.mapInArrow(lambda b: _places(b, size - 1), "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")
    ).toArrow()
    table = np.zeros(size // 64, np.uint64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(table), size - 1


def _sets(batches: Iterator[pa.RecordBatch], width: int, bits: Broadcast, mask: int) -> Iterator[pa.RecordBatch]:
    """`(at, text)` to the `(node, shingles)` of the texts whose hash `at` is in the table of bits."""
    for batch in batches:
        at = batch.column(0).to_numpy() & mask
        passed = (bits.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        batch = batch.filter(pa.array(passed.astype(bool)))
        for start in range(0, batch.num_rows, 500):
            texts = batch.column(1).slice(start, 500).to_pylist()
            sets = [s.tobytes() for s in (shingle_set(t or "", width) for t in texts) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(_digest, sets)), pa.binary()), pa.array(sets, pa.binary())], names=["node", "shingles"]
            )


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a binary column whose values all have `width` bytes, as a matrix."""
    column = column.cast(pa.binary(width))
    data = np.frombuffer(column.buffers()[1], np.uint8)
    return data[column.offset * width : (column.offset + len(column)) * width].reshape(-1, width)


def _ends(nodes: np.ndarray, rows: np.ndarray) -> pa.Array:
    return pa.array(list(map(bytes, nodes[rows])), pa.binary())


def _neighbours(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    """Of rows `(tree, path, brief, n, node)` in sorted order, each with its best near predecessor."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree = batch.column(0).to_numpy(zero_copy_only=False)[:, None].astype(">u4").view(np.uint8)
        rows = [
            np.concatenate([tree, _fixed(batch.column(1), _path_width(forest))[:, : 4 * forest.least_depth]], axis=1),
            _fixed(batch.column(2), _BRIEF), batch.column(3).to_numpy(zero_copy_only=False), _fixed(batch.column(4), 16),
        ]
        seen = 0 if held is None else len(held[0])
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows)]
        prefix, sketches, sizes, node = rows
        compared, n = _Compared(sketches, sizes, forest), len(prefix)
        found = [(np.zeros(0, np.int64),) * 3]
        for back in range(1, min(forest.near, n - 1) + 1):
            later = np.arange(max(back, seen), n)
            later = later[(prefix[later] == prefix[later - back]).all(axis=1)]
            possible, score = compared.test(later, later - back)
            found.append((later[possible], later[possible] - back, score[possible]))
        held = [r[-forest.near :] for r in rows]
        row, other, score = map(np.concatenate, zip(*found))
        order = np.lexsort((-score, row))
        row, other, score = row[order], other[order], score[order]
        best = np.arange(len(row)) == np.searchsorted(row, row)
        row, other, score = row[best], other[best], score[best]
        if len(row):
            yield pa.RecordBatch.from_arrays([_ends(node, row), _ends(node, other), pa.array(score)], names=["a", "b", "score"])


def _path_width(forest: Forest) -> int:
    """Bytes of a row's place in a tree: its first values whole, the last byte of each deeper one."""
    return 3 * forest.least_depth + forest.depth


def _part(values: str, width: int) -> Column:
    """What `values`, a column of `width` bytes for each tree, has for the row's `tree`."""
    return F.substring(values, F.col("tree") * width + 1, F.lit(width))


def _trees(forest: Forest) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree")


def _paths(classes: DataFrame, forest: Forest) -> DataFrame:
    """A row for each tree, with its `tree, path` and the brief sketch, size and node of the class."""
    path = F.concat(_part("heads", 4 * forest.least_depth), _part("tails", forest.depth - forest.least_depth))
    brief = F.substring("sketch", 1, _BRIEF).alias("brief")
    return classes.select("heads", "tails", brief, "n", "node", _trees(forest)).select(
        "tree", path.alias("path"), "brief", "n", "node"
    )


def _near_pairs(classes: DataFrame, forest: Forest) -> DataFrame:
    """Distinct candidate pairs `(u, v, score)` of near rows in each sorted order."""
    rows = _paths(classes, forest)
    ordered = rows.repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")
    pairs = ordered.mapInArrow(lambda b: _neighbours(b, forest), "a binary, b binary, score long")
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), "score").groupBy("u", "v").agg(
        F.max("score").alias("score")
    )


def _group_pairs(
    sketches: np.ndarray, sizes: np.ndarray, node: np.ndarray, component: np.ndarray, side: np.ndarray, forest: Forest
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of different components that may be linked; `side` 0 and 1 meet each other only, 2 meet all.

    Nothing is compared within the largest component.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, side = sizes[order], side[order]
    _, of, counts = np.unique(component[order], axis=0, return_inverse=True, return_counts=True)
    of = of.ravel()
    probing = of != counts.argmax()
    compared = _Compared(sketches[order], sizes, forest)
    p, found = forest.percent, [(np.zeros(0, np.int64),) * 2]
    for i in np.flatnonzero(probing).tolist():
        # Smaller probes have met this one already.
        first = int(np.searchsorted(sizes, -(-p * sizes[i] // 100)))
        last = int(np.searchsorted(sizes, 100 * sizes[i] // p, "right"))
        others = np.arange(first, last)
        others = others[(of[others] != of[i]) & ((others > i) | ~probing[others]) & ((side[others] != side[i]) | (side[i] == 2))]
        if len(others):
            possible, _ = compared.test(i, others)
            others = others[possible]
            found.append((np.full(len(others), i), others))
    a, b = map(np.concatenate, zip(*found))
    return order[a], order[b]


def _regional(batches: Iterator[pa.RecordBatch], forest: Forest) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of the groups of `(at, sketch, n, node, component, side)`, whose rows come together."""
    held: pa.Table | None = None

    def pairs(group: pa.Table) -> pa.RecordBatch:
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in group.columns]
        node = _fixed(columns[3], 16)
        a, b = _group_pairs(
            _fixed(columns[1], _SKETCH), columns[2].to_numpy(zero_copy_only=False), node, _fixed(columns[4], 16),
            columns[5].to_numpy(zero_copy_only=False), forest,
        )
        return pa.RecordBatch.from_arrays([_ends(node, a), _ends(node, b)], names=["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        at = table.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist()]
        for start, end in zip(cuts, cuts[1:]):
            yield pairs(table.slice(start, end - start).combine_chunks())
        held = table.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield pairs(held.combine_chunks())


def _regions(classes: DataFrame, forest: Forest, *columns: str) -> DataFrame:
    """A row for each tree, with its `region` and the `columns` of the class."""
    prefix = _part("heads", 4 * forest.least_depth)
    return classes.select("heads", *columns, _trees(forest)).select(F.xxhash64("tree", prefix).alias("region"), *columns)


def _region_pairs(classes: DataFrame, components_of: DataFrame, forest: Forest) -> DataFrame:
    """Distinct candidate pairs `(u, v)` of different components that share a region.

    `components_of` are the `classes` with their `component`.

    A region is all rows of a tree that share its `least_depth` first values. Its rows are divided into
    blocks by their node, and every two blocks meet in a group of their own.
    """
    found = _regions(components_of, forest, "component").groupBy("region").agg(
        F.count("*").alias("rows"), F.min("component").alias("a"), F.max("component").alias("b")
    )
    blocks = F.ceil(F.col("rows") / forest.block).cast("int").alias("blocks")
    several = materialize(found.filter("a <> b").select("region", blocks), "regions")
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    placed = _regions(classes, forest, "node").join(several, "region").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    grouped = placed.select(
        F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("at"), "node", side.alias("side")
    )
    whole = grouped.join(components_of.select("node", "sketch", "n", "component"), "node").select(
        "at", "sketch", "n", "node", "component", "side"
    )
    ordered = whole.repartition("at").sortWithinPartitions("at")
    pairs = ordered.mapInArrow(lambda b: _regional(b, forest), "a binary, b binary")
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs `(u, v, set of u, set of v)` that are similar enough."""
    for batch in batches:
        kept = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            # The smaller set inside the larger bounds the similarity.
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                kept.append(False)
                continue
            shared = len(np.intersect1d(a, b, assume_unique=True))
            kept.append(100 * shared >= percent * (len(a) + len(b) - shared))
        chosen = batch.filter(pa.array(kept, pa.bool_()))
        yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], names=["u", "v"])


def _full_sets(texts: DataFrame, wanted: DataFrame, forest: Forest) -> DataFrame:
    """The full sets `(node, shingles)` of the `wanted(node, key, text_id)` classes, from `texts(key, text)`.

    Texts that are not wanted are left where they lie; the few that a full table of bits lets pass go by their node.
    """
    at = F.xxhash64("key", "text_id").alias("at")
    bits, mask = _wanted_bits(wanted.select(at))
    rows = texts.withColumn("text_id", text_digest(F.col("text"))).select(at, "text")
    sets = rows.mapInArrow(lambda b: _sets(b, forest.words, bits, mask), "node binary, shingles binary")
    once = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
    return materialize(once.join(wanted.select("node"), "node", "left_semi"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    joined = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return joined.mapInArrow(lambda b: _linked(b, forest.percent), "u binary, v binary")


def _best(pairs: DataFrame, n: int) -> DataFrame:
    """Pairs that are among the `n` best of either end."""
    ends = pairs.select("u", "v", "score", F.explode(F.array("u", "v")).alias("end"))
    rank = F.row_number().over(Window.partitionBy("end").orderBy(F.desc("score"), "u", "v"))
    return ends.withColumn("rank", rank).filter(F.col("rank") <= n).select("u", "v").distinct()


def duplicate_classes(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, n_shingles, component_id, kept, text_id)` of each row; the component's smallest key names it."""
    columns = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = columns.schema["key"].dataType.simpleString()
    ddl = f"key {kind}, n_shingles long, node binary, text_id binary, heads binary, tails binary, sketch binary"
    names = [part.split()[0] for part in ddl.split(", ")]
    signed = materialize(columns.mapInArrow(lambda b: _signed(b, forest, names), ddl), "signed")

    first: Column = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_id"))
    classes = materialize(
        signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
            first.alias("first"), *[F.first(c).alias(c) for c in ("heads", "tails", "sketch", "n_shingles")]
        ).select("node", "first.key", "first.text_id", "heads", "tails", "sketch", F.col("n_shingles").alias("n")),
        "classes",
    )
    pairs = materialize(_near_pairs(classes, forest), "pairs")
    named_by = classes.select("node", "key", "text_id")
    near = materialize(
        pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(named_by, "node"), "near"
    )
    # Only the texts of classes that have a candidate are worked on again for their full sets.
    sets = _full_sets(columns, near, forest)
    tested = materialize(_best(pairs, forest.best), "tested")
    discard(pairs)
    links = materialize(_confirmed(tested, sets, forest), "confirmed")
    found = materialize(components(links), "components")

    placed = classes.join(found, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
    rest = materialize(_region_pairs(classes, placed, forest).join(tested, ["u", "v"], "left_anti"), "rest")
    more_nodes = rest.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(near, "node", "left_anti")
    more_near = materialize(named_by.join(more_nodes, "node", "left_semi"), "near")
    more_sets = _full_sets(columns, more_near, forest)
    more = _confirmed(rest, sets.unionByName(more_sets), forest)
    stars = found.select(F.col("node").alias("u"), F.col("root").alias("v"))
    found = materialize(components(stars.unionByName(more)), "components")
    for stored in (sets, more_sets, near, more_near, tested, rest):
        discard(stored)

    by_root = found.join(classes.select("node", "key"), "node")
    least = by_root.groupBy("root").agg(F.min("key").alias("least"))
    names_of = by_root.join(least, "root").select("node", "least")
    # Stored, so that the join has a plain shuffle on both sides and can split the rows of many copies.
    named = materialize(
        classes.select("node", "key").join(names_of, "node", "left").select(
            "node", F.coalesce("least", "key").alias("component_id")
        ),
        "names",
    )
    discard(classes)
    result = signed.select("key", "n_shingles", "node", "text_id").join(named, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    )
    return result.select(
        F.col("key").alias(key), "n_shingles", "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"), "text_id",
    )
