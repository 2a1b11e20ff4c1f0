import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docquery.llm import prefixtrie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(conversations):
    """Brute force: the rows of every prefix of `{id: [(role, text), …]}`."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    rows = []
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [sums[p] for p in children[path]]
        sums[path] = sum(x[0] for x in below) or 1, own + sum(x[1] for x in below)
        ends = ",".join(map(str, sorted(c for c in members[path] if len(conversations[c]) == len(path))))
        rows.append((
            min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]),
            len(children[path]), *sums[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def collected(frame):
    assert frame.columns == COLUMNS
    assert [f.dataType.simpleString() for f in frame.schema] == ["bigint"] * 7 + ["string"]
    return sorted(map(tuple, frame.collect()), key=str)


def some_conversations(seed, n=400, texts=4, deepest=7):
    rng = random.Random(seed)
    said = ["", "é", "abc", "abcd efg"][:texts]
    made = {}
    for c in rng.sample(range(-50, 5 * n), n):
        made[c] = [(rng.choice(["user", "assistant"]), rng.choice(said)) for _ in range(rng.randint(0, deepest))]
    hot = [("user", "abc")] * 4
    for c in list(made)[: n // 3]:
        made[c] = list(hot)
    return made


def paths_of(spark, conversations):
    rows = [(c, i, *t) for c, turns in conversations.items() for i, t in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    paths = prefixtrie.turn_paths(turns)
    return ids.join(paths, "conv_id", "left").select(
        "conv_id", F.coalesce("turns", F.array().cast(paths.schema["turns"].dataType)).alias("turns")
    )


@pytest.mark.parametrize("seed,cells,ranges", [(0, 1 << 20, 1), (1, 16, 7), (2, 1, 23), (3, 60, 211), (4, 400, 3)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, cells, ranges):
    """Whole in one block, and cut into many: blocks of one row, and ranges without rows."""
    monkeypatch.setattr(prefixtrie, "BLOCK_CELLS", cells)
    monkeypatch.setattr(prefixtrie, "MOST_BROADCAST", 10 if seed == 1 else 200_000)
    conversations = some_conversations(seed, texts=2 + seed % 3)
    paths = paths_of(spark, conversations)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert collected(prefixtrie.prefix_trie(paths)) == nodes_of(conversations)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_block_takes_rows_in_any_order():
    rng = random.Random(5)
    paths = [b"".join(bytes([rng.randint(0, 2)]) * 16 for _ in range(rng.randint(0, 5))) for _ in range(60)]
    sizes = [np.arange(len(p) // 16) for p in paths]
    keys = np.arange(60)
    mixed = rng.sample(range(60), 60)
    one = prefixtrie.block_nodes(keys, paths, sizes)
    two = prefixtrie.block_nodes(keys[mixed], [paths[i] for i in mixed], [sizes[i] for i in mixed])
    assert one[0].equals(two[0]) and one[1:] == two[1:]


def test_long_conversation(spark):
    conversations = {1: [("user", str(i)) for i in range(3000)], 2: [("user", str(i)) for i in range(2000)], 3: []}
    assert collected(prefixtrie.prefix_trie(paths_of(spark, conversations))) == nodes_of(conversations)


def test_nobody_says_anything(spark):
    assert collected(prefixtrie.prefix_trie(paths_of(spark, {4: [], 7: []}))) == nodes_of({4: [], 7: []})
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixtrie.prefix_trie(prefixtrie.turn_paths(empty)).count() == 0


def test_odd_rows(spark):
    """Null turns first, null roles and texts empty, null ids left out, repeated rows kept, other columns ignored."""
    rows = [
        (1, 2, "b", "x"), (1, None, "a", None), (1, 0, None, "y"), (1, 0, None, "y"), (None, 0, "a", "z"), (2, 1, "a", ""),
    ]
    turns = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    wanted = {1: [("a", ""), ("", "y"), ("", "y"), ("b", "x")], 2: [("a", "")]}
    assert collected(prefixtrie.prefix_trie(prefixtrie.turn_paths(turns))) == nodes_of(wanted)


def rebuilt(conversations):
    made = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = conversations.get(c - c % 5, [])[:h] + turns[h:]
    return made


def test_query_equals_brute_force(spark, data):
    conversations = defaultdict(list)
    for c, _, role, text in sorted(spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()):
        conversations[c].append((role or "", text or ""))
    assert collected(queries.op13_prefix_trie(spark, data)) == nodes_of(rebuilt(conversations))


def test_rebuilding_without_a_base(spark, tmp_path):
    """Conversation 6 has no conversation 5 to begin like; some lose all of their turns."""
    conversations = {c: [("user", f"{c} {i}") for i in range(c % 4 + 1)] for c in (6, 7, 8, 10, 11, 13, 21, 22, 23, 24)}
    rows = [(c, i, *t) for c, turns in conversations.items() for i, t in enumerate(turns)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    wanted = rebuilt(conversations)
    assert [] in wanted.values()
    assert collected(queries.op13_prefix_trie(spark, str(tmp_path))) == nodes_of(wanted)


def test_rows_have_the_declared_columns():
    batch = prefixtrie.block_nodes(np.array([1]), [b""], [np.zeros(0, np.int64)])[0]
    assert [f.name for f in batch.schema] == list(prefixtrie._COLUMNS) and isinstance(batch, pa.RecordBatch)
