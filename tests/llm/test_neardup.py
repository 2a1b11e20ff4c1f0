import random

import numpy as np
import pytest

from docquery.llm import neardup
from docquery.llm.components import components

SCHEMA = "doc_id long, text string, node string, kept string"


def brute(rows, width, percent):
    """`key -> (size of the set, smallest key reachable)` by comparing all pairs."""
    sets = {}
    for key, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        runs = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] or [tuple(words)] * bool(words)
        sets[key] = set(runs)
    root = {key: key for key in sets}

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: (len(sets[key]), find(key)) for key in sets}


def found(spark, rows, width):
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    return neardup.duplicate_classes(table, neardup.Forest(words=width)).collect()


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 8, 40, 120]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(w.upper() if rng.random() < 0.1 else w for w in copy)))
    return rows


@pytest.mark.parametrize("width, seed", [(2, 1), (5, 2)])
def test_classes_equal_all_pairs(spark, width, seed):
    rows = corpus(seed)
    want = brute(rows, width, 80)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found(spark, rows, width)}
    assert got == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found(spark, rows[:20], width))


def test_dense_group_and_many_copies(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 600):
        copy = list(base)
        for _ in range(rng.randint(1, 12)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    assert {r["doc_id"]: r["component_id"] for r in found(spark, rows, 2)} == {k: c for k, (_, c) in brute(rows, 2, 80).items()}


def test_nulls_empty_long_and_repeats(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long + " end"), (6, "one"), (7, "ONE"), (7, "ONE"), (None, "one"), (None, "alone here now")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found(spark, rows, 2)), key=str)
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 49_999, 4, True), (5, 50_000, 4, False), (6, 1, 6, True),
        (7, 1, 6, False), (7, 1, 6, False), (None, 1, 6, False), (None, 2, None, True),
    ], key=str)
    assert found(spark, [], 2) == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(500, i) for i in range(501, 600)] + [(7, 7), (900, 899), (900, 899)]
    table = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["root"] for r in components(table).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 500 for i in range(500, 600)} | {899: 899, 900: 899}
    assert components(table.limit(0)).count() == 0
    nulls = table.unionByName(spark.createDataFrame([(None, 3), (4, None), (None, None)], "u long, v long"))
    assert {r["node"]: r["root"] for r in components(nulls).collect()} == got


def template_pages(n, shared, own, pairs, more):
    """`n` sets of `shared` common and `own` other words; the first `pairs` twos have `more` of these in common."""
    template = [f"t{i}" for i in range(shared)]
    texts = []
    for i in range(n):
        words = [f"w{i}x{j}" for j in range(own)]
        if i < 2 * pairs:
            words[:more] = [f"p{i // 2}x{j}" for j in range(more)]
        texts.append((i, " ".join(template + words)))
    return texts


def test_links_beyond_the_window_of_a_dense_region(spark):
    # Mutual similarity 170/230, in pairs 178/222, and more rows in a region than a window has.
    rows = template_pages(240, 170, 30, 40, 8)
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = neardup.duplicate_classes(table, neardup.Forest(words=1, near=1, block=64)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 if i < 80 else i for i in range(240)}


def test_every_candidate_of_a_region_is_tested(spark):
    # Many neighbours just below the limit, 176/224, rank before the links, 178/222.
    rows = template_pages(120, 176, 24, 40, 2)
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = neardup.duplicate_classes(table, neardup.Forest(words=1)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 if i < 80 else i for i in range(120)}


def test_parities_lose_no_link():
    """Sets that are linked always pass the test, whatever their size; most that are far from it do not."""
    rng = np.random.default_rng(3)
    forest = neardup.Forest()
    multipliers = neardup._multipliers(forest.trees * forest.depth)
    passed = {True: 0, False: 0}
    seen = {True: 0, False: 0}
    for _ in range(1500):
        n = int(rng.choice([1, 5, 30, 150, 500, 590, 700, 760, 900, 3000]))
        common, most = rng.integers(0, 1 << 63, n, dtype=np.uint64), int(rng.choice([1, 5]))
        own = [rng.integers(0, 1 << 63, int(rng.integers(0, max(2, n // most))), dtype=np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([common, x])) for x in own]
        shared = len(np.intersect1d(*sets))
        similarity = shared / (len(sets[0]) + len(sets[1]) - shared)
        sketches = np.stack([
            np.frombuffer(neardup.sketch(x, neardup.signature(x, multipliers), forest), np.uint8) for x in sets
        ])
        compared = neardup._Compared(sketches, np.array([len(x) for x in sets]), forest)
        possible, _ = compared.test(np.array([0]), np.array([1]))
        linked = 100 * shared >= 80 * (len(sets[0]) + len(sets[1]) - shared)
        if linked or similarity < 0.55:
            seen[linked] += 1
            passed[linked] += bool(possible[0])
    assert seen[True] > 300 and passed[True] == seen[True]
    assert seen[False] > 100 and passed[False] < 0.1 * seen[False]


def test_crowded_region_of_thousands(spark):
    """Template pages, most of them linked with nothing: every planted link is found, in one block and in many."""
    rows = template_pages(2400, 150, 27, 500, 9)
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    for block in (4096, 700):
        got = neardup.duplicate_classes(table, neardup.Forest(words=1, block=block)).collect()
        wrong = {r["doc_id"]: r["component_id"] for r in got if r["component_id"] != (r["doc_id"] - r["doc_id"] % 2 if r["doc_id"] < 1000 else r["doc_id"])}
        assert wrong == {}


def plan_nodes(plan):
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.initialPlan()
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from plan_nodes(children.apply(i))


def test_texts_and_whole_sketches_are_not_shuffled_for_trees(spark, monkeypatch):
    """Only sets that are wanted leave their place, and a row of a tree stays small."""
    stored, written = neardup.materialize, {}

    def keep(df, label):
        exchanges = [x for x in plan_nodes(df._jdf.queryExecution().executedPlan()) if x.nodeName() == "Exchange"]
        outputs = [[x.output().apply(i).name() for i in range(x.output().size())] for x in exchanges]
        written.setdefault(label, []).extend(outputs)
        return stored(df, label)

    monkeypatch.setattr(neardup, "materialize", keep)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = corpus(4, 20)
    try:
        assert neardup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), neardup.Forest(words=2)).count() == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert written["sets"] and written["pairs"] and written["near"]
    assert not any("text" in columns for columns in written["sets"])
    assert not any("sketch" in columns for label in ("pairs", "near", "regions") for columns in written[label])


def test_texts_that_are_not_wanted_give_no_sets(spark):
    texts = spark.createDataFrame([(i, f"text number {i} of many") for i in range(300)] + [(7, "text number 7 of many"), (None, "no key"), (300, None)], "key long, text string")
    wanted = texts.filter("key = 7 or key is null").distinct().withColumn("text_id", neardup.text_digest(texts["text"]))
    node = {k: neardup._digest(neardup.shingle_set(t, 2).tobytes()) for k, t in ((7, "text number 7 of many"), (None, "no key"))}
    by_node = spark.createDataFrame([(bytearray(n), k) for k, n in node.items()], "node binary, k long")
    wanted = wanted.join(by_node, wanted["key"].eqNullSafe(by_node["k"])).select("node", "key", "text_id")
    got = neardup._full_sets(texts, wanted, neardup.Forest(words=2)).collect()
    assert {bytes(r["node"]): bytes(r["shingles"]) for r in got} == {
        node[7]: neardup.shingle_set("text number 7 of many", 2).tobytes(), node[None]: neardup.shingle_set("no key", 2).tobytes()
    }
    assert len(got) == 2


def test_brief_sketches_lose_no_link_of_small_sets():
    rng = np.random.default_rng(5)
    forest = neardup.Forest()
    multipliers = neardup._multipliers(forest.trees * forest.depth)
    passed = {True: 0, False: 0}
    seen = {True: 0, False: 0}
    for _ in range(600):
        n = int(rng.choice([1, 5, 30, 150, 400, 600]))
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        own = [rng.integers(0, 1 << 63, int(rng.integers(0, max(2, n // rng.choice([1, 5])))), dtype=np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([common, x]))[: neardup.PARITY_MOST] for x in own]
        shared = len(np.intersect1d(*sets))
        similarity = shared / (len(sets[0]) + len(sets[1]) - shared)
        sketches = np.stack([np.frombuffer(neardup.sketch(x, neardup.signature(x, multipliers), forest), np.uint8) for x in sets])
        compared = neardup._Compared(sketches[:, : neardup._BRIEF], np.array([len(x) for x in sets]), forest)
        possible, _ = compared.test(np.array([0]), np.array([1]))
        linked = 100 * shared >= 80 * (len(sets[0]) + len(sets[1]) - shared)
        if linked or similarity < 0.5:
            seen[linked] += 1
            passed[linked] += bool(possible[0])
    assert seen[True] > 100 and passed[True] == seen[True]
    assert seen[False] > 40 and passed[False] < 0.2 * seen[False]
