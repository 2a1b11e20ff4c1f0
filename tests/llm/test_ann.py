import numpy as np
import pytest

from docquery.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def searched(spark, rows, k=10):
    table = spark.createDataFrame([(i, v, 0, "clash") for i, v in rows], SCHEMA)
    found = {}
    for r in ann.nearest_neighbours(table, lambda i: i % 10 == 0, k).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for rows_of in found.values():
        assert sorted(r for r, _, _ in rows_of) == list(range(1, len(rows_of) + 1))
    return {q: [(i, s) for _, i, s in sorted(rows_of)] for q, rows_of in found.items()}


def brute(rows, k=10):
    table = dict(rows)
    out = {}
    for q in (i for i in table if i % 10 == 0):
        apart = {i: float(ann.exact_distances(np.float32(table[q]), np.float32([v]))[0]) for i, v in table.items() if i != q}
        out[q] = sorted(apart.items(), key=lambda x: (x[1], x[0]))[:k]
    return out


def test_recall_and_exact_scores(spark):
    random = np.random.default_rng(0)
    rows = [(i, v.tolist()) for i, v in enumerate(random.normal(size=(3000, 24)).astype(np.float32))]
    got, want = searched(spark, rows), brute(rows)
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    table = dict(rows)
    for q, found in got.items():
        for i, score in found:
            assert score == ann.exact_distances(np.float32(table[q]), np.float32([table[i]]))[0]


def test_ties_go_to_the_smaller_id(spark):
    random = np.random.default_rng(1)
    same = random.normal(size=16).astype(np.float32).tolist()
    rows = [(i, same) for i in range(1, 700)] + [(1000 + i, v.tolist()) for i, v in enumerate(random.normal(size=(900, 16)))]
    got = searched(spark, [(0, same), *rows])
    assert got[0] == [(i, 0.0) for i in range(1, 11)]
    assert got[500] == [(i, 0.0) for i in range(0, 10)]


def test_what_takes_no_part(spark):
    good = [(i, [float(i), 1.0, 2.0]) for i in range(8)]
    odd = [
        (10, None), (20, [0.0, 0.0, 0.0]), (30, [1.0, None, 2.0]), (40, [1.0, float("nan"), 2.0]),
        (50, [float("inf"), 1.0, 2.0]), (60, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]),
    ]
    got = searched(spark, good + odd + good)
    assert set(got) == {0} and [i for i, _ in got[0]] == [1, 2, 3, 4, 5, 6, 7]
    assert got[0] == brute(good)[0]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0])]])
def test_too_few(spark, rows):
    assert searched(spark, rows) == {}
