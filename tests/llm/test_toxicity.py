import random

from docquery.llm import toxicity

SCHEMA = "doc_id long, text string, score string, predicted string"


def corpus(n=400):
    rng = random.Random(5)
    parts = ["ba", "lo", "ti", "men", "ra", "su", "ki", "tor", "en", "ly"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 80))]
        if i % 4 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vileword", "grossinsult", "Nastything,"])
        rows.append((i, " ".join(words), None, None))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    from zlib import crc32

    held = [(i, y) for i, y in labels if crc32(str(i).encode()) % 5 == 0]
    right = [got[i]["predicted"] == y for i, y in held]
    assert len(held) > 50 and sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_labels_of_the_held_out_fold_change_nothing(spark):
    from zlib import crc32

    rows, labels = corpus(120)
    docs = spark.createDataFrame(rows, SCHEMA)
    other = [(i, 1 - y if crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    fits = [toxicity.fit_toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, other)]
    assert fits[0] == fits[1]


def test_odd_rows_and_missing_labels(spark):
    rows, labels = corpus(120)
    odd = [(900, None, None, None), (901, "", None, None), (902, "ba lo " * 100_000, None, None)] + [(903, "x", None, None)] * 2
    odd += [(None, "y", None, None)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    strange = [(None, 1), (900, None), (1, 5)]
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels + strange, "doc_id long, toxic int"))
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == len(rows) + 6
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[900] == by_id[901] and 0 <= by_id[901] <= 1 and by_id[902] < 0.5
    none = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
