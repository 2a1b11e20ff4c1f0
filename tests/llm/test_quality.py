import math
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from docquery.llm import quality


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels, quality.fit_quality(docs, labels)


def test_held_out_documents(fitted):
    docs, labels, model = fitted
    scored = quality.score_quality(docs, model).join(labels, "doc_id").select("doc_id", "score", "quality").collect()
    held = [r for r in scored if crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 80
    assert sum((r["score"] >= 0.5) == bool(r["quality"]) for r in held) / len(held) > 0.97


def test_score_is_the_sum_of_the_rules_that_hold(fitted):
    docs, _, model = fitted
    assert model.rules and all(r.terms for r, _ in model.rules)
    rows = quality.score_quality(docs, model).select("score", quality.statistics(F.col("text")).alias("s")).collect()
    for row in rows:
        z = model.intercept
        for rule, weight in model.rules:
            if all(row["s"][n] <= b if at_most else row["s"][n] > b for n, at_most, b in rule.terms):
                z += weight
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_statistics_of_a_text(spark):
    text = "Ab  cd!\nAb | 12.\n\nAb | 12."
    row = spark.range(1).select(quality.statistics(F.lit(text)).alias("s")).head()["s"]
    words, lines = ["Ab", "cd!", "Ab", "|", "12.", "Ab", "|", "12."], ["Ab  cd!", "Ab | 12.", "Ab | 12."]
    assert row["log_words"] == pytest.approx(math.log1p(8)) and row["distinct_word_share"] == 4 / 8
    assert row["distinct_line_share"] == 2 / 3 and row["words_per_line"] == len(words) / len(lines)
    assert row["bars_per_word"] == 2 / 8 and row["marks_per_word"] == 1 / 8 and row["stops_per_word"] == 2 / 8
    assert row["upper_share"] == 3 / len(text) and row["digit_share"] == 4 / len(text) and row["symbols_per_word"] == 0


def test_odd_rows_and_missing_labels(spark, fitted):
    _, labels, model = fitted
    rows = [(1, None, "a"), (2, "", "b"), (3, "x " * 200_000, "c"), (3, "x " * 200_000, "c"), (None, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = quality.score_quality(docs, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[1] == by_id[2]
    none = quality.fit_quality(docs, labels.limit(0))
    assert all(r["score"] > 0.99 for r in quality.score_quality(docs, none).collect())
    assert quality.score_quality(docs.limit(0), model).count() == 0
