from collections import Counter

from pyspark.sql import functions as F

from docquery.llm import shards


def placed(spark, rows, n=7, **more):
    table = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot string")
    out = shards.shuffled_shards(table, n, **more)
    return [(r["record"]["doc_id"], r["record"]["text"], r["record"]["shard"], r["size"], r["shard"], r["slot"]) for r in out.collect()]


def check(rows, n):
    counts = Counter(r[4] for r in rows)
    assert set(counts) <= set(range(n))
    full = [counts.get(s, 0) for s in range(n)]
    assert max(full) - min(full) <= 1
    for s in range(n):
        assert sorted(r[5] for r in rows if r[4] == s) == list(range(full[s]))


def test_rows_law_over_many_buckets(spark):
    rows = [(i, "x" * (i % 50), "kept", None) for i in range(1000)]
    got = placed(spark, rows, bucket_bytes=4000)
    check(got, 7)
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted((i, t, k) for i, t, k, _ in rows)
    order = [r[0] for r in sorted(got, key=lambda r: (r[4], r[5]))]
    assert order != sorted(order)
    assert abs(sum(i * x for i, x in enumerate(order)) / sum(i * i for i in range(1000)) - 0.75) < 0.03
    again = placed(spark, rows, bucket_bytes=4000)
    assert sorted(again) == sorted(got)


def test_repeated_null_and_long_rows(spark):
    rows = [(5, "same", None, None)] * 300 + [(None, None, None, None)] * 20 + [(6, "é" * 50_000, None, None), (7, "", None, None)]
    got = placed(spark, rows, bucket_bytes=2000)
    check(got, 7)
    assert Counter((r[0], r[3]) for r in got) == Counter({(5, 20): 300, (None, 16): 20, (6, 100_016): 1, (7, 16): 1})


def test_fewer_rows_than_shards_and_none(spark):
    check(placed(spark, [(1, "a", None, None), (2, "b", None, None)]), 7)
    assert placed(spark, []) == []


def test_no_python_on_the_main_path(spark):
    plan = shards.shuffled_shards(spark.range(10).select("id", F.lit("a").alias("text")), 3)
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
