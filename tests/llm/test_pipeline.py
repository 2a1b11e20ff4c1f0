"""The pipeline stage by stage against plain versions on a small table, and the registered queries."""
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from docquery.llm import linerules, packing, quality
from docquery.llm.oracles import SQL
from docquery.llm.queries import QUERIES, vocabulary
from docquery.plans.check import connect, duckdb_rows, spark_rows
from docquery.shared import materialize
from tests.llm.test_linerules import plain_measure
from tests.llm.test_neardup import brute


@pytest.fixture(scope="module")
def stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(materialize(stage(spark, made[-1], folder), "stage"))
    return made


def rows(table):
    return {r["doc_id"]: r for r in table.collect()}


def test_columns_and_subsets(stages):
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns
        assert set(rows(after)) <= set(rows(before)) and after.count() == after.select("doc_id").distinct().count()


def test_rejected_quality_goes(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.fit_quality(stages[0], labels)
    scores = quality.score_quality(stages[0], model).collect()
    assert set(rows(stages[1])) == {r["doc_id"] for r in scores if r["score"] >= 0.5}


def test_rules_by_plain_counts(stages):
    before, after = rows(stages[1]), rows(stages[2])
    by_line = defaultdict(set)
    for source, text in {(r["source"], r["text"]) for r in before.values()}:
        for line in text.split("\n"):
            if line.split():
                by_line[source, " ".join(line.split()).lower()].add(text)
    frequent = {k for k, v in by_line.items() if len(v) > linerules.LEAST_DOCUMENTS}
    want = {}
    for key, r in before.items():
        n_words, _, _, _, repeated = plain_measure(r["text"])
        kept = [x for x in r["text"].split("\n") if (r["source"], " ".join(x.split()).lower()) not in frequent]
        gone = n_words - len(" ".join(kept).split())
        if n_words >= 20 and 100 * repeated <= 30 * n_words and gone <= linerules.MOST_REMOVED * n_words:
            want[key] = "\n".join(kept)
    assert {k: r["text"] for k, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_one_of_each_group(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    want = {key for key, (_, least) in brute(before, 5, 80).items() if key == least}
    assert set(rows(stages[3])) == want


def test_packed_whole(stages):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    lengths = {r["doc_id"]: len(reference.encode(r["text"], add_special_tokens=False).ids) + 1 for r in stages[3].collect()}
    pieces = stages[4].collect()
    got, sequences = defaultdict(int), defaultdict(int)
    for r in pieces:
        got[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]] += r["length"]
    assert dict(got) == lengths and max(sequences.values()) <= packing.SEQUENCE
    assert len(sequences) <= -(-sum(lengths.values()) // packing.SEQUENCE) * 1.02 + 1


def test_run_equals_its_stages(spark, stages):
    ids = lambda t: sorted((r["doc_id"], r["piece"], r["length"]) for r in t.collect())
    assert ids(corpus_pipeline.run(spark, "/root/testdata/sf0.001")) == ids(stages[4])


def test_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, "/root/testdata/sf0.001"), "empty")
        assert docs.count() == 0


def test_odd_rows(spark):
    """Nulls, empty and long texts, equal rows and clashing column names, among documents that pass."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = materialize(corpus_pipeline.good_documents(spark, docs, folder), "good")
    good = max((r["text"] for r in kept.filter("lang = 'en'").collect()), key=len)
    long = " ".join(f"{word} {i}" for i, word in enumerate((good.replace("\n", " ") + " ").split() * 60))
    odd = [
        (10**9, None, "en", "x", 0), (10**9 + 1, "", "en", None, 0), (10**9 + 2, " \n\t", None, "x", None),
        (10**9 + 3, good + " and so on", "en", None, 7), (10**9 + 3, good + " and so on", "en", None, 7), (None, None, None, None, None),
        (10**9 + 4, long, "en", "x", 1),
    ]
    names = ["score", "kept", "n_words", "text_id", "ids", "length", "frequent", "digest", "node", "key", "__score_"]
    more = docs.limit(0).unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long"))
    table = docs.unionByName(more).withColumns({n: F.lit(n) for n in names})
    table = materialize(table, "odd")
    got = table
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        got = materialize(stage(spark, got, folder), f"odd-{i}")
        assert got.columns == table.columns
        assert got.filter(" or ".join(f"`{n}` <> '{n}' or `{n}` is null" for n in names)).count() == 0
        if i:
            assert got.filter("doc_id between 1000000000 and 1000000002 or doc_id is null").count() == 0
    # The equal rows differ from their original in a few words, so one of the three stays: the original.
    assert got.filter(F.col("text") == good + " and so on").count() == 0
    pieces = corpus_pipeline.packed_sequences(spark, got, folder)
    assert pieces.select("doc_id").distinct().count() == got.count()


def test_contract():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, data, name):
    assert spark_rows(QUERIES[name](spark, data)) == duckdb_rows(connect(data), SQL[name])


CONTRACT = {
    1: "query_id bigint, rank int, vec_id bigint, score double",
    2: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    4: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    5: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    6: "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    7: "doc_id bigint, held_out boolean, score double, predicted int",
    8: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    9: "doc_id bigint, held_out boolean, score double, predicted int",
    10: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    11: "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    12: "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    13: "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
}


@pytest.mark.parametrize("number", CONTRACT)
def test_columns_of_a_query(spark, data, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    out = QUERIES[name](spark, data)
    kinds = dict(out.dtypes)
    for column in CONTRACT[number].split(", "):
        label, kind = column.split()
        assert kinds[label] == kind, column
    if number not in (1, 6, 8, 12, 13):
        source = spark.read.parquet(f"{data}/documents.parquet")
        assert out.count() == source.count() == out.agg(F.count_distinct("doc_id")).head()[0]
