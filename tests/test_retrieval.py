from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions import vectors as stored_vectors
from docquery.functions.hits import HIT, context, prompt, top_score
from docquery.hooks import Hook, offline
from docquery.operators import search
from docquery.operators.correct import correction_loop, grade
from docquery.operators.rerank import _batch_sums, rerank_top_n, with_rerank_score, word_statistics
from docquery.operators.retrieve import candidates, retrieve
from docquery.plans.answering import answer_batch
from docquery.operators.search import vector_top_k
from docquery.settings import DEFAULTS
from docquery.shared import materialize
from docquery.sources import index

DIM = 16
SMALL = replace(DEFAULTS, embed_dim=DIM)


def vectors(spark, n, key, seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(-3, 4, size=(n, DIM)).astype(float)
    data[0] = data[min(1, n - 1)]
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(data)]
    return data, spark.createDataFrame(rows, f"{key} long, embedding array<float>")


@pytest.mark.parametrize("settings", [SMALL, replace(SMALL, broadcast_bytes=8 * DIM * 3)])
def test_top_k_equals_brute_force(spark, settings):
    corpus, c = vectors(spark, 300, "chunk_id", 1)
    asked, q = vectors(spark, 7, "question_id", 2)
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) > 0, np.linalg.norm(m, axis=1, keepdims=True), 1)
    scores = np.round(unit(asked) @ unit(corpus).T, 6)
    want = {
        (i, j, rank + 1)
        for i in range(7)
        for rank, j in enumerate(sorted(range(300), key=lambda j: (-scores[i, j], j))[:9])
    }
    got = vector_top_k(c.repartition(5), q, 9, settings).collect()
    assert {(r.question_id, r.chunk_id, r.cosine_rank) for r in got} == want


def test_top_k_among_copies(spark):
    """A third of all rows are copies that tie at the top, spread over many Arrow batches."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=DIM)
    rows = [(f"{i:05d}", list(map(float, base if i % 3 == 0 else rng.normal(size=DIM)))) for i in range(3000)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    corpus = spark.createDataFrame(rows, "chunk_id string, embedding array<float>").repartition(3)
    asked = spark.createDataFrame([(1, list(map(float, base)))], "question_id int, embedding array<float>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = vector_top_k(corpus, asked, 5, SMALL).orderBy("cosine_rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.chunk_id for r in got] == ["00000", "00003", "00006", "00009", "00012"]


def test_many_blocks_leave_the_corpus_where_it_is(spark, monkeypatch):
    """40 queries in 14 blocks: no pass shuffles the corpus, and each query is embedded once."""
    corpus, c = vectors(spark, 500, "chunk_id", 3)
    asked, q = vectors(spark, 40, "question_id", 4)
    embedded = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<float>")
    def embed(v: pd.Series) -> pd.Series:
        embedded.add(len(v))
        return v

    plans = []
    real = search._stream_past

    def watched(*args):
        passed = real(*args)
        plans.append(passed._jdf.queryExecution().executedPlan().toString())
        return passed

    monkeypatch.setattr(search, "_stream_past", watched)
    stored = materialize(c.repartition(6), "corpus")
    vectors_ = q.repartition(5).select("question_id", embed("embedding").alias("embedding"))
    got = vector_top_k(stored, vectors_, 4, replace(SMALL, broadcast_bytes=8 * DIM * 3)).collect()
    one = vector_top_k(stored, q, 4, SMALL).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in one} and len(got) == 160
    assert len(plans) >= 15 and not any("Exchange" in p for p in plans)
    assert embedded.value == 40


def test_top_k_edges(spark):
    _, c = vectors(spark, 3, "chunk_id", 1)
    _, q = vectors(spark, 2, "question_id", 2)
    assert vector_top_k(c, q, 10, SMALL).count() == 6
    assert vector_top_k(c, q.limit(0), 10, SMALL).count() == 0
    assert vector_top_k(c.filter("chunk_id < 0"), q, 10, SMALL).count() == 0


def test_embedder_keeps_order_and_length(spark):
    texts = spark.createDataFrame([(0, "a b a"), (1, ""), (2, None), (3, "b")], "i int, t string")
    got = {r.i: r.v for r in texts.select("i", offline(DIM).embedder(F.col("t")).alias("v")).collect()}
    assert all(len(v) == DIM for v in got.values())
    assert sum(x * x for x in got[0]) == pytest.approx(1) and not any(got[1]) and not any(got[2])
    assert max(got[3]) == 1.0


def pairs(spark, rows):
    return spark.createDataFrame(rows, "question_id int, child string, score double, cosine_rank int, given double")


@pytest.mark.parametrize("n, want", [(5, ["c", "b", "a"]), (2, ["c", "b"])])
def test_rerank(spark, n, want):
    frame = pairs(spark, [(1, "a", 0.9, 1, 0.1), (1, "b", 0.8, 2, 0.2), (1, "c", 0.7, 3, 0.9)])
    ranked = rerank_top_n(frame.withColumn("rerank_score", F.col("given")), n).orderBy("final_rank").collect()
    assert [r.child for r in ranked] == want and ranked[0].score == 0.7
    assert rerank_top_n(frame.filter("false").withColumn("rerank_score", F.col("given")), n).count() == 0


def test_rerank_is_stable_and_squashed(spark):
    frame = pairs(spark, [(1, "a", 0.9, 1, 0.0), (1, "b", 0.8, 2, 0.0)]).withColumn("query", F.lit("q"))
    scored = with_rerank_score(frame, Hook(lambda q, c: F.lit(0.0), costly=False))
    got = rerank_top_n(scored, 2).orderBy("final_rank").collect()
    assert [r.child for r in got] == ["a", "b"] and got[0].rerank_score == 0.5


def with_hits(spark, rows):
    return spark.createDataFrame(rows, f"question_id int, question string, hits array<{HIT}>")


def hit(text="body", score=0.5, source="x", parent="", title="", rerank=None):
    return (None, text, score, source, parent, title, rerank)


def test_context(spark):
    two = [hit("t1", 0.9, "a.md", "p1", "S"), hit("t2", 0.512, "b.md"), hit("t3", 0.1, "c.md", "p1")]
    row = with_hits(spark, [(1, "q", two), (2, "q", [])]).select(
        context(F.col("hits")).alias("c"), prompt(F.col("question"), F.col("hits")).alias("p")
    ).collect()
    assert row[0].c == "[source: a.md | section: S | score: 0.900]\np1\n\n---\n\n[source: b.md | score: 0.512]\nt2"
    assert row[1].c == "" and row[1].p == "Context:\n(no documents retrieved)\n\nQuestion: q"


def test_context_rounds_half_to_even(spark):
    rows = with_hits(spark, [(1, "q", [hit("t", 0.0625)]), (2, "q", [hit("t", 0.1875)])])
    got = [r[0] for r in rows.select(context(F.col("hits"))).collect()]
    assert [g.split("score: ")[1][:5] for g in got] == ["0.062", "0.188"]


def test_grade_and_its_gate(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf(T.BooleanType())
    def judge(question: pd.Series, text: pd.Series) -> pd.Series:
        calls.add(len(question))
        return question == "yes"

    rows = with_hits(spark, [
        (1, "yes", []), (2, "no", [hit(rerank=0.7)]), (3, "yes", [hit(rerank=0.5)]),
        (4, "no", [hit(rerank=0.5)]), (5, "no", [hit(score=0.7)]), (6, "no", [hit(score=0.9, rerank=0.1)]),
    ])
    got = {r.question_id: r for r in grade(rows, Hook(judge)).collect()}
    assert [got[i].grade.relevant for i in range(1, 7)] == [False, True, True, False, True, False]
    assert [got[i].grade.used_llm for i in range(1, 7)] == [False, False, True, True, False, True]
    assert got[1].grade.reason == "no documents retrieved"
    assert got[2].grade.reason == "top score 0.700 >= 0.6 (pre-gate)"
    assert got[3].grade.reason == "top score 0.500 below gate; LLM judge said yes"
    assert calls.value == 3


def test_top_score(spark):
    rows = with_hits(spark, [(1, "", []), (2, "", [hit(score=0.4)]), (3, "", [hit(score=0.4, rerank=0.2)])])
    assert [r[0] for r in rows.select(top_score(F.col("hits"))).collect()] == [0.0, 0.4, 0.2]


def test_correction_loop(spark):
    def find(rows):
        strong = F.col("query").isin("good", "better query")
        found = F.array(F.struct(
            F.lit("id").alias("chunk_id"), F.col("query").alias("text"), F.when(strong, 0.9).otherwise(0.1).alias("score"),
            F.lit("s").alias("source"), F.lit("").alias("parent"), F.lit("").alias("title"),
            F.lit(None).cast("double").alias("rerank_score")))
        return rows.withColumn("hits", found.cast(f"array<{HIT}>"))

    no = Hook(lambda q, c: F.lit(False), costly=False)
    rewrite = Hook(lambda q, h: F.when(q == "fixable", "better query").otherwise(F.concat(F.lit("rewritten "), q)), costly=False)
    asked = spark.createDataFrame([(1, "good"), (2, "fixable"), (3, "hopeless")], "question_id int, question string")
    for retries in (0, 1, 3):
        got = {r.question_id: r for r in correction_loop(
            asked, find, no, rewrite, replace(DEFAULTS, max_rewrites=retries)).collect()}
        assert len(got) == 3
        trace = {i: (r.correction.attempts, r.correction.graded_relevant, r.correction.rewritten_query) for i, r in got.items()}
        assert trace[1] == (1, True, None)
        if retries:
            assert trace[2] == (2, True, "better query") and got[2].hits[0].text == "better query"
            assert trace[3] == (retries + 1, False, "rewritten hopeless")
        else:
            assert trace[2] == (1, False, None)


def test_index_and_retrieve(spark, tmp_path):
    hooks = offline(DIM)
    docs = spark.createDataFrame(
        [("a.md", "# Leave\nparental leave is long\n# Travel\nbook early"), ("b.txt", "cats and dogs"), ("c.txt", "  ")],
        "source string, text string")
    path = str(tmp_path / "ix")
    index.write_index(docs, path, hooks.embedder, SMALL, recreate=True, run="0")
    ix = index.read_index(spark, path, SMALL)
    assert ix.chunks.count() == 3 and ix.sections.count() == 2
    asked = spark.createDataFrame([(1, "parental leave"), (2, "cats")], "question_id int, query string")
    got = {r.question_id: r.hits for r in retrieve(asked, ix, hooks, SMALL).collect()}
    assert got[1][0].title == "Leave" and got[1][0].parent == "# Leave\nparental leave is long"
    assert got[2][0].source == "b.txt" and got[2][0].parent == "cats and dogs"
    plain = retrieve(asked, ix, hooks, replace(SMALL, rerank_enabled=False, top_k=1)).collect()
    assert all(len(r.hits) == 1 and r.hits[0].rerank_score is None for r in plain)

    index.write_index(docs, path, hooks.embedder, SMALL, run="1")
    index.write_index(docs, path, hooks.embedder, SMALL, run="1")
    twice = index.read_index(spark, path, SMALL)
    assert twice.chunks.count() == 6 and twice.chunks.select("chunk_id").distinct().count() == 6
    again = {r.question_id: r.hits for r in retrieve(asked, twice, hooks, SMALL).collect()}
    assert [h.source for h in again[2][:2]] == ["b.txt", "b.txt"] and len(again[1]) == 5
    index.write_index(docs, path, hooks.embedder, SMALL, recreate=True)
    assert index.read_index(spark, path, SMALL).chunks.count() == 3


def test_runs_share_sections_and_a_failed_run_changes_nothing(spark, tmp_path):
    hooks = offline(DIM)
    docs = spark.createDataFrame(
        [("a.md", "# Leave\nparental leave is long\n# Travel\nbook early"), ("b.md", "# Leave\nparental leave is long\n# Pay\nmonthly")],
        "source string, text string")
    more = spark.createDataFrame([("c.md", "# Travel\nbook early\n# Food\ncanteen")], "source string, text string")
    path = str(tmp_path / "ix")
    index.write_index(docs, path, hooks.embedder, SMALL, recreate=True, run="0")
    index.write_index(more, path, hooks.embedder, SMALL, run="1")
    stored = index.read_index(spark, path, SMALL)
    parents = [r.parent_id for r in stored.sections.collect()]
    assert len(parents) == len(set(parents)) == 4
    # A section of a replaced run that another run still needs stays.
    index.write_index(docs.filter("source = 'b.md'"), path, hooks.embedder, SMALL, run="0")
    stored = index.read_index(spark, path, SMALL)
    assert stored.chunks.count() == 4
    assert stored.chunks.join(stored.sections, "parent_id", "left_anti").count() == 0
    sums = stored.size.groupBy().sum("n", "total_len").head()
    assert sums[0] == 4 and sums[1] == sum(len(r.child.replace("#", " ").split()) for r in stored.chunks.collect())

    @F.pandas_udf("array<float>")
    def failing(t: pd.Series) -> pd.Series:
        raise ValueError("no model today")

    before = sorted(map(str, stored.chunks.drop("embedding").collect()))
    for recreate in (True, False):
        with pytest.raises(Exception, match="no model today"):
            index.write_index(docs, path, Hook(failing), SMALL, recreate=recreate, run="0")
        kept = index.read_index(spark, path, SMALL)
        assert sorted(map(str, kept.chunks.drop("embedding").collect())) == before
        assert kept.sections.count() == 4
    index.write_index(more, path, hooks.embedder, SMALL, recreate=True)
    assert index.read_index(spark, path, SMALL).sections.count() == 2


def test_fingerprint_and_dimensions(spark, tmp_path):
    hooks = offline(DIM)
    path = str(tmp_path / "ix")
    index.assert_embedder(spark, path, SMALL.fingerprint())
    docs = spark.createDataFrame([("a", "some text")], "source string, text string")
    index.write_index(docs, path, hooks.embedder, SMALL, recreate=True)
    index.assert_embedder(spark, path, SMALL.fingerprint())
    other = replace(SMALL, embed_provider="elsewhere")
    with pytest.raises(index.EmbedderMismatchError):
        index.read_index(spark, path, other)
    with pytest.raises(index.EmbedderMismatchError):
        index.write_index(docs, path, hooks.embedder, other)
    frame = spark.createDataFrame([([0.0] * 3,), ([0.0] * 4,)], "embedding array<float>")
    assert index.wrong_dimensions(frame, 3).count() == 1
    index.assert_dimensions(frame.limit(0), 3)
    with pytest.raises(index.DimensionError, match="4-dim"):
        index.assert_dimensions(frame, 3)
    with pytest.raises(Exception, match="16-dim"):
        index.write_index(docs, str(tmp_path / "bad"), hooks.embedder, replace(SMALL, embed_dim=8), recreate=True)


@pytest.mark.parametrize("dim", [1, 8, 300])
def test_stored_vectors(spark, dim):
    """Stored vectors come back as they were, sparse, full, empty and odd ones; another length is refused."""
    rng = np.random.default_rng(dim)
    full = rng.normal(size=(40, dim)).astype(np.float32)
    rows = np.where(rng.random((40, dim)) < rng.choice([0.02, 0.5, 0.7, 1.0], (40, 1)), full, np.float32(0))
    rows[0], rows[1, 0], rows[2, 0] = 0, np.inf, 1e-45
    given = pa.array(rows.tolist(), pa.list_(pa.float32()))
    stored = stored_vectors.pack(given, dim)
    assert np.array_equal(stored_vectors.unpack(stored, dim), rows.astype(float))
    assert np.array_equal(stored_vectors.unpack(stored.slice(3, 9), dim), rows[3:12].astype(float))
    assert max(len(v) for v in stored.to_pylist()) <= 4 * dim + 6
    for bad in (pa.array([rows[0].tolist() + [1.0]], given.type), pa.array([None], given.type)):
        with pytest.raises(ValueError, match="are configured"):
            stored_vectors.pack(pa.concat_arrays([given, bad]), dim)
    with pytest.raises(ValueError, match="dimensions"):
        stored_vectors.unpack(stored, dim + 1)
    frame = spark.createDataFrame([(rows[5].tolist(),)], "v array<float>")
    back = frame.select(stored_vectors.packed(F.col("v"), dim).alias("v")).select(stored_vectors.unpacked(F.col("v")).alias("v"))
    assert back.head().v == rows[5].tolist()


def test_index_stores_small_vectors(spark, tmp_path):
    """A chunk's vector takes less room than its plain numbers, and search reads it as it lies."""
    hooks = offline(DEFAULTS.embed_dim)
    docs = spark.range(50).selectExpr("concat('d', id) as source", "concat('cats and dogs ', id) as text")
    path = str(tmp_path / "ix")
    index.write_index(docs, path, hooks.embedder, DEFAULTS, recreate=True, run="0")
    chunks = index.read_index(spark, path, DEFAULTS).chunks
    assert chunks.select(F.max(F.octet_length("embedding"))).head()[0] <= 30
    plain = chunks.select("chunk_id", stored_vectors.unpacked(F.col("embedding")).alias("embedding"))
    asked = spark.createDataFrame([(1, "dogs 7"), (2, "cats")], "question_id int, query string")
    asked = asked.select("question_id", hooks.embedder(F.col("query")).alias("embedding"))
    found = [sorted(map(tuple, vector_top_k(c, asked, 20).collect())) for c in (chunks, plain)]
    assert found[0] == found[1] and len(found[0]) == 40


def test_word_statistics_leave_as_one_row_per_batch_and_word(spark):
    """What is added up are rows of distinct words, not a row for every word of every text."""
    texts = [("a b a",), ("A c",), ("",), (None,), ("  .",)] + [("x y",)] * 500
    chunks = spark.createDataFrame(texts, "child string").coalesce(1)
    terms, size = word_statistics(chunks)
    assert {tuple(r) for r in terms.collect()} == {("a", 2), ("b", 1), ("c", 1), ("x", 500), ("y", 500)}
    assert tuple(size.head()) == (504, 1005)
    lists = pa.array([["a", "b", "a"], [], None, ["c", "a"]], pa.list_(pa.string()))
    (out,) = _batch_sums(iter([pa.RecordBatch.from_arrays([lists], ["w"])]))
    assert sorted(map(str, zip(*out.to_pydict().values()))) == sorted(
        map(str, [("a", 2, 0), ("b", 1, 0), ("c", 1, 0), (None, 3, 5)]))
    assert word_statistics(chunks.limit(0))[1].head().n == 0


def test_only_chosen_sections_are_looked_up(spark, tmp_path):
    """The join with the sections sees the chosen ones; a section nobody asks for is not shuffled."""
    hooks = offline(DIM)
    docs = spark.createDataFrame([(f"{i}.md", f"# A{i}\nword{i}\n# B{i}\nother{i}") for i in range(30)], "source string, text string")
    index.write_index(docs, str(tmp_path / "ix"), hooks.embedder, SMALL, recreate=True, run="0")
    asked = spark.createDataFrame([(1, "word7")], "question_id int, query string")
    found = retrieve(asked, index.read_index(spark, str(tmp_path / "ix"), SMALL), hooks, replace(SMALL, top_k=1))
    assert found.head().hits[0].parent.startswith("# A7")
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_an_answer_is_masked_once(spark, tmp_path):
    """The output screen sees each distinct answer, not a copy for each question that got it."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def judge(text):
        seen.add(int("pets" in (text or "")))
        return False

    hooks = replace(offline(DIM), toxicity_judge=Hook(judge))
    docs = spark.createDataFrame([("a.md", "cats are pets, write to me@example.com")], "source string, text string")
    index.write_index(docs, str(tmp_path / "ix"), hooks.embedder, SMALL, recreate=True, run="0")
    asked = spark.range(200).selectExpr("id as question_id", "if(id = 0, null, 'cats') as question", "cast(null as string) as raw_sql")
    answered = answer_batch(asked, index.read_index(spark, str(tmp_path / "ix"), SMALL), hooks, SMALL)
    got = {r.question_id: r for r in materialize(answered, "answered").collect()}
    assert len(got) == 200 and got[7].pii_masked and "@" not in got[7].text
    assert got[7].guard_findings == ["masked EMAIL"] and got[7].hits[0].text.endswith("example.com")
    assert 0 < seen.value < 20


def test_chunks_stay_where_they_lie(spark, tmp_path):
    """The few ids found go to the chunks whatever the session's broadcast limit; too many are left to the planner."""
    hooks = offline(DIM)
    docs = spark.range(40).selectExpr("concat('d', id) as source", "concat('cats and dogs ', id) as text")
    index.write_index(docs, str(tmp_path / "ix"), hooks.embedder, SMALL, recreate=True, run="0")
    ix = index.read_index(spark, str(tmp_path / "ix"), SMALL)
    asked = spark.createDataFrame([(1, "dogs 7"), (2, "cats")], "question_id int, query string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, rows = [], []
        for settings in (SMALL, replace(SMALL, broadcast_bytes=8 * DIM * 2)):
            found = candidates(asked, ix, hooks, settings)
            plans.append("BroadcastHashJoin" in found._jdf.queryExecution().sparkPlan().toString())
            rows.append(sorted(map(str, found.collect())))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans == [True, False] and rows[0] == rows[1] and len(rows[0]) == 40
