import pytest
from pyspark.sql import functions as F

from docquery.hooks import Hook
from docquery.sources import files
from docquery.sources.tables import rows_to_text


def test_text_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "my doc%20.md").write_text("# Title\n\nsome body text")
    (tmp_path / "sub" / "b.TXT").write_bytes(b"plain \xff content\r\nhere")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "noise.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "archive.zip").write_bytes(b"x")
    (tmp_path / "no_suffix").write_text("x")
    (tmp_path / "report.pdf").write_bytes(b"x")
    got = {r.source: r.text for r in files.read_text_documents(spark, str(tmp_path)).collect()}
    assert got == {"my doc%20.md": "# Title\n\nsome body text", "b.TXT": "plain  content\nhere"}
    parser = Hook(lambda content: F.concat(F.lit("parsed "), content.cast("string")))
    more = {r.source: r.text for r in files.read_documents(spark, str(tmp_path), {".pdf": parser}).collect()}
    assert more == {**got, "report.pdf": "parsed x"}
    with pytest.raises(ValueError, match="Unsupported file type: .zip"):
        files.read_documents(spark, str(tmp_path), {".zip": parser})
    rejected = {r.path.rsplit("/", 1)[1]: r.reason for r in files.rejected_files(spark, str(tmp_path)).collect()}
    assert rejected == {"archive.zip": "Unsupported file type: .zip", "no_suffix": "Unsupported file type: "}
    names = lambda rows: {r.path.rsplit("/", 1)[1]: r.reason for r in rows.collect()}
    empty = {"noise.txt": "No text in file"}
    assert names(files.skipped_files(spark, str(tmp_path))) == {
        **rejected, **empty, "report.pdf": "No parser for file type: .pdf"
    }
    assert names(files.skipped_files(spark, str(tmp_path), {".pdf": parser})) == {**rejected, **empty}


def test_unreadable_files_are_listed(spark, tmp_path):
    """A file that no longer matches its checksum is skipped by the reader and listed with its reason."""
    root = tmp_path / "folder"
    spark.createDataFrame([("some text",)], "value string").coalesce(1).write.text(str(root))
    (root / "fine.md").write_text("fine")
    broken = next(p for p in root.iterdir() if p.name.startswith("part-") and p.suffix == ".txt")
    broken.write_text("other words")
    assert [r.source for r in files.read_text_documents(spark, str(root)).collect()] == ["fine.md"]
    skipped = {r.path.rsplit("/", 1)[1]: r.reason for r in files.skipped_files(spark, str(root)).collect()}
    assert skipped[broken.name] == "Unreadable file" and "fine.md" not in skipped


def test_rows_to_text(spark):
    people = spark.createDataFrame([("alice", 30), ("bob", None), (None, None)], "name string, age int")
    lines = [r.line for r in rows_to_text(people, "People").collect()]
    assert lines == ["People | name=alice | age=30", "People | name=bob"]


def test_question_set(spark, tmp_path):
    (tmp_path / "q.json").write_text('[{"question": "q1", "expected_route": "documents"},\n {"question": "q2"}]')
    got = files.read_question_set(spark, str(tmp_path / "q.json")).collect()
    assert [(r.question, r.expected_route) for r in got] == [("q1", "documents"), ("q2", None)]


def test_report(spark, tmp_path):
    scores = spark.createDataFrame([("faithfulness", 0.5, 2), ("answer_relevancy", 1.0, 2)], "metric string, score double, n long")
    files.write_report(scores, spark.range(2), str(tmp_path / "r"))
    got = {r.metric: r.score for r in files.read_report(spark, str(tmp_path / "r" / "scores")).collect()}
    assert got == {"faithfulness": 0.5, "answer_relevancy": 1.0}
    assert files.read_report(spark, str(tmp_path / "missing")).count() == 0
    (tmp_path / "bad.json").write_text("{not json")
    assert files.read_report(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "plain.json").write_text('{"scores": {"x": 0.25}, "n": 1, "items": []}')
    assert [tuple(r) for r in files.read_report(spark, str(tmp_path / "plain.json")).collect()] == [("x", 0.25)]


def test_rejected_files_are_counted(spark, tmp_path):
    """One file per segment and range of customer keys, and one for customers without a key, as the SQL says."""
    import duckdb

    from docquery.plans.oracles import SQL
    from docquery.plans.queries import QUERIES

    rows = [(1, "A", "x"), (999_999, "A", None), (1_000_000, "A", "y"), (None, "A", "z"), (5, "B", "x"), (5, "B", "x")]
    customers = spark.createDataFrame(rows, "c_custkey long, c_mktsegment string, c_name string").repartition(3)
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    got = {(r.segment, r.reason, r.n_files) for r in QUERIES["rejected_files"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    assert got == set(con.execute(SQL["rejected_files"]).fetchall())
    assert {(s, n) for s, _, n in got} == {("A", 3), ("B", 1)}
