import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from docquery.llm import linerules
from docquery.llm.oracles import SQL
from docquery.plans.check import duckdb_rows, spark_rows

SCHEMA = "doc_id long, text string, source string, n_words string, frequent string"


def plain_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {i + j for i, run in enumerate(runs) if runs.count(run) > 1 for j in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
    )


@pytest.mark.parametrize("seed", range(8))
def test_counts_equal_plain_counts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab#é|　\x1c") for _ in range(rng.randint(1, 2)))
    text = "".join(word() + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 120)))
    assert linerules.measure(text)[:5] == plain_measure(text)


def corpus():
    """40 documents of one host share a line; one has nothing else, ten are copies with lines of their own."""
    rng = random.Random(3)
    line = lambda n: " ".join("w" + str(rng.randrange(10**6)) for _ in range(n))
    shared = "Shared  line of " + line(25)
    rows = [(i, f"{line(30)}\n{shared}\n{line(10)}", "h1") for i in range(40)]
    rows += [(100, shared, "h1"), (101, f"{line(5)}\n{shared.upper()}", "h1"), (102, f"{line(40)}\n{shared}", "h2")]
    copied = f"{line(30)}\n{line(20)}"
    rows += [(200 + i, copied + f" {line(1)}" * (i % 2), "h1") for i in range(60)]
    return rows, shared


def test_frequent_lines_go_and_depleted_documents_with_them(spark):
    rows, shared = corpus()
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = {r["doc_id"]: r for r in linerules.rule_verdicts(table).collect()}
    assert all(got[i]["removed_words"] == 28 and got[i]["kept"] for i in range(40))
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert not got[101]["kept"] and got[101]["removed_words"] == 28
    assert got[102]["removed_words"] == 0 and got[102]["kept"]
    assert all(got[200 + i]["kept"] for i in range(60))
    cleaned = linerules.clean_documents(table)
    assert cleaned.columns == table.columns
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert set(texts) == {i for i, r in got.items() if r["kept"]}
    assert all(shared not in texts[i] for i in range(40)) and texts[102].endswith(shared)


def test_nulls_empty_long_and_repeats(spark):
    long = "\n".join(f"line {i} with words" for i in range(20_000))
    rows = [(1, None, None), (2, "", "h"), (3, long, "h"), (3, long, "h"), (None, "a b c", "h")]
    table = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in linerules.rule_verdicts(table).collect()), key=str)
    assert got == sorted([(1, 0, True, False), (2, 0, True, False), (3, 80_000, False, True), (3, 80_000, False, True), (None, 3, True, False)], key=str)
    assert linerules.clean_documents(table).agg(F.count("*")).head()[0] == 2
    empty = spark.createDataFrame([], SCHEMA)
    assert linerules.rule_verdicts(empty).count() == 0 and linerules.clean_documents(empty).count() == 0


def test_shared_line_that_is_the_longest_of_each_document(spark):
    rng = random.Random(4)
    line = lambda n: " ".join("w" + str(rng.randrange(10**6)) for _ in range(n))
    notice, second = line(60), line(50)
    rows = [(i, f"{notice}\n{line(12)}", "h1") for i in range(30)]
    # Two shared lines, which are the longest and the next longest of each document.
    rows += [(100 + i, f"{second} more\n{line(9)}\n{second}", "h2") for i in range(30)]
    rows += [(200 + i, f"{line(60)}\n{line(12)}", "h1") for i in range(30)]
    # Exact copies are one document.
    rows += [(300 + i, rows[-1][1] + " copied", "h1") for i in range(30)]
    table = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = {r["doc_id"]: (r["removed_words"], r["kept"]) for r in linerules.rule_verdicts(table).collect()}
    assert all(got[i] == (60, False) for i in range(30))
    assert all(got[100 + i] == (101, False) for i in range(30))
    assert all(got[i + j] == (0, True) for i in range(30) for j in (200, 300))
    assert {r["doc_id"] for r in linerules.clean_documents(table).collect()} == {i + j for i in range(30) for j in (200, 300)}


def test_sql_states_the_same_rule(spark, tmp_path):
    """On documents whose longest line is the shared one, and in a host where the share of the host counts."""
    rng = random.Random(5)
    line = lambda n: " ".join("w" + str(rng.randrange(10**6)) for _ in range(n))
    notice, rare = line(60), line(40)
    texts = [f"{notice}\n{line(12)}" for _ in range(30)] + [f"{line(30)}\n{rare}" for _ in range(20)] + [None, ""]
    rows = [(i, t, "h1") for i, t in enumerate(texts)]
    # 23 of 12,000 documents are above the least number, and below the share.
    rows += [(1000 + i, f"{line(20)}\n{rare}" if i < 23 else line(21), "h2") for i in range(12_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(linerules.rule_verdicts(table))
    assert got == duckdb_rows(con, SQL["op4_line_rules"])
    at = got[0].index("removed_words")
    assert sum(r[at] == "60" for r in got[1]) == 30 and sum(r[at] == "40" for r in got[1]) == 0


def test_limit_of_a_large_host(spark, monkeypatch):
    """The share of a host never asks for more than the most documents."""
    rows = [(i, f"own words {i} " * 10 + "\na notice of a few words", "h") for i in range(60)]
    table = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    monkeypatch.setattr(linerules, "SHARE_OF_HOST", 1.0)
    assert linerules.rule_verdicts(table).filter("removed_words > 0").count() == 0
    monkeypatch.setattr(linerules, "MOST_DOCUMENTS", 50)
    assert linerules.rule_verdicts(table).filter("removed_words = 6").count() == 60
