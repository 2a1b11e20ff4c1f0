from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.sqlscreen import execution_error, strip_fences
from docquery.hooks import Hook, always
from docquery.operators.statements import (
    NotReadOnlyError, execute_distinct, resume_decided, route_questions, run_select,
    structured_branch, validate, with_risk,
)
from docquery.settings import DEFAULTS

EMPLOYEES = [(1, "Ava", "Engineering", 182000), (2, "Ben", "Sales", 112000)]


@pytest.fixture(scope="module")
def employees(spark, tmp_path_factory):
    frame = spark.createDataFrame(EMPLOYEES, "id int, name string, department string, salary int")
    frame.createOrReplaceTempView("employees")
    # A table of the catalog, which no statement may read.
    frame.write.option("path", str(tmp_path_factory.mktemp("tables") / "catalogued")).saveAsTable("catalogued")
    yield frame
    spark.sql("DROP TABLE catalogued")


@pytest.fixture
def log(spark):
    return lambda *sql: spark.createDataFrame([(s,) for s in sql], "raw_sql string")


def test_route(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf(T.StringType())
    def classify(q: pd.Series) -> pd.Series:
        calls.add(len(q))
        return q.map(lambda x: "Structured." if "team" in x else "documents")

    asked = spark.createDataFrame(
        [("How many engineers?",), ("average salary in Sales",), ("What is parental leave?",), ("team size?",)],
        "question string",
    )
    got = {r.question: r.route for r in route_questions(asked, Hook(classify)).collect()}
    assert got == {"How many engineers?": "structured", "average salary in Sales": "structured",
                   "What is parental leave?": "documents", "team size?": "structured"}
    assert calls.value == 2


def test_validation(log):
    good = validate(log("SELECT COUNT(*) FROM employees", "```sql\nSELECT name FROM employees;\n```",
                        "WITH x AS (SELECT 1) SELECT * FROM x", "`select 1`")).collect()
    assert [r.sql for r in good] == [
        "SELECT COUNT(*) FROM employees", "SELECT name FROM employees",
        "WITH x AS (SELECT 1) SELECT * FROM x", "select 1",
    ]
    bad = validate(log(
        "DELETE FROM employees", "UPDATE employees SET salary = 0", "INSERT INTO employees VALUES (1)",
        "DROP TABLE employees", "SELECT 1; DROP TABLE employees", "SELECT * FROM employees; DELETE FROM x", "",
        "SELECT replace(name, 'a', 'b') FROM employees", "``````",
    )).collect()
    assert [r.error for r in bad] == ["only SELECT queries are allowed"] * 4 + [
        "only a single statement is allowed"] * 2 + ["empty SQL", "query contains a write/DDL keyword", "empty SQL"]
    assert not any(r.valid for r in bad) and all(r.sql is None for r in bad)


def test_fence_only_when_whole(one):
    assert one(strip_fences, "```SQL\nselect 1\n```") == "select 1"
    assert one(strip_fences, "see ```select 1```") == "see ```select 1"


def test_execution_check_is_stricter(one):
    assert one(execution_error, "SELECT 1;") is None
    assert one(execution_error, "WITH x AS (SELECT 1) SELECT * FROM x") == "only SELECT queries are allowed"
    assert one(execution_error, "SELECT 1; DROP TABLE x") == "multiple statements are not allowed"


def test_run_select(spark, employees):
    rows = run_select(spark, "SELECT name, department FROM employees ORDER BY name").collect()
    assert [tuple(r) for r in rows] == [("Ava", "Engineering"), ("Ben", "Sales")]
    assert run_select(spark, "SELECT * FROM employees", 1).count() == 1
    assert run_select(spark, "SELECT * FROM employees", 0).count() == 2
    for sql in ("DELETE FROM employees", "SELECT 1; DROP TABLE employees"):
        with pytest.raises(NotReadOnlyError):
            run_select(spark, sql)


def test_risk(spark):
    def flags(sql, **change):
        frame = spark.createDataFrame([(sql,)], "sql string")
        return with_risk(frame, replace(DEFAULTS, **change)).head()

    assert flags("SELECT name, salary FROM employees WHERE id = 1").reasons == ["reads sensitive column 'salary'"]
    assert flags("SELECT name FROM employees").reasons == ["unbounded scan (no WHERE/LIMIT) could return whole rows"]
    for safe in ("SELECT department, COUNT(*) FROM employees GROUP BY department",
                 "SELECT name FROM employees WHERE department = 'Sales'", "SELECT name FROM employees LIMIT 10"):
        assert not flags(safe).risky
    assert not flags("SELECT name FROM employees", flag_broad_scans=False).risky
    assert not flags("SELECT salary_band FROM grades WHERE id = 1", flag_broad_scans=False).risky
    both = flags("SELECT pay, Salary FROM t", sensitive_columns=("Salary", "pay")).reasons
    assert both[:2] == ["reads sensitive column 'salary'", "reads sensitive column 'pay'"]
    assert not flags("SELECT salary FROM t", sensitive_columns=(), flag_broad_scans=False).risky


def test_every_distinct_statement_runs_once(spark, employees):
    texts = [f"SELECT count(*) AS n FROM employees WHERE id > {i}" for i in range(11)]
    texts += ["SELECT nope FROM employees", "SELECT id / 0 AS x FROM employees WHERE id = 1"]
    frame = spark.createDataFrame([(t,) for t in texts * 3], "sql string")
    got = {r.sql: r for r in execute_distinct(frame).collect()}
    assert len(got) == 13
    assert got[texts[0]].rows_json == '[{"n":2}]' and got[texts[1]].rows_json == '[{"n":1}]'
    assert got[texts[11]].error.startswith("query failed to execute: UNRESOLVED_COLUMN")
    assert got[texts[12]].error is not None


def test_branch_freeze_and_resume(spark, employees):
    log = spark.createDataFrame([
        ("s1", "who?", "SELECT name FROM employees WHERE id = 1"),
        ("f1", "salary?", "SELECT salary FROM employees WHERE id = 1"),
        ("b1", "delete", "DROP TABLE employees"),
        ("n1", "none", None),
    ], "request_id string, question string, raw_sql string")
    got = {r.request_id: r for r in structured_branch(log).collect()}
    assert len(got) == 4
    assert (got["s1"].status, got["s1"].text, got["s1"].row_count) == ("executed", '[{"name":"Ava"}]', 1)
    assert (got["f1"].status, got["f1"].text) == ("frozen", "") and "salary" in got["f1"].risk_reason
    assert got["b1"].sql is None and "couldn't answer" in got["b1"].text
    assert "empty SQL" in got["n1"].text
    off = {r.request_id: r for r in structured_branch(log, replace(DEFAULTS, approval_enabled=False)).collect()}
    assert off["f1"].status == "executed" and off["f1"].text == '[{"salary":182000}]'

    frozen = with_risk(validate(log)).filter("valid and risky")
    for decision, status, text in (("approved", "executed", '[{"salary":182000}]'), ("denied", "denied", None)):
        state = spark.createDataFrame([("f1", decision), ("zz", "approved")], "request_id string, status string")
        answer = resume_decided(frozen, state).collect()
        assert [r.status for r in answer] == [status]
        assert answer[0].text == text if text else "denied" in answer[0].text
    waiting = spark.createDataFrame([("f1", "pending")], "request_id string, status string")
    assert resume_decided(frozen, waiting).count() == 0


def test_offline_classifier(spark):
    asked = spark.createDataFrame([("tell me",)], "question string")
    assert route_questions(asked, always("documents")).head().route == "documents"


@pytest.mark.parametrize(
    "sql, reason",
    [
        ("SELECT value FROM text.`{path}`", "only the registered views can be read"),
        ("SELECT x.value FROM (SELECT * FROM parquet.`{path}`) x", "only the registered views can be read"),
        ("SELECT (SELECT max(value) FROM text.`{path}`)", "only the registered views can be read"),
        ("SELECT reflect('java.lang.Math', 'abs', -3)", "function is not allowed: reflect"),
        ("SELECT name FROM employees WHERE java_method('java.lang.Math', 'abs', -3) = 3", "function is not allowed: java_method"),
        ("SELECT name FROM employees ORDER BY try_reflect('java.lang.Math', 'abs', -3)", "function is not allowed: try_reflect"),
        ("SELECT TRANSFORM(id) USING 'cat' AS (x) FROM employees", "only plain SELECT queries are allowed"),
        ("SELECT * FROM range(5)", "only plain SELECT queries are allowed"),
        ("SELECT * FROM default.employees", "only the registered views can be read"),
        ("SELECT * FROM nowhere", "TABLE_OR_VIEW_NOT_FOUND"),
        ("SELECT IDENTIFIER('reflect')('java.lang.Math', 'abs', -3) FROM employees", "expression is not allowed: ExpressionWithUnresolvedIdentifier"),
        ("SELECT id FROM employees WHERE IDENTIFIER('java_method')('java.lang.Math', 'abs', -3) = 3", "expression is not allowed"),
        ("SELECT * FROM IDENTIFIER('employees')", "only plain SELECT queries are allowed"),
        ("SELECT x.* FROM catalogued x, (WITH catalogued AS (SELECT 1 a) SELECT * FROM catalogued) y", "TABLE_OR_VIEW_NOT_FOUND"),
        ("SELECT * FROM (WITH catalogued AS (SELECT * FROM catalogued) SELECT * FROM catalogued)", "TABLE_OR_VIEW_NOT_FOUND"),
        ("SELECT * FROM (WITH a AS (SELECT * FROM b), b AS (SELECT 1 x) SELECT * FROM a)", "TABLE_OR_VIEW_NOT_FOUND"),
        ("SELECT (WITH c AS (SELECT 1 x) SELECT max(x) FROM c) FROM c", "TABLE_OR_VIEW_NOT_FOUND"),
        ("SELECT id FROM employees WHERE id IN (SELECT x FROM catalogued)", "TABLE_OR_VIEW_NOT_FOUND"),
    ],
)
def test_plan_decides_before_anything_is_read(spark, employees, tmp_path, sql, reason):
    path = tmp_path / "not-there.txt"
    with pytest.raises(NotReadOnlyError, match=reason):
        run_select(spark, sql.format(path=path))


def test_views_of_other_case(spark, employees):
    """Names count as the session compares them."""
    sql = "SELECT * FROM (WITH Named AS (SELECT 1 AS a) SELECT * FROM named)"
    assert run_select(spark, sql).count() == 1
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(NotReadOnlyError, match="TABLE_OR_VIEW_NOT_FOUND"):
            run_select(spark, sql)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_many_statements_and_one_that_never_ends(spark, employees):
    """1,000 distinct statements; the endless one is cancelled, holds up nobody and says why."""
    spark.range(10**7).createOrReplaceTempView("many")
    endless = "SELECT count(*) AS n FROM many a, many b WHERE a.id + b.id > 3"
    texts = [f"SELECT {i} AS n" for i in range(999)]
    frame = spark.createDataFrame([(t,) for t in [*texts, endless]], "sql string")
    got = {r.sql: r for r in execute_distinct(frame, replace(DEFAULTS, sql_seconds=20.0, sql_at_once=16)).collect()}
    assert len(got) == 1000
    assert got.pop(endless).error == "query failed to execute: it took too long"
    assert [got[t] for i, t in enumerate(texts) if got[t].rows_json != f'[{{"n":{i}}}]' or got[t].error] == []


def test_own_risk_rules_and_answers(spark, employees):
    log = spark.createDataFrame([
        ("s1", "who?", "SELECT name FROM employees WHERE id = 1"),
        ("s2", "and who?", "SELECT name FROM employees WHERE id = 1"),
        ("f1", "salary?", "SELECT salary FROM employees WHERE id = 1"),
        ("b1", "delete", "DROP TABLE employees"),
    ], "request_id string, question string, raw_sql string")
    asked = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<string>")
    def risky(sql: pd.Series) -> pd.Series:
        asked.add(len(sql))
        return sql.map(lambda x: ["names a person"] if "name" in x else [])

    @F.pandas_udf("string")
    def tell(question: pd.Series, sql: pd.Series, rows: pd.Series) -> pd.Series:
        return question + " " + rows

    got = {r.request_id: r for r in structured_branch(log, risk=Hook(risky), answer=Hook(tell)).collect()}
    assert (got["s1"].status, got["s1"].risk_reason, got["s1"].text) == ("frozen", "names a person", "")
    assert (got["f1"].status, got["f1"].text) == ("executed", 'salary? [{"salary":182000}]')
    assert "only SELECT" in got["b1"].text
    assert asked.value == 2
    plain = {r.request_id: r.text for r in structured_branch(log, answer=Hook(tell)).collect()}
    assert plain["s1"] == 'who? [{"name":"Ava"}]' and plain["s2"] == 'and who? [{"name":"Ava"}]' and plain["f1"] == ""


def test_plain_selects_pass(spark, employees):
    for sql in (
        "SELECT department, count(*) FILTER (WHERE salary > 1) AS n FROM employees GROUP BY department HAVING count(*) > 0 ORDER BY n",
        "SELECT e.name FROM employees e JOIN (SELECT max(salary) AS m FROM employees) t ON e.salary = t.m",
        "SELECT name, rank() OVER (ORDER BY salary) AS r FROM employees WHERE id IN (SELECT id FROM employees)",
        "SELECT name FROM (WITH a AS (SELECT * FROM employees) SELECT * FROM a) UNION ALL SELECT 'x' LIMIT 3",
        "SELECT name FROM (WITH a AS (SELECT * FROM employees), b AS (SELECT * FROM A) SELECT * FROM (WITH c AS (SELECT * FROM b) SELECT * FROM c))",
        "SELECT (WITH m AS (SELECT max(id) AS x FROM employees) SELECT x FROM m) AS top, (SELECT count(*) FROM employees f WHERE f.id = e.id) AS n FROM employees e",
        "SELECT CASE WHEN id BETWEEN 1 AND 5 THEN 'low' ELSE NULL END AS c, CAST(id AS DOUBLE) / 2 AS h, -id AS m, transform(array(id), x -> x + 1)[0] AS t FROM employees",
        "SELECT e.* EXCEPT (salary), named_struct('a', 1).a AS a, name LIKE 'A%' AS l, id IS NOT NULL AS k, date_add(DATE '2024-01-01', 3) AS d FROM employees e",
        "SELECT name, sum(salary) OVER w AS s FROM employees WINDOW w AS (PARTITION BY department ORDER BY id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)",
        "SELECT department, name, sum(salary) AS s FROM employees GROUP BY ROLLUP (department, name) ORDER BY 1, s DESC NULLS LAST",
        "SELECT extract(YEAR FROM current_date()) AS y, substring('abc' FROM 2 FOR 1) AS s, INTERVAL 2 DAYS AS i, trim(BOTH ' ' FROM ' x ') AS t",
    ):
        assert run_select(spark, sql).count() >= 1


def test_null_cells_and_repeated_names_stay(spark, employees):
    log = spark.createDataFrame(
        [("SELECT 1 AS id, CAST(NULL AS STRING) AS nm LIMIT 1",), ("SELECT e.id, f.id, e.name AS `a``b` FROM employees e JOIN employees f ON e.id < f.id LIMIT 1",)],
        "sql string",
    )
    got = {r.sql: r for r in execute_distinct(log).collect()}
    assert [r.rows_json for r in got.values() if "nm" in r.sql] == ['[{"id":1,"nm":null}]']
    assert [r.rows_json for r in got.values() if "nm" not in r.sql] == ['[{"id":1,"a`b":"Ava"}]']


def test_no_risk_reason_when_nobody_is_asked(spark, employees):
    log = spark.createDataFrame([("1", "q", "SELECT salary FROM employees")], "request_id string, question string, raw_sql string")
    row = structured_branch(log, replace(DEFAULTS, approval_enabled=False)).head()
    assert (row.status, row.risk_reason, row.row_count) == ("executed", "", 2)
