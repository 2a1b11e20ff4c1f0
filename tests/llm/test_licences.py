import math
import random
import re
import textwrap

import duckdb

from docquery.llm import licences, queries
from docquery.llm.oracles import SQL
from docquery.plans.check import duckdb_rows, spark_rows

SCHEMA = "path string, text string, licence int, extra int"


def scanned(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    out = licences.scan_licences(table)
    assert out.columns == ["path", "text", "extra", "own_licence", "own_score", "licence", "inherited_from"]
    return [(r["path"], r["own_licence"], r["licence"], r["inherited_from"]) for r in out.collect()]


MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def test_own_notice_and_nearest_directory(spark):
    rows = [
        ("a/LICENSE", f"some text\n{MIT}"), ("a/b/COPYING.txt", GPL), ("a/x.py", "code"), ("a/b/c/y.py", "code\ncode"),
        ("a/b/z.py", "# licensed under CC BY-NC 4.0"), ("ab/w.py", "code"), ("a/notes.txt", GPL),
    ]
    got = {r[0]: r[1:] for r in scanned(spark, rows)}
    assert got["a/x.py"] == (None, "MIT", "a")
    assert got["a/b/c/y.py"] == (None, "GPL-3.0", "a/b")
    assert got["a/b/z.py"] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None)
    assert got["ab/w.py"] == (None, None, None)
    assert got["a/notes.txt"][0] == "GPL-3.0"


def test_root_file_speaks_for_all(spark):
    got = {r[0]: r[1:] for r in scanned(spark, [("LICENSE", MIT), ("p/q/r.txt", "x")])}
    assert got["p/q/r.txt"] == (None, "MIT", "")


def test_nulls_repeats_long_and_empty(spark):
    long = "word " * 50_000 + "\n" + MIT + "\n" + "license " * 20_000
    rows = [(None, None), ("d/e.txt", ""), ("d/LICENCE", long), ("d/LICENCE", long), ("d/f", None)]
    got = scanned(spark, rows)
    assert sorted(got, key=str) == sorted([
        (None, None, None, None), ("d/e.txt", None, "MIT", "d"), ("d/LICENCE", "MIT", "MIT", None),
        ("d/LICENCE", "MIT", "MIT", None), ("d/f", None, "MIT", "d"),
    ], key=str)
    assert scanned(spark, []) == []


def test_parts_without_heavy_terms_stay_below(spark):
    vectors = licences.template_vectors({"the": 50, "license": 7, "mit": 1}, 60, licences.TEMPLATES)
    heavy = licences.heavy_terms(vectors, licences.THRESHOLD)
    for _, vector in vectors:
        rest = math.sqrt(sum(w * w for t, w in vector.items() if t not in set(heavy)))
        assert rest < licences.THRESHOLD
    pattern = re.compile(licences._any_of(heavy))
    for term in heavy:
        assert pattern.search(f"x {term}.") and pattern.search(term.upper()) and not pattern.search(f"x{term}9")


def bodies(name):
    return [" ".join(body.split()) for n, body in licences.TEMPLATES if n == name]


def test_headers_wrapped_notices_licence_files_and_tags(spark):
    wrapped = textwrap.wrap(max(bodies("MIT"), key=len), 70)
    header = "\n".join(["// Copyright 2020 Some Body", *(f"// {x}" for x in wrapped), "int main() {", "// words of no interest"])
    whole = f"MIT License\n\nCopyright (c) 2021 A. Person\n\n" + "\n".join(wrapped)  # noqa: F541
    bsd = "Copyright 2001 X\n\n" + "\n".join(textwrap.wrap(max(bodies("BSD-3-Clause"), key=len), 60))
    gpl = "\n".join("# " + x for x in ["tool.py does things", *textwrap.wrap(max(bodies("GPL-3.0"), key=len), 75)])
    rows = [
        ("h/a.c", header), ("g/b.txt", "words before\nThis work is licensed under the GNU General\nPublic License, version 3.\nwords after"),
        ("t/LICENSE", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE"),
        ("s/x.py", "# SPDX-License-Identifier: MIT\ncode"), ("s/y.py", "# SPDX-License-Identifier: Unknown-1.0\ncode"),
        ("w/LICENSE", whole), ("w/deep/file.py", "code"), ("b/COPYING", bsd), ("p/c.py", gpl + "\n\nimport os"),
        ("n/prose.txt", "The license of the software was a matter of public debate.\nPermission to speak was granted to the committee."),
    ] + [(f"z/{i}.txt", f"the of and to in is a this work under public or any use {i} " * 5) for i in range(40)]
    got = {r[0]: r[1:] for r in scanned(spark, rows)}
    own = {path: got[path][0] for path, _ in rows[:10]}
    assert own == {
        "h/a.c": "MIT", "g/b.txt": "GPL-3.0", "t/LICENSE": "Apache-2.0", "s/x.py": "MIT", "s/y.py": None, "w/LICENSE": "MIT",
        "w/deep/file.py": None, "b/COPYING": "BSD-3-Clause", "p/c.py": "GPL-3.0", "n/prose.txt": None,
    }
    assert got["w/deep/file.py"] == (None, "MIT", "w")
    assert all(got[f"z/{i}.txt"][0] is None for i in range(40))


def test_sql_states_the_same_rule(spark, tmp_path):
    """On documents with headers, wrapped notices, tags and licence files, which the tables do not hold."""
    wrapped = textwrap.wrap(max(bodies("MIT"), key=len), 70)
    texts = {
        40: "MIT License\n\n" + "\n".join(wrapped), 1: "\n".join(f"# {x}" for x in wrapped) + "\ncode", 2: "# SPDX-License-Identifier: mpl-2.0",
        3: "a\nThis work is licensed under the GNU General\nPublic License, version 3.", 80: "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/",
        97: "Mozilla Public License Version 2.0", 90: None, 4: "",
    }
    rng = random.Random(2)
    rows = [(i, texts.get(i, " ".join(rng.choice("the of and work public code license in".split()) for _ in range(30))), "en", "src") for i in range(120)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(queries.op3_licence_scan(spark, str(tmp_path)))
    assert got == duckdb_rows(con, SQL["op3_licence_scan"])
    assert sum(r[got[0].index("own_licence")] != "None" for r in got[1]) == 6
