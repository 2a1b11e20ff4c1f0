"""Licences of files: headers, notices and licence files compared with templates, and inherited from directories.

The parts of a file that may state a licence are compared with licence templates by the cosine of sparse
TF-IDF vectors: each line, two or three adjacent lines, the header (the comment lines a file begins with, up
to a blank or code line) and, where the name says that the file holds a licence, the whole text. Terms
are weighted by how many files have them, all terms alike. A line with an SPDX tag names its
licence itself. A file whose name says that it holds a licence speaks for its directory, and a file
without a licence of its own inherits from the nearest directory above it that has one.

Only parts that can reach the threshold are compared: a search for the heaviest terms, of which each must
have one, and a bound on the cosine from a part's template terms and length, lose none of them.

Defined cases: null texts are empty, null paths are the empty path; rows that share a path share a
verdict; of equal scores the first licence name wins; a text of any length is looked at whole; an empty
table gives no rows; further columns are kept, but those named like a result are replaced.
"""
from __future__ import annotations

import math
import re
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.functions.text import let
from docquery.shared import materialize

# How files say under which licence they are, in one line, in a title, or in a notice.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License."""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
        OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details. You should have received a copy of the GNU General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>."""),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions"""),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)
THRESHOLD = 0.8
LICENCE_FILE = "(?i)^(licen[cs]e|copying|notice)([^a-z].*)?$"
COMMENT = r"^\s*(#|//|/\*|\*|--|;|%|<!--)"
SPDX = r"(?i)SPDX-License-Identifier:\s*([A-Za-z0-9.+-]+)"
SEPARATORS = "[^a-z0-9]+"
# Adjacent lines that are compared together at most.
LINES_TOGETHER = 3


def template_terms(text: str) -> list[str]:
    return [t for t in re.split(SEPARATORS, text.lower()) if t]


def _terms(text: Column) -> Column:
    return F.split(F.lower(text), SEPARATORS)


def term_counts(files: DataFrame, text: str) -> DataFrame:
    """The stored `(term, n)`: how many files have each term."""
    present = F.explode(F.array_distinct(_terms(F.col(text)))).alias("term")
    return materialize(
        files.select(present).filter(F.col("term") != "").groupBy("term").agg(F.count("*").alias("n")), "term-counts"
    )


def term_weight(files: int, total: int) -> float:
    return math.log((total + 1) / (files + 1)) + 1


def template_vectors(seen: dict[str, int], total: int, templates) -> list[tuple[str, dict[str, float]]]:
    """The unit vector of each template, for term counts among `total` files."""
    vectors = []
    for name, body in templates:
        terms = template_terms(body)
        vector = {t: terms.count(t) * term_weight(seen.get(t, 0), total) for t in set(terms)}
        size = math.sqrt(sum(w * w for w in vector.values()))
        vectors.append((name, {t: w / size for t, w in vector.items()}))
    return vectors


def heavy_terms(vectors: list[tuple[str, dict[str, float]]], threshold: float) -> list[str]:
    """Terms of which a part must have one: without them its cosine with each template is below `threshold`."""
    heavy = set()
    for _, vector in vectors:
        missing = 0.0
        for term, weight in sorted(vector.items(), key=lambda item: (-item[1], item[0])):
            if missing > 1 - threshold**2 + 1e-9:
                break
            heavy.add(term)
            missing += weight * weight
    return sorted(heavy)


def _any_of(terms: list[str]) -> str:
    """A pattern for a text with one of the terms, tried by first letter."""
    groups = ((first, [t[1:] for t in some]) for first, some in groupby(terms, key=lambda t: t[0]))
    return "(?i)(?<![a-z0-9])(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in groups) + ")(?![a-z0-9])"


def reach(part: Column, vectors: list[tuple[str, dict[str, float]]], weights: dict[str, float]) -> Column:
    """The square of a bound on the cosine of a part with any template.

    The template terms of the part count exactly; of all its other words it is only used that none weighs
    less than 1, so a long text with a few of these terms is far below a template.
    """
    known = F.array(*map(F.lit, sorted(weights)))

    def by_term(values: dict[str, float], term: Column) -> Column:
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair]), term), F.lit(0.0))

    def bound(terms: Column) -> Column:
        def counted(term: Column) -> Column:
            n = F.size(F.filter(terms, lambda other: other == term))
            return F.struct(term.alias("term"), n.alias("n"), (n * by_term(weights, term)).alias("w"))

        def largest(found: Column) -> Column:
            # A split text may begin and end with an empty term.
            others = F.size(terms) - F.aggregate(found, F.lit(0), lambda total, f: total + f["n"]) - 2
            size = F.aggregate(found, F.lit(0.0), lambda total, f: total + f["w"] * f["w"]) + F.greatest(others, F.lit(0))

            def dot(vector: dict[str, float]) -> Column:
                return F.aggregate(found, F.lit(0.0), lambda total, f: total + f["w"] * by_term(vector, f["term"]))

            return let(F.greatest(*[dot(vector) for _, vector in vectors]), lambda x: x * x / F.nullif(size, F.lit(0.0)))

        return let(F.transform(F.array_intersect(terms, known), counted), largest)

    return F.coalesce(let(_terms(part), bound), F.lit(0.0))


def licence_parts(
    files: DataFrame, vectors: list[tuple[str, dict[str, float]]], weights: dict[str, float], threshold: float
) -> DataFrame:
    """`(path, of, n, part)`: the lines, adjacent lines, headers and licence files that may reach the threshold."""
    heavy = _any_of(heavy_terms(vectors, threshold))
    least = threshold**2 - 1e-9
    lines = F.split("text", "\n")
    is_licence = F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENCE_FILE)
    # Few files say anything of the kind; stored, so that the others are looked through once.
    said = materialize(
        files.filter(F.col("text").rlike(heavy)).select(
            "path", F.xxhash64("text").alias("of"), lines.alias("lines"), is_licence.alias("whole"),
            F.transform(lines, lambda line: line.rlike(heavy)).alias("flags"),
            F.array_position(F.transform(lines, lambda line: line.rlike(COMMENT)), False).alias("first_code"),
        ),
        "licence-files",
    )
    starts = F.filter(
        F.sequence(F.lit(1), F.size("lines")),
        lambda i: F.exists(F.slice("flags", i, F.lit(LINES_TOGETHER)), lambda x: x),
    )
    rows = []
    for width in range(1, LINES_TOGETHER + 1):
        within = said.select("path", "of", "lines", "flags", F.explode(starts).alias("at")).filter(
            (F.col("at") + width - 1 <= F.size("lines")) & F.exists(F.slice("flags", F.col("at"), F.lit(width)), lambda x: x)
        )
        part = F.array_join(F.slice("lines", F.col("at"), F.lit(width)), "\n")
        rows.append(within.select("path", "of", (F.col("at") * 8 + width).cast("long").alias("n"), part.alias("part")))
    length = F.when(F.col("first_code") > 0, F.col("first_code") - 1).otherwise(F.size("lines")).cast("int")
    header = said.withColumn("length", length).filter(F.col("length") > LINES_TOGETHER)
    rows.append(header.select(
        "path", "of", F.lit(1).cast("long").alias("n"), F.array_join(F.slice("lines", F.lit(1), F.col("length")), "\n").alias("part")
    ))
    rows.append(said.filter("whole").select("path", "of", F.lit(2).cast("long").alias("n"), F.array_join("lines", "\n").alias("part")))
    parts = rows[0]
    for more in rows[1:]:
        parts = parts.unionByName(more)
    return parts.filter(reach(F.col("part"), vectors, weights) >= least)


def _notices(files: DataFrame, templates, threshold: float) -> DataFrame:
    """`(path, own_licence, own_score)` of the files that state a licence."""
    spark = files.sparkSession
    known = sorted({t for _, body in templates for t in template_terms(body)})
    counts, total = term_counts(files, "text"), files.count()
    # At most a row per template term.
    seen = {r["term"]: r["n"] for r in counts.filter(F.col("term").isin(known)).collect()}
    vectors = template_vectors(seen, total, templates)
    weights = {t: term_weight(seen.get(t, 0), total) for t in known}
    parts = licence_parts(files, vectors, weights, threshold)
    terms = parts.select("path", "of", "n", F.explode(_terms(F.col("part"))).alias("term")).filter(F.col("term") != "")
    counted = materialize(terms.groupBy("path", "of", "n", "term").agg(F.count("*").alias("tf")), "part-terms")
    idf = F.log((F.lit(total) + 1) / (F.col("files") + 1)) + 1
    # A row per template term, with its share of each template's unit vector.
    shares = spark.createDataFrame(
        [(t, [vector.get(t, 0.0) for _, vector in vectors]) for t in known], "term string, shares array<double>"
    )
    weighted = counted.join(counts.withColumnRenamed("n", "files"), "term").join(F.broadcast(shares), "term", "left").withColumn(
        "w", F.col("tf") * idf
    )
    sums = weighted.groupBy("path", "of", "n").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"),
        *[F.sum(F.col("w") * F.coalesce(F.get("shares", F.lit(i)), F.lit(0.0))).alias(f"dot{i}") for i in range(len(vectors))],
    )
    by_template = F.array(*[
        F.struct(F.lit(name).alias("licence"), F.round(F.col(f"dot{i}") / F.col("size"), 6).alias("score"))
        for i, (name, _) in enumerate(vectors)
    ])
    scored = sums.select("path", F.explode(by_template).alias("found")).select("path", "found.*").filter(
        F.col("score") >= threshold
    )
    names = F.array(*[F.lit(n) for n in sorted({n for n, _ in templates})])
    tags = F.regexp_extract_all("text", F.lit(SPDX), F.lit(1))
    tagged = files.filter(F.col("text").rlike(SPDX)).select("path", F.explode(tags).alias("tag")).select(
        "path", F.get(F.filter(names, lambda n: F.lower(n) == F.lower(F.col("tag"))), F.lit(0)).alias("licence"), F.lit(1.0).alias("score")
    ).filter(F.col("licence").isNotNull())
    best = F.min(F.struct((-F.col("score")).alias("order"), "licence"))
    return scored.unionByName(tagged).groupBy("path").agg(best.alias("best")).select(
        "path", F.col("best.licence").alias("own_licence"), (-F.col("best.order")).alias("own_score")
    )


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan_licences(
    files: DataFrame, path: str = "path", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Add `own_licence, own_score, licence, inherited_from`; the last is null for a file's own licence."""
    results = ("own_licence", "own_score", "licence", "inherited_from")
    files = files.drop(*results)
    columns = files.select(
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    own = materialize(_notices(columns, templates, threshold), "notices")
    speaking = own.filter(F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENCE_FILE))
    by_directory = speaking.groupBy(_directory(F.col("path")).alias("above")).agg(
        F.min(F.struct("path", "own_licence")).alias("file")
    ).select("above", F.col("file.own_licence").alias("given"))
    # Directories, not files, look upwards: every directory once, with each directory above it.
    directories = columns.select(_directory(F.col("path")).alias("directory")).distinct()
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    upwards = directories.select("directory", F.explode(F.array_union(above, F.array(F.lit("")))).alias("above"))
    nearest = upwards.join(by_directory, "above").groupBy("directory").agg(
        F.max(F.struct(F.length("above").alias("depth"), "above", "given")).alias("at")
    ).select("directory", F.col("at.above").alias("from_directory"), F.col("at.given").alias("given"))

    keyed = files.withColumn("__path", F.coalesce(F.col(path).cast("string"), F.lit("")))
    keyed = keyed.withColumn("__directory", _directory(F.col("__path")))
    found = keyed.join(own.withColumnRenamed("path", "__path"), "__path", "left").join(
        nearest.withColumnRenamed("directory", "__directory"), "__directory", "left"
    )
    return found.select(
        *[F.col(f"`{c}`") for c in files.columns], "own_licence", "own_score",
        F.coalesce("own_licence", "given").alias("licence"),
        F.when(F.col("own_licence").isNull(), F.col("from_directory")).alias("inherited_from"),
    )
