import random

from pyspark.sql import functions as F

from docquery.functions.chunking import (
    add_overlap, markdown_sections, parent_child_chunks, plain_chunks, recursive_split,
)

MD = "# Doc\n\nintro line\n\n## Alpha\n\nalpha body text\n\n## Beta\n\nbeta body text"


def expected_pieces(text, separators, size):
    """Definition by brute force: longest run of parts that fits, else the part alone, cut finer."""
    if len(text) <= size:
        return [text]
    if not separators:
        return [text[i : i + size] for i in range(0, len(text), size)]
    sep, finer = separators[0], separators[1:]
    parts, out, i = text.split(sep), [], 0
    while i < len(parts):
        if parts[i] == "":
            i += 1
            continue
        if len(parts[i]) > size:
            out += expected_pieces(parts[i], finer, size)
            i += 1
            continue
        j = i + 1
        while j < len(parts) and len(sep.join(parts[i : j + 1])) <= size:
            j += 1
        out.append(sep.join(parts[i:j]))
        i = j
    return out


def expected_sections(text):
    import re

    rows, found = text.splitlines(), []
    starts = [i for i, row in enumerate(rows) if re.match(r"#{1,6}\s", row)]
    for at, until in zip([0, *starts], [*starts, len(rows)]):
        body = "\n".join(rows[at:until]).strip()
        title = rows[at].lstrip("#").strip() if at in starts and at < until else "(intro)"
        if body:
            found.append((title, body))
    return found


def texts(seed, n):
    rng = random.Random(seed)
    bits = ["a", "bé", "\n", "\n\n", "\n\n\n", ". ", " ", "word", "..", "# h\n", "## T x\n", "\n# y z", "\r\n", "  "]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_split_cases(one):
    split = lambda size: lambda t: recursive_split(t, size)
    assert one(split(100), "short text") == ["short text"]
    assert one(split(12), "para one.\n\npara two.\n\npara three.") == ["para one.", "para two.", "para three."]
    assert [len(p) for p in one(split(10), "x" * 25)] == [10, 10, 5]
    pieces = one(split(10), "a" * 30)
    assert all(len(p) <= 10 for p in pieces) and "".join(pieces) == "a" * 30


def test_split_against_brute_force(spark):
    rows = list(enumerate(texts(3, 250)))
    frame = spark.createDataFrame(rows, "i int, t string")
    for size in (1, 3, 7, 20):
        got = {r.i: r.p for r in frame.select("i", recursive_split(F.col("t"), size).alias("p")).collect()}
        for i, text in rows:
            assert got[i] == expected_pieces(text, ["\n\n", "\n", ". ", " "], size), (size, text)
            assert all(len(p) <= size for p in got[i])


def test_sections_against_brute_force(spark):
    rows = list(enumerate(texts(5, 250)))
    frame = spark.createDataFrame(rows, "i int, t string")
    for r in frame.select("i", markdown_sections(F.col("t")).alias("s")).collect():
        assert [tuple(s) for s in r.s] == expected_sections(rows[r.i][1]), rows[r.i][1]


def test_overlap(one):
    parts = lambda n: lambda t: add_overlap(F.split(t, "/"), n)
    assert one(parts(3), "abcdef/ghijkl") == ["abcdef", "def ghijkl"]
    assert one(parts(3), "only") == ["only"]
    assert one(parts(0), "abc/def") == ["abc", "def"]


def test_plain_chunks(one):
    assert one(plain_chunks, "") == []
    assert one(plain_chunks, "   \n  ") == []
    assert one(plain_chunks, " a single short paragraph ") == ["a single short paragraph"]
    chunks = one(plain_chunks, " ".join(f"Sentence number {i}." for i in range(400)))
    assert len(chunks) > 1 and all(len(c) <= 800 + 120 + 1 for c in chunks)


def test_sections_and_children(one):
    sections = one(markdown_sections, MD)
    assert [s.title for s in sections] == ["Doc", "Alpha", "Beta"]
    assert sections[1].body.startswith("## Alpha")
    units = one(parent_child_chunks, MD)
    beta = next(u for u in units if u.title == "Beta")
    assert "beta body text" in beta.child and "beta body text" in beta.parent
    plain = one(parent_child_chunks, "just some text with no markdown headings at all")
    assert len(plain) == 1 and plain[0].child == plain[0].parent and plain[0].title == "(document)"
    assert one(parent_child_chunks, "# only one\nbody")[0].title == "(document)"
    assert [u.title for u in one(parent_child_chunks, "intro\n# one\nbody")] == ["(intro)", "one"]
    assert one(parent_child_chunks, "hash # inside")[0].title == "(document)"


def test_zero_child_size_means_default(one):
    long_section = "# a\n" + "word " * 200 + "\n# b\nx"
    assert one(lambda t: parent_child_chunks(t, 0), long_section) == one(parent_child_chunks, long_section)
