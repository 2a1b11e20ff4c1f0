import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from docquery.llm import collocations, queries
from docquery.llm.hattrie import HatTrie
from docquery.llm.oracles import SQL
from docquery.plans.check import connect, duckdb_rows, spark_rows

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counts_of(rows, longest):
    """Brute force: all counts of the `(lang, text)` by language and number of words."""
    found, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or ("und" if lang is None else "")] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    found["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    return found, totals


def phrases_of(rows, least, longest=4, top=2000):
    wanted = []
    found, totals = counts_of(rows, longest)
    for lang, counts in found.items():
        frequent = {p: n for p, n in counts.items() if n >= least}
        candidates = {p: n for p, n in frequent.items() if len(p) > 1}
        scored = []
        for phrase, a in candidates.items():
            inside = [
                n for other, n in candidates.items() if len(other) > len(phrase)
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
            ]
            if any(100 * n >= 80 * a for n in inside):
                continue
            low = min((2_000_000 * a // (counts[phrase[:k]] + counts[phrase[k:]]), k) for k in range(1, len(phrase)))
            scored.append((-low[0], -a, " ".join(phrase).encode(), counts[phrase[: low[1]]], counts[phrase[low[1] :]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            wanted.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(wanted)


def some_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["of", "the", "The", "é", "É", "a-b", "x" * 40, "\x1f", "漢字", "to"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "! "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "fr", None, ""]), rng.choice([text, text, text + "big data set ", None])))
    return rows + [("en", "one two three four. " * 500), ("de", "word " * 3000), ("fr", ""), ("nl", " \t\n")]


@pytest.mark.parametrize("seed,least,longest,top", [(0, 5, 4, 2000), (1, 3, 4, 20), (2, 1, 3, 50), (3, 2, 2, 7), (4, 1, 5, 3000)])
def test_phrases_equal_brute_force(spark, seed, least, longest, top):
    rows = some_rows(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string").repartition(5)
    got = collocations.collocations(docs, least=least, longest=longest, top=top)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == phrases_of(rows, least, longest, top)


def test_tries_that_spill(spark, monkeypatch):
    """Small tries and small batches leave in many runs; the counts are the same."""
    rows = some_rows(7)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    monkeypatch.setattr(collocations, "MOST_ENTRIES", 40)
    monkeypatch.setattr(collocations, "BATCH_ROWS", 3)
    # Functions travel by value, with the names they use at that time.
    got = collocations.collocations(docs, least=4)
    assert sorted(map(tuple, got.collect())) == phrases_of(rows, 4)


@pytest.mark.parametrize("width", [2, 4])
def test_trie_counts(width):
    rng = np.random.default_rng(width)
    trie, wanted = HatTrie(width, burst=10), Counter()
    spilled, nodes = Counter(), 0
    for step in range(30):
        words = [rng.zipf(1.5, 200).clip(1, 50).astype(np.uint64)]
        for _ in range(width - 1):
            words.append(np.where(words[-1] > 0, rng.integers(0, 40, 200), 0).astype(np.uint64))
        wanted.update(zip(*(w.tolist() for w in words)))
        trie.add(trie.pack(words))
        assert trie.entries <= len(wanted)
        nodes += sum(hasattr(c, "children") for c in trie.root.children)
        if step % 7 == 6:
            for keys, counts in trie.spill(trie.entries // 2):
                assert (np.diff(keys.astype(object)) > 0).all()
                rows = zip(*(trie.word(keys, d).tolist() for d in range(width)))
                spilled.update(dict(zip(rows, counts.tolist())))
    assert nodes, "no container became a node"
    for keys, counts in trie.spill(0):
        for depth in range(1, width + 1):
            heads, sums = trie.prefixes(keys, counts, depth)
            assert sums.sum() == counts[trie.word(keys, depth - 1) > 0].sum() and len(set(heads.tolist())) == len(heads)
        spilled.update(dict(zip(zip(*(trie.word(keys, d).tolist() for d in range(width))), counts.tolist())))
    assert spilled == wanted and trie.entries == 0


def test_large_counts(spark):
    """Products beyond 64 bits."""
    big = 8_000_000_000_000_000
    rows = [
        ("x", 0, "", 3 * big), ("x", 1, "a", big), ("x", 1, "b", big), ("x", 2, "a b", big - 1),
        ("x", 3, "a b c", (big - 1) * 4 // 5 - 1), ("x", 1, "c", big), ("x", 2, "b c", big // 2),
    ]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    kept = {r["phrase"] for r in collocations.uncovered(counts).collect()}
    assert kept == {"a b", "a b c"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0


@pytest.mark.parametrize("name", ["op12_phrases", "op13_prefix_trie"])
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = connect(folder)
    assert spark_rows(queries.QUERIES[name](spark, folder)) == duckdb_rows(con, SQL[name])
