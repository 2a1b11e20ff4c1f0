"""Phrases of two to four words that belong together, per language, from exact counts.

Phrases are counted in two passes over the texts. The first counts words and pairs, the second longer
sequences, but only those all of whose pairs are frequent, as no other can be. A table of bits of fixed
size says which pairs are; a pair it names wrongly costs work, not correctness. In each task a trie with
hash containers (`hattrie`) counts the sequences; when it holds too many, its largest subtrees leave as
sorted runs. Runs are dealt out by their whole prefix path, the phrase, so that a very common first word
does not gather in one partition, and are merged there.

Defined cases: a null text is empty; a null language is `und`; a text without words gives nothing; only
A-Z are lower-cased; equal documents count each; a language with no phrase that occurs often enough
has no rows; a table without rows gives none; a text is worked on whole, whatever its length; only the
columns named are used.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.llm.hattrie import HatTrie
from docquery.llm.words import bytes_table, mapped, raw_texts, runs, slices
from docquery.shared import hot_keys, join_around_hot, materialize

LEAST, LONGEST, TOP = 30, 4, 2000
# A phrase goes if a longer one has at least 4/5 of its occurrences.
COVERED = 4, 5
# Sequences that a task's tries may hold, and of a batch of rows that leaves it.
MOST_ENTRIES, BATCH_ROWS = 1_000_000, 100_000
_RANK_WAYS = 16
# The table of frequent pairs has 2 ** 27 bits: 16 MB, whatever the corpus.
FILTER_BITS = 27

_GAP, _BREAK = 1, 2
_KINDS = (bytes_table(" \t") * _GAP + bytes_table(".,;:!?\n\v\f\r") * _BREAK).astype(np.uint8).tobytes()
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_RUNS = "lang string, words int, phrase string, n long"


class _Words:
    """The words of a slice of texts: the `index` of each in `distinct`, its `text`, whether the next is `joined` to it."""

    def __init__(self, texts: pa.Array):
        data, bounds = raw_texts(texts)
        data = mapped(data, _LOWER)
        kind = mapped(data, _KINDS)
        first = np.zeros(len(data), bool)
        first[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts, found = runs(data, kind == 0, first)
        self.index, self.distinct = found.indices.to_numpy(), found.dictionary
        piece = np.searchsorted(np.flatnonzero(kind == _BREAK), starts)
        text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, bounds)))
        joined = np.zeros(len(starts), bool)
        if len(starts):
            joined[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.text, self.joined = text, joined


def _follow(joined: np.ndarray, most: int) -> np.ndarray:
    """How many links of a chain begin at each place, up to `most`."""
    follow = np.zeros(len(joined), np.int8)
    chain = joined
    for _ in range(most):
        follow += chain
        # A chain of n links is a link with a chain of n - 1 behind it.
        chain = joined & np.append(chain[1:], False)
    return follow


def _bits(words: np.ndarray, lang: np.ndarray | int) -> np.ndarray:
    """The places in the table of bits of the pairs of successive word hashes."""
    mixed = (words[:-1] * _MIX[0] + words[1:]) * _MIX[1] ^ lang
    mixed ^= mixed >> np.uint64(31)
    return (mixed * _MIX[0]) >> np.uint64(64 - FILTER_BITS)


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


class _Tries:
    """A trie for each language, with the words' numbers."""

    def __init__(self, width: int, depths: tuple[int, ...]):
        self.width, self.depths = width, depths
        self.tries: dict[str, HatTrie] = {}
        self.numbers: dict[str, dict[bytes, int]] = {}

    def add(self, lang: str, words: _Words, at: np.ndarray, follow: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count the sequences that begin `at` these words, with as many behind them as `follow` says."""
        trie = self.tries.setdefault(lang, HatTrie(self.width))
        most = (1 << trie.bits) - 1
        step = most // self.width
        for i in range(0, len(at), step):
            begin, behind = at[i : i + step], follow[i : i + step]
            used = np.zeros(len(words.distinct), bool)
            for j in range(self.width):
                used[words.index[begin[behind >= j] + j]] = True
            chosen = np.flatnonzero(used)
            numbers = self.numbers.setdefault(lang, {})
            names = words.distinct.take(pa.array(chosen)).to_pylist()
            if len(numbers) + len(names) > most:
                yield from self._left(lang, 0)
                numbers.clear()
            for name in names:
                if name not in numbers:
                    numbers[name] = len(numbers) + 1
            number = np.zeros(len(used), np.uint64)
            number[chosen] = [numbers[name] for name in names]
            columns = [
                np.where(behind >= j, number[words.index[np.minimum(begin + j, len(words.index) - 1)]], 0)
                for j in range(self.width)
            ]
            trie.add(trie.pack(columns))
        while sum(t.entries for t in self.tries.values()) > MOST_ENTRIES:
            largest = max(self.tries, key=lambda name: self.tries[name].entries)
            yield from self._left(largest, self.tries[largest].entries // 2)
        if sum(map(len, self.numbers.values())) > MOST_ENTRIES:
            yield from self.all()

    def all(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.tries):
            yield from self._left(lang, 0)
        self.tries.clear()
        self.numbers.clear()

    def _left(self, lang: str, most: int) -> Iterator[pa.RecordBatch]:
        """The counts of the subtrees that leave, shortest sequences first."""
        trie = self.tries[lang]
        names = pa.array([b"", *self.numbers.get(lang, {})], pa.binary())
        for keys, counts in trie.spill(most):
            for depth in self.depths:
                heads, sums = trie.prefixes(keys, counts, depth)
                for i in range(0, len(heads), BATCH_ROWS):
                    part = heads[i : i + BATCH_ROWS]
                    said = [names.take(pa.array(trie.word(part, d).astype(np.int64))) for d in range(depth)]
                    phrase = pc.binary_join_element_wise(*said, b" ") if depth > 1 else said[0]
                    yield _counted(lang, depth, phrase.cast(pa.string()), sums[i : i + BATCH_ROWS])


def _counted(lang: str, words: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), words, np.int32)), phrase,
            pa.array(n, pa.int64()),
        ],
        names=["lang", "words", "phrase", "n"],
    )


def _by_lang(rows: pa.RecordBatch, words: _Words) -> Iterator[tuple[str, np.ndarray]]:
    """The places of the words of each language in a slice."""
    langs = rows.column(0).dictionary_encode()
    of_word = langs.indices.to_numpy()[words.text]
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        at = np.flatnonzero(of_word == i)
        if len(at):
            yield lang, at


def _short_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and pairs of `(lang, text)`, and of all words, as those of the empty phrase."""
    tries, totals = _Tries(2, (1, 2)), {}
    for batch in batches:
        for rows in slices(batch, 1):
            words = _Words(rows.column(1))
            follow = words.joined.astype(np.int8)
            for lang, at in _by_lang(rows, words):
                totals[lang] = totals.get(lang, 0) + len(at)
                yield from tries.add(lang, words, at, follow[at])
    yield from tries.all()
    for lang, n in totals.items():
        yield _counted(lang, 0, pa.array([""]), np.array([n]))


def _long_runs(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    """Counts of the sequences of three words and more whose pairs are all in the table `frequent`."""
    tries = _Tries(longest, tuple(range(3, longest + 1)))
    for batch in batches:
        for rows in slices(batch, 1):
            words = _Words(rows.column(1))
            if len(words.index) < 3:
                continue
            known = words.distinct.to_pylist()
            hashes = np.fromiter(map(_hash, known), np.uint64, len(known))[words.index]
            for lang, at in _by_lang(rows, words):
                own = np.zeros(len(words.index), bool)
                own[at] = True
                place = _bits(hashes, np.uint64(_hash(lang.encode())))
                hit = np.zeros(len(own), bool)
                hit[:-1] = (frequent[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0
                follow = _follow(hit & words.joined & own, longest - 1)
                at = np.flatnonzero(follow >= 2)
                yield from tries.add(lang, words, at, follow[at])
    yield from tries.all()


def _pair_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.zeros(len(batch), np.uint64)
        for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            pair = np.array([_hash(w.encode()) for w in phrase.split(" ")], np.uint64)
            places[i] = _bits(pair, np.uint64(_hash(lang.encode())))[0]
        bits = np.uint64(1) << (places & np.uint64(63))
        yield pa.RecordBatch.from_arrays(
            [pa.array((places >> np.uint64(6)).astype(np.int64)), pa.array(bits.view(np.int64))], names=["at", "bits"]
        )


def _merged(runs_: DataFrame) -> DataFrame:
    return runs_.repartition("lang", "phrase").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """The stored `(lang, words, phrase, n)` of all phrases that occur `least` times or more.

    The empty phrase has the number of all words of its language, whatever that is.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")
    )
    enough = (F.col("words") == 0) | (F.col("n") >= least)
    short = materialize(_merged(rows.mapInArrow(_short_runs, _RUNS)).filter(enough), "short-phrases")
    if longest < 3:
        return short
    bits = short.filter("words = 2").select("lang", "phrase").mapInArrow(_pair_bits, "at long, bits long")
    # At most 2 ** (FILTER_BITS - 6) rows.
    found = bits.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    frequent = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    frequent[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(frequent)
    long = _merged(rows.mapInArrow(lambda b: _long_runs(b, shared.value, longest), _RUNS)).filter(enough)
    return short.unionByName(materialize(long, "long-phrases"))


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _key(lang: str, phrase: Column) -> Column:
    """One column for both: no phrase holds a line break."""
    return F.concat(phrase, F.lit("\n"), F.col(lang))


def uncovered(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """The phrases of two words and more without a longer one that has nearly all of their occurrences."""
    phrases = counts.filter("words >= 2").withColumn("key", _key("lang", F.col("phrase")))
    split = F.split("phrase", " ")
    inner = F.array(*[
        F.when(F.col("words") >= size + first, F.array_join(F.slice(split, first + 1, size), " "))
        for size in range(2, longest) for first in range(longest - size + 1)
    ])
    # A phrase is not inside itself.
    inside = phrases.filter("words >= 3").select("lang", "phrase", "n", F.explode(F.array_compact(inner)).alias("inner"))
    covering = inside.filter("inner <> phrase").select(_key("lang", F.col("inner")).alias("key"), "n").groupBy("key").agg(
        F.max("n").alias("longer")
    )
    share, whole = COVERED
    covered = F.col("longer").isNotNull() & (whole * _exact(F.col("longer")) >= share * _exact(F.col("n")))
    return phrases.join(covering, "key", "left").filter(~covered).drop("longer", "key")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """`(lang, rank, phrase, a, l, r, n, score)`: the `top` phrases of each language.

    A phrase cut after its first words scores 2,000,000 times its count over the sum of the counts
    of both parts; the cut with the lowest score counts.
    """
    counts = phrase_counts(docs, lang, text, least, longest)
    kept = uncovered(counts, longest).select("lang", "phrase", "words", F.col("n").alias("a"))
    split = F.split("phrase", " ")
    parts = [
        F.when(F.col("words") > cut, F.struct(
            F.lit(cut).alias("cut"), F.lit(side).alias("side"), F.array_join(F.slice(split, *span), " ").alias("part")
        ))
        for cut in range(1, longest) for side, span in (("l", (1, cut)), ("r", (cut + 1, longest)))
    ]
    cuts = kept.select("lang", "phrase", "a", F.explode(F.array_compact(F.array(*parts))).alias("p")).select(
        "lang", "phrase", "a", "p.cut", "p.side", _key("lang", F.col("p.part")).alias("key")
    )
    # Stored, so that the join has a plain shuffle and can split the rows of a very common word.
    cuts = materialize(cuts, "cuts")
    known = counts.filter("words > 0").select(_key("lang", F.col("phrase")).alias("key"), F.col("n").alias("m"))
    hot = hot_keys(cuts.groupBy("key").agg(F.count("*").alias("n")), "key")
    joined = join_around_hot(cuts, known, "key", hot)

    def side(cut: int, name: str) -> Column:
        return F.max(F.when((F.col("cut") == cut) & (F.col("side") == name), F.col("m"))).alias(f"{name}{cut}")

    sides = joined.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), *[side(cut, name) for cut in range(1, longest) for name in ("l", "r")]
    )
    scored = [
        F.when(F.col(f"l{cut}").isNotNull(), F.struct(
            F.expr(f"(2000000 * cast(a as decimal(38,0))) div cast(l{cut} + r{cut} as decimal(38,0))").alias("score"),
            F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r"),
        ))
        for cut in range(1, longest)
    ]
    lowest = sides.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*scored))).alias("low")).select(
        "lang", "phrase", "a", "low.l", "low.r", "low.score"
    )
    # In two steps, so that no task ranks more than `top` phrases for each of `_RANK_WAYS`.
    best_first = F.desc("score"), F.desc("a"), "phrase"
    way = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_WAYS))
    some = lowest.withColumn("way", way).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "way").orderBy(*best_first))
    ).filter(F.col("place") <= top).drop("way", "place")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))
    best = some.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", F.col("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
