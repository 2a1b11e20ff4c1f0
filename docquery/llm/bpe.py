"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

For each prefix of a piece there is one token that ends its encoding. An automaton reports every
token that ends at a position; the one that may follow the last token of the prefix before it is
stored, and following these back from the end gives the ids. Two tokens may stand side by side
unless some merge across their border would have come before the merges that built them.

Defined cases: null texts are empty and have no ids; special tokens in a text become their ids, as
the vocabulary file says; repeated rows are encoded alike; a table without rows gives none; texts
of any length are encoded whole, in time linear in their length; columns other than key and text
are not carried.
"""
from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.memory import Recent, received, remembered, send

_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed pattern: how byte-level vocabularies of this family cut a text into pieces.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
_OTHER_WHITE = [c for c in map(chr, range(0x3001)) if c not in " \n" and re.fullmatch(f"[{_WHITE}]", c)]# Entries of a worker's memories of words and of pairs of tokens.
MOST_REMEMBERED = 250_000


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tables:
    """What a vocabulary file says, in a form that is small to send to tasks."""

    def __init__(self, file: dict):
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        model = file["model"]
        ids = model["vocab"]
        self.tokens = {i: as_bytes(t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = ids[left], ids[right], ids[left + right]
            self.merges.setdefault((a, b), (rank, made))
            self.parts.setdefault(made, (rank, a, b))
        by_byte = {t: i for i, t in self.tokens.items() if len(t) == 1}
        self.reachable = {i for i in ids.values() if self._merged(i, by_byte)}
        self.tokens.update({i: t.encode() for t, i in self.special.items()})

    def _merged(self, token: int, by_byte: dict[bytes, int]) -> bool:
        """Whether merging the bytes of a token, lowest rank and leftmost first, ends in the token."""
        row = [by_byte[bytes([b])] for b in self.tokens[token]]
        while len(row) > 1:
            ranked = [(self.merges.get(pair, (1 << 60, 0))[0], i) for i, pair in enumerate(zip(row, row[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                return False
            row[i : i + 2] = [self.merges[row[i], row[i + 1]][1]]
        return row == [token]


def load_tables(path: str) -> Tables:
    """Read a byte-level vocabulary file on the driver; its size bounds what is sent to tasks."""
    with open(path, encoding="utf-8") as file:
        return Tables(json.load(file))


class Encoder:
    def __init__(self, tables: Tables):
        self.tables = tables
        self.automaton = ahocorasick.Automaton()
        for token in tables.reachable:
            self.automaton.add_word(tables.tokens[token].decode("latin-1"), (token, len(tables.tokens[token])))
        self.automaton.make_automaton()
        self.pieces = regex.compile(PIECES)
        special = sorted(tables.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.pairs = Recent(MOST_REMEMBERED, self.may_follow)
        self.words = Recent(MOST_REMEMBERED, self.piece)
        self.chunks = Recent(MOST_REMEMBERED, lambda word: self.chunk(" " + word))

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts of a token at one of its ends, each with the rank of the merge that took it in."""
        found = self.spines.get((token, side))
        if found is None:
            found, at, until = [], token, float("inf")
            while True:
                found.append((at, until))
                if at not in self.tables.parts:
                    break
                rank, *halves = self.tables.parts[at]
                at, until = halves[side], rank
            self.spines[token, side] = found
        return found

    def may_follow(self, pair: tuple[int, int]) -> bool:
        """Whether the second token can stand after the first in an encoding.

        A merge of equal rank is done from left to right: one that takes in the right end of the
        first token from inside comes before one across the border, and that before one inside
        the second.
        """
        merges = self.tables.merges
        for a, until_a in self._spine(pair[0], 1):
            for b, until_b in self._spine(pair[1], 0):
                merge = merges.get((a, b))
                if merge is not None and merge[0] < until_a and merge[0] <= until_b:
                    return False
        return True

    def piece(self, text: str) -> bytes:
        """Ids of one piece, as little-endian unsigned 32-bit integers."""
        letters = text.encode().decode("latin-1")
        last: list[tuple[int, int] | None] = [None] * (len(letters) + 1)
        pairs = self.pairs
        for end, (token, length) in self.automaton.iter(letters):
            end += 1
            if last[end] is None:
                before = end - length
                if before:
                    left = last[before]
                    if left is None:
                        continue
                    if not pairs[left[0], token]:
                        continue
                last[end] = (token, before)
        ids, at = [], len(letters)
        while at:
            token, at = last[at]
            ids.append(token)
        ids.reverse()
        return array("I", ids).tobytes()

    def chunk(self, text: str) -> bytes:
        words = self.words
        return b"".join([words[piece] for piece in self.pieces.findall(text)])

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        No piece crosses a single space between two visible characters, so such texts are looked
        up by what stands between spaces.
        """
        if not text:
            return b""
        if (
            "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " "
            or any(c in text for c in _OTHER_WHITE)
        ):
            return self.chunk(text)
        first, *rest = text.split(" ")
        chunks = self.chunks
        return b"".join([self.chunk(first), *[chunks[word] for word in rest]])

    def encode(self, text: str) -> bytes:
        if self.special is None or not any(s in text for s in self.tables.special):
            return self.plain(text)
        special = self.tables.special
        return b"".join(
            special[part].to_bytes(4, "little") if i % 2 else self.plain(part)
            for i, part in enumerate(self.special.split(text))
        )

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.tables.tokens.__getitem__, memoryview(ids).cast("I"))).decode(errors="replace")


def _coded(batches: Iterator[pa.RecordBatch], path: str, tables: Broadcast) -> Iterator[pa.RecordBatch]:
    encoder = remembered(("bytes", path), lambda: Encoder(received(tables)))
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            ids = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
            arrays = [part.column(0), pa.array(ids, pa.binary()), pa.array(map(encoder.decode, ids), pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "ids", "decoded"])


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, ids, decoded)`: ids as little-endian unsigned 32-bit integers, and the text they decode to."""
    columns = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    sent = send(docs.sparkSession, load_tables(path))
    kind = columns.schema["key"].dataType.simpleString()
    coded = columns.mapInArrow(lambda b: _coded(b, path, sent), f"key {kind}, ids binary, decoded string")
    return coded.withColumnRenamed("key", key)
