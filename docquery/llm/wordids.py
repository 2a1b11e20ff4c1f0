"""Token ids of whole texts for a vocabulary whose tokens never cross white space.

A slice of texts is cut at once, with array operations, into parts that the vocabulary's own
pattern is sure to cut as well: at ASCII white space, and between ASCII letters, digits and
symbols. Each distinct part of the slice is encoded by the library once and remembered; the
ids of the texts are then gathered from the parts'. Texts that hold a special token's string are
encoded whole. The rules hold for one normaliser and one pattern, so a vocabulary file with
others is refused when it is loaded.
"""
from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docquery.llm.memory import remembered
from docquery.llm.words import bytes_table, mapped, raw_texts, runs

# Bytes that a worker's memory of parts may take before it keeps only those of the present slice.
MEMORY_BYTES = 64 << 20
_ENTRY_BYTES = 150

# What the file must say for the cuts to be right (fixed values).
_NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# What a byte is: nothing is cut beside apostrophes (0), which begin contractions.
_LETTER, _SYMBOL, _DIGIT, _CAPITAL, _SPACE = 1, 2, 3, 4 | 1, 8
_KINDS = (
    bytes_table(_LETTERS[26:]) * _LETTER + bytes_table(_LETTERS[:26]) * _CAPITAL
    + bytes_table("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~") * _SYMBOL + bytes_table("0123456789") * _DIGIT
    + bytes_table(" \t\n\v\f\r") * _SPACE
).astype(np.uint8).tobytes()
# The letters in which byte-level vocabularies write bytes: printable ones stand for themselves.
_OWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _OWN)}
# Letters up to here have been letters in all versions of Unicode at hand.
_LAST_LATIN = "\u024f"


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths


def check_vocabulary(path: str) -> None:
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    normalizer, cut = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
    split = (cut.get("pretokenizers") or [{}])[0]
    known = (
        normalizer.get("normalizers") == _NORMALIZERS
        and split.get("type") == "Split" and split.get("pattern") == {"Regex": _PATTERN}
        and all(not t["lstrip"] and not t["rstrip"] for t in said.get("added_tokens", []))
    )
    if not known:
        raise ValueError(f"{path}: words of this vocabulary cannot be encoded one by one")


class WordIds:
    """An encoder with a memory of bounded size, for one worker process."""

    def __init__(self, path: str):
        # A task has one core; the library's threads would only get in the way of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        check_vocabulary(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.places: dict[bytes, int] = {}
        self.bounds = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.bytes = 0

    def _keep(self, parts: list[bytes]) -> None:
        """Forget all but `parts`."""
        places = np.fromiter(map(self.places.__getitem__, parts), np.int64, len(parts))
        self.ids, ends = self._gathered(places)
        self.bounds, self.places, self.bytes = ends, {}, 0
        self._remember(parts, len(self.ids))

    def _remember(self, parts: list[bytes], ids: int) -> None:
        n = len(self.places)
        self.places.update(zip(parts, range(n, n + len(parts))))
        self.bytes += sum(map(len, parts)) + 4 * ids + _ENTRY_BYTES * len(parts)

    def _gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts at `places`, one after the other, and their bounds."""
        lengths = self.bounds[places + 1] - self.bounds[places]
        ends = np.zeros(len(places) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        at = np.repeat(self.bounds[places] - ends[:-1], lengths) + np.arange(ends[-1])
        return self.ids[at], ends

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _of_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts. A run of letters is one word of the pattern and goes to the merges at once."""
        found: list[list[int]] = []
        model, normal, others = self.tokenizer.model, self.tokenizer.normalizer.normalize_str, []
        for i, part in enumerate(parts):
            word = part.decode().lower() if part.isalpha() else ""
            if not word and not part.isascii():
                plain = normal(part.decode())
                if plain.isalpha() and max(plain) <= _LAST_LATIN:
                    word = plain.encode().decode("latin-1").translate(_BYTE_LETTERS)
            if word:
                found.append([t.id for t in model.tokenize(word)])
            else:
                others.append(i)
                found.append([])
        texts = [parts[i].decode() for i in others]
        for i, encoded in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found[i] = encoded.ids
        return _flat(found)

    def _learn(self, parts: list[bytes]) -> np.ndarray:
        """The place in the memory of each part."""
        if self.bytes > MEMORY_BYTES:
            self._keep([p for p in parts if p in self.places])
        new = [p for p in parts if p not in self.places]
        if new:
            ids, lengths = self._of_parts(new)
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])
            self.ids = np.concatenate([self.ids, ids])
            self._remember(new, len(ids))
        return np.fromiter(map(self.places.__getitem__, parts), np.int64, len(parts))

    def encode(self, texts: pa.Array, closing: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the bounds of each text's; `closing` ends each text."""
        data, bounds = raw_texts(texts)
        odd = np.zeros(len(texts), bool)
        for string in self.special:
            odd |= pc.match_substring(texts, string).fill_null(False).to_numpy(zero_copy_only=False)
        kind = mapped(data, _KINDS)
        inside, first = kind != _SPACE, np.zeros(len(data), bool)
        if len(data):
            # A capital before a combining mark is left to the library.
            capital = kind == _CAPITAL
            capital[:-1] &= data[1:] < 128
            data = data + (capital.view(np.uint8) << 5)
            kind = kind & 3
            after, before = kind[1:], kind[:-1]
            first[1:] = ((after != before) & (after > 0) & (before > 0)) | ((after == _DIGIT) & (before == _DIGIT))
        for i in np.flatnonzero(odd):
            inside[bounds[i] : bounds[i + 1]] = False
        first[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts, parts = runs(data, inside, first)
        places = self._learn(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        ids, ends = self._gathered(places)
        limits = ends[np.searchsorted(starts, bounds)]
        if odd.any() or closing is not None:
            ids, limits = self._completed(texts, odd, ids, limits, closing)
        return ids, limits

    def _completed(
        self, texts: pa.Array, odd: np.ndarray, ids: np.ndarray, limits: np.ndarray, closing: int | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Insert the ids of the texts that were left out, and the closing id of each text."""
        extra, lengths = self._encoded(texts.filter(pa.array(odd)).to_pylist())
        rows, values = np.repeat(np.flatnonzero(odd), lengths), extra
        if closing is not None:
            rows = np.append(rows, np.arange(len(texts)))
            values = np.append(values, np.full(len(texts), closing, np.uint32))
            order = np.argsort(rows, kind="stable")
            rows, values = rows[order], values[order]
        added = np.bincount(rows, minlength=len(texts))
        return np.insert(ids, limits[1:][rows], values), limits + np.append(0, np.cumsum(added))


def word_ids(path: str) -> WordIds:
    return remembered(("word ids", path), lambda: WordIds(path))
