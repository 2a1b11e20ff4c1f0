"""Words of whole batches of texts at once, as dictionary-encoded arrays."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 2 << 20


def bytes_table(chars: str) -> np.ndarray:
    """Which of the 256 bytes are among some ASCII characters."""
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


def mapped(data: np.ndarray, table: bytes) -> np.ndarray:
    """Each byte of `data` replaced by what a table of 256 bytes has for it."""
    return np.frombuffer(data.tobytes().translate(table), np.uint8)


def raw_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the bounds of each text in them; a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, of at most `SLICE_BYTES` bytes of text unless it is one row."""
    _, bounds = raw_texts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def runs(data: np.ndarray, inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Starts of the runs of `inside` bytes, cut before each byte of `first`, and the runs themselves."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), pa.array([], pa.binary()).dictionary_encode()
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    ends = np.ones(n, bool)
    ends[:-1] = ~inside[1:] | begins[1:]
    lengths = np.flatnonzero(inside & ends) + 1 - starts
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]
    )
    return starts, found.dictionary_encode()
