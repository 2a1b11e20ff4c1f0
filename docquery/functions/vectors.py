"""Vectors as bytes, as an index stores them.

A stored vector is a sequence of 6-byte records. The first holds the number of dimensions; each
other one a position and a single-precision number that is not zero. Where the plain numbers are
no longer than that, they follow the first record as they are. Nothing is rounded or left out, so
a vector of hashed words takes a tenth of its plain size, on its way to and from Python workers too.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RECORD = np.dtype([("at", "<u2"), ("x", "<u4")])
# Positions are two bytes wide; longer vectors are stored as plain numbers.
_MOST_POSITIONS = 1 << 16
_BLOCK_NUMBERS = 1 << 20


def _wrong_dimensions(got: int | None, dim: int) -> str:
    return (
        f"Embedder returned {got}-dim vectors but {dim} are configured; set embed_dim and rebuild the index"
    )


def pack(vectors: pa.Array, dim: int) -> pa.Array:
    """Stored form of a list column; raises at the first vector of another length."""
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    other = np.flatnonzero(sizes != dim)
    if len(other):
        raise ValueError(_wrong_dimensions(int(sizes[other[0]]), dim))
    found: list[bytes] = []
    step = max(1, _BLOCK_NUMBERS // max(dim, 1))
    for at in range(0, len(vectors), step):
        flat = pc.list_flatten(vectors.slice(at, step)).to_numpy(zero_copy_only=False)
        found += _pack_block(np.ascontiguousarray(flat, "<f4").view("<u4").reshape(-1, dim), dim)
    return pa.array(found, pa.binary())


def _pack_block(bits: np.ndarray, dim: int) -> list[bytes]:
    rows, positions = np.nonzero(bits)
    counts = np.bincount(rows, minlength=len(bits))
    starts = np.concatenate([[0], np.cumsum(counts + 1)])
    records = np.zeros(starts[-1], _RECORD)
    records["x"][starts[:-1]] = dim
    own = np.arange(len(rows)) + rows + 1
    records["at"][own] = positions
    records["x"][own] = bits[rows, positions]
    stored, width = records.tobytes(), _RECORD.itemsize
    plain = counts * width >= 4 * dim if dim <= _MOST_POSITIONS else np.ones(len(bits), bool)
    return [
        stored[a * width : (a + 1) * width] + bits[i].tobytes() if p else stored[a * width : b * width]
        for i, (a, b, p) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), plain.tolist()))
    ]


def unpack(stored: pa.Array, dim: int) -> np.ndarray:
    """The vectors as rows of a double-precision matrix; raises if one has another length."""
    stored, width = stored.cast(pa.binary()), _RECORD.itemsize
    sizes = pc.fill_null(pc.binary_length(stored), 0).to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(stored), dim))
    plain = (sizes == 4 * dim + width) if dim else np.zeros(len(sizes), bool)
    ok = bool((sizes >= width).all()) and bool((sizes[~plain] % width == 0).all())
    if ok and plain.any():
        for i in np.flatnonzero(plain).tolist():
            value = stored[i].as_buffer()
            ok &= int(np.frombuffer(value, _RECORD, 1)["x"][0]) == dim
            matrix[i] = np.frombuffer(value, "<f4", offset=width)
    if ok and not plain.all():
        which = np.flatnonzero(~plain)
        some = stored.take(pa.array(which)) if plain.any() else stored
        ends = np.frombuffer(some.buffers()[1], np.int32)[some.offset : some.offset + len(some) + 1]
        records = np.frombuffer(some.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(_RECORD)
        starts = (ends[:-1] - ends[0]) // width
        ok = bool((records["x"][starts] == dim).all())
        if ok:
            own = np.ones(len(records), bool)
            own[starts] = False
            rows = np.repeat(which, sizes[which] // width)[own]
            matrix[rows, records["at"][own]] = np.ascontiguousarray(records["x"][own]).view("<f4")
    if not ok:
        raise ValueError(f"a vector does not have {dim} dimensions")
    return matrix


def packed(vectors: Column, dim: int) -> Column:
    """Stored form of a vector column; a vector of another length than `dim` fails the job."""

    @F.arrow_udf(T.BinaryType())
    def pack_batch(batch: pa.Array) -> pa.Array:
        stored = pack(batch, dim)
        del batch
        pa.default_memory_pool().release_unused()
        return stored

    return pack_batch(vectors)


def unpacked(stored: Column) -> Column:
    """A stored vector column as `array<float>`."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def unpack_batch(batch: pa.Array) -> pa.Array:
        return pa.array([None if v is None else _plain(v) for v in batch.to_pylist()], pa.list_(pa.float32()))

    return unpack_batch(stored)


def _plain(value: bytes) -> np.ndarray:
    dim = int(np.frombuffer(value, _RECORD, 1)["x"][0])
    return unpack(pa.array([value], pa.binary()), dim)[0].astype(np.float32)
