"""Hashes of words and byte strings of whole Arrow columns, without a loop over characters.

A string's hash is a polynomial over random 64-bit values of its bytes. Prefix sums of the terms give the
hash of any substring with one subtraction and one multiplication by an inverse power, modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEED = np.random.RandomState(20240229)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
BYTE_VALUES = _SEED.randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
ASCII_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
SPACES = np.array([c == 0x20 or 0x09 <= c <= 0x0D for c in range(256)])
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null: empty) and the bounds of its rows in them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data))[0], out=sums[1:])
    return sums


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end)."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and how many words end before each row's bounds."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    first = np.zeros(len(data) + 1, bool)  # rows begin here: a word never runs over such a place
    first[bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    return starts, ends, np.searchsorted(starts, bounds)
