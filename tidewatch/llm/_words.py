"""Vectorised words of many texts at once: one 64-bit hash per word.

A word's hash is a polynomial of per-byte random values modulo 2**64, read off
a running sum over the whole buffer, then mixed with the word's length.  Two
different words share a hash with chance about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts are hashed in slices of about this size; a longer text is a slice of its own

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash like a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int, key: str) -> np.ndarray:
    have = _powers.get(key)
    if have is None or len(have) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if n <= 2 * SLICE_BYTES:
            _powers[key] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_binary(column: pa.Array) -> pa.Array:
    """A string column as UTF-8 with null as empty."""
    return column.fill_null("").cast(pa.large_binary())


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, text offsets into the bytes) of each slice."""
    col = texts_binary(column)
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end of every word; first word of every text and one past the last)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | cut[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_P, n, "up"), out=total[1:])
    h = (total[end] - total[start]) * _power(_P_INV, n, "down")[start]
    h = mix(h ^ ((end - start).astype(np.uint64) << np.uint64(48)))
    return h, start, end, np.searchsorted(start, offsets)


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word shingles of one text; a shorter text is one shingle."""
    if len(h) == 0:
        return h
    size = min(size, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - size + 1 + k])
    return out
