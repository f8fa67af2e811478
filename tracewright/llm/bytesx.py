"""Vectorised work on the UTF-8 bytes of whole Arrow batches: words, lines, hashes of segments.

ASCII bytes never occur inside a multi-byte UTF-8 sequence, so white space and line feeds are found on bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WORD = ~SPACE

_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte.
VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The same with A-Z valued as a-z.
FOLDED = VALUES.copy()
FOLDED[65:91] = VALUES[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
#: Bytes worked on at a time, unless one document is longer.
SLICE = 1 << 20

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0..n-1 modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        table = np.full(max(n, 1024, len(_powers) * 2 if n < 1 << 22 else n), BASE, np.uint64)
        table[0] = 1
        _powers = np.cumprod(table, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array one after another, and where each value starts (one offset more than values). Nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE):
    """Ranges [i, j) of documents of at most limit bytes together, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of mask that do not cross a document's start."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = mask[:-1], mask[1:]
    before[offsets[offsets < n]] = False
    after[offsets[offsets > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment [start, end) of values; segments ascend, do not overlap and are not empty."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    span = np.diff(np.append(starts, ends[-1]))
    inside = np.arange(starts[0], ends[-1]) - np.repeat(starts, span)
    held = inside < np.repeat(lengths, span)
    inside[~held] = 0
    terms = values[starts[0] : ends[-1]] * powers(int(lengths.max()))[inside]
    terms[~held] = 0
    return mix(np.add.reduceat(terms, starts - starts[0]) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
