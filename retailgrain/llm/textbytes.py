"""Texts as flat byte arrays inside a task: words, lines and hashes of many rows at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_powers = {BASE: np.ones(1, U64), INVERSE: np.ones(1, U64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, as every slice needs them."""
    have = _powers[base]
    if len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, base, U64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one to one)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not blank; runs end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~blank[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    starts[edges] = word[edges]
    ends[edges - 1] = word[edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, from prefix sums of a polynomial."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * powers(BASE, len(data)), out=sums[1:])
    return mix64((sums[end] - sums[start]) * powers(INVERSE, len(data) + 1)[start])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
