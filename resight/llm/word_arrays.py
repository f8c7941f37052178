"""Words of many texts as flat NumPy arrays: positions and 64-bit hashes without a Python loop per word.

A word is a maximal run of bytes other than space and the five control characters of ASCII white space.
Its hash is a polynomial over random byte values modulo 2^64, finished by a bit mixer. Two different words
get equal hashes with a chance near 2^-60; callers that must be exact compare the words afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 22  # bytes hashed at a time
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _RANDOM.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _RANDOM[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array | pa.ChunkedArray, most: int = _BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, at least one row each: bounds the working arrays."""
    _, at = utf8(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


class Words:
    """``start``/``end``: byte positions; ``hash``; ``row``: row of each word; ``first``: n + 1 word offsets."""

    def __init__(self, data: np.ndarray, at: np.ndarray, fold: bool = False, hashed: bool = True) -> None:
        self.data, self.at = data, at
        inside = ~_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        edges = at[:-1][at[:-1] < len(data)]
        before[edges] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        stops = at[1:][at[1:] > 0] - 1
        after[stops] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, at)
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(self.first))
        self.hash = self._hashes(_FOLDED if fold else _RANDOM) if hashed else None

    def _hashes(self, table: np.ndarray) -> np.ndarray:
        out, done = np.empty(len(self.start), np.uint64), 0
        longest = int((self.end - self.start).max()) if len(self.start) else 0
        size = min(max(len(self.data), 1), _BLOCK + longest)
        up = np.full(size, _BASE, np.uint64)
        up[0] = 1
        up = np.cumprod(up)
        down = np.full(size, _INVERSE, np.uint64)
        down[0] = 1
        down = np.cumprod(down)
        while done < len(self.start):
            zero = self.start[done]
            last = max(done + 1, int(np.searchsorted(self.end, zero + size, "right")))
            block = self.data[zero : self.end[last - 1]]
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(table[block] * up[: len(block)], out=sums[1:])
            s, e = self.start[done:last] - zero, self.end[done:last] - zero
            out[done:last] = (sums[e] - sums[s]) * down[s]
            done = last
        return mix(out)

    def text(self, i: int) -> str:
        return bytes(self.data[self.start[i] : self.end[i]]).decode("utf-8", "replace")
