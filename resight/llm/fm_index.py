"""A compressed FM-index over integer symbols: Burrows-Wheeler transform in a wavelet matrix (the levelwise
form of the wavelet tree), searched backward for many patterns at a time."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; ``text`` ends with a symbol smaller than all others."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(sorted_[1:] != sorted_[:-1])
        rank = new
        if k >= n or rank[order[-1]] == n - 1:
            return order
        k *= 2


class _Bits:
    """A bit vector with constant-time rank: 64-bit blocks and their running counts."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, np.uint8)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(n, np.int64)
        np.cumsum(np.bitwise_count(self.blocks[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & low)


class FMIndex:
    """Occurrence intervals of patterns in ``text`` (symbols from 1; 0 is the added end)."""

    def __init__(self, text: np.ndarray) -> None:
        text = np.append(text, 0)
        self.size = len(text)
        bwt = text[suffix_array(text) - 1]
        top = int(text.max())
        self.first = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=top + 1), out=self.first[1:])
        self.levels: list[tuple[int, _Bits, int]] = []
        at = bwt
        for shift in range(max(top.bit_length(), 1) - 1, -1, -1):
            bits = (at >> shift) & 1
            zeros = int(len(at) - bits.sum())
            self.levels.append((shift, _Bits(bits), zeros))
            at = np.concatenate([at[bits == 0], at[bits == 1]])
        symbols = np.arange(top + 1)
        self.origin = self._descend(symbols, np.zeros(top + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern from the intervals of the patterns: one backward step each."""
        n = len(symbol)
        rank = self._descend(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.first[symbol] - self.origin[symbol]
        return base + rank[:n], base + rank[n:]


def repeated_windows(index: FMIndex, text: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> list[list[tuple[int, int]]]:
    """For every streamed stretch text[begin:end]: ranges (from, to) of window starts, relative to its begin, whose
    window of ``size`` symbols occurs at least twice in the index.

    Matching statistics by backward search, all stretches in step. From an end e the match grows to the left
    while two occurrences remain. Where it stops before position p, text[p:e] occurs once, so every window
    holding it is settled. A match of ``size`` or more settles its windows, and the search resumes at the window
    that starts at p. A shorter one is halved to the longest end for which text[p:end] still occurs twice.
    """
    n = len(begin)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    live = np.flatnonzero(end - begin >= size)
    e, p = end.copy(), end - 1  # p: next symbol to prepend
    lo, hi = np.zeros(n, np.int64), np.full(n, index.size, np.int64)
    pin = np.full(n, -1, np.int64)  # in a halving search: the position to be reached
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    while len(live):
        a, b = index.extend(text[p[live]], lo[live], hi[live])
        ok = b - a >= 2
        lo[live], hi[live] = a, b
        good = live[ok]
        p[good] -= 1
        halving = pin[live] >= 0
        # main search at the left edge: everything down to the begin matches
        edge = good[(pin[good] < 0) & (p[good] < begin[good])]
        for i in edge:
            if e[i] - begin[i] >= size:
                found[i].append((0, int(e[i] - begin[i]) - size + 1))
        # halving search that reached its position, or failed
        hit = good[(pin[good] >= 0) & (p[good] < pin[good])]
        low[hit] = e[hit]
        miss = live[~ok & halving]
        high[miss] = e[miss]
        # main search that failed at p
        stop = live[~ok & ~halving]
        matched = e[stop] - p[stop] - 1
        for i in stop[matched >= size]:
            found[i].append((int(p[i] + 1 - begin[i]), int(e[i] - begin[i]) - size + 1))
        resume = stop[matched >= size]
        e[resume] = p[resume] + size
        short = stop[matched < size]
        pin[short], low[short], high[short] = p[short], p[short], e[short]
        turn = np.concatenate([hit, miss, short])
        done = turn[high[turn] - low[turn] <= 1]
        e[done], pin[done] = low[done], -1
        probe = turn[high[turn] - low[turn] > 1]
        e[probe] = (low[probe] + high[probe]) // 2
        fresh = np.concatenate([resume, turn])
        p[fresh] = e[fresh] - 1
        lo[fresh], hi[fresh] = 0, index.size
        gone = np.zeros(n, bool)
        gone[edge] = True
        gone[done] = e[done] - begin[done] < size
        gone[resume] = e[resume] - begin[resume] < size
        live = live[~gone[live]]
    return found
