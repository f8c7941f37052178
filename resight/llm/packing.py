"""Packing tokenised documents into sequences of at most ``LENGTH`` tokens by cutting-stock column generation.

1. Each document's ids (plus the end id) are cut into full pieces of ``LENGTH`` and a rest. Only lengths and
   checksums leave the tasks.
2. The rests give a histogram of at most ``LENGTH`` / ``STEP`` length classes, whatever the number of
   documents. A linear program over patterns (how many pieces of each class share a sequence) is solved on it
   by column generation: the simplex basis gives class prices, a knapsack dynamic program finds the pattern
   worth most, until the prices prove the solution to one sequence in ``EXACT``.
3. Patterns are used floor(x) times; what rounding leaves over, less than one sequence per basic pattern, is
   packed on the same histogram by fullest-pattern-first.
4. Every piece gets its rank within its class (ranks are counted over hash blocks, so a class holding a third
   of all rows is no single task) and the rank decides pattern, sequence and slot.

Cases: null text is empty and still has its end id; repeated rows are packed each; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
import warnings
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resight.llm.word_arrays import pieces
from resight.session import saved

LENGTH = 2048
STEP = 4  # a class holds the lengths of one multiple of STEP and those just below it
END_ID = 1
_END = np.uint32(END_ID).tobytes()
_ID = attrgetter("id")
EXACT = 1_000_000  # the linear program is solved to one sequence in so many
_CACHED = 400_000  # words whose ids a task remembers, and as many from before
_BLOCKS = 64
_PIECE_BYTES = 1 << 20


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")


_SEPARATORS = "\x1c\x1d\x1e\x1f"
_WORD = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _words(text: str) -> list[str]:
    """Split at Unicode white space, the tokenizer's; str.split also splits at the four separator controls."""
    return _WORD.findall(text) if any(c in text for c in _SEPARATORS) else text.split()


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level models write each byte: printable Latin-1 as itself, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids of words as bytes, found at the first look-up. Words in use outlive :meth:`age`."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        self.find = find
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.before.get(word) or self.find(word)
        return found

    def age(self) -> None:
        """Forget the words not looked up since the memory was full for the last time."""
        self.before = dict(self)
        self.clear()


class _Encoder:
    """Ids of texts through a memory of their white-space separated words.

    The tokenizer drops white space and no token spans it, so a text's ids are its words' ids in order. A word of
    Latin letters with ASCII marks behind (no apostrophe) goes straight to the merges, letters in lower case and marks
    as one run: its normal form and its split are known. Every other word takes the tokenizer's whole path. Words and the
    stems and marks they are made of are forgotten apart, so that stems outlive the words, and only when out of use.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.known = _Known(self._ids)
        self.runs = _Known(self._merged)

    def _merged(self, run: str) -> bytes:
        if not run.isascii():
            run = "".join(map(self.letters.__getitem__, run.encode()))
        return array("I", map(_ID, self.merge(run))).tobytes()

    def _ids(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.runs[word.lower()]
        m = _PLAIN.fullmatch(word)
        if not m:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        stem, marks = m.groups()
        return self.runs[stem.lower()] + self.runs[marks] if marks else self.runs[stem.lower()]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for memory in (self.known, self.runs):
            if len(memory) > _CACHED:
                memory.age()
        look_up = self.known.__getitem__
        for text in texts:
            yield np.frombuffer(b"".join(map(look_up, _words(text or ""))) + _END, np.uint32)


@lru_cache(1)
def _encoder(path: str) -> _Encoder:
    """One encoder per Python worker: its memory of words lasts over the tasks the worker runs."""
    return _Encoder(path)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


def cut_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece; ``row`` numbers the rows of a task."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for lo, hi in pieces(batch.column("text"), _PIECE_BYTES):
                part = batch.slice(lo, hi - lo)
                rows = []
                ids = part.column("doc_id").to_pylist()
                for k, (doc, tokens) in enumerate(zip(ids, encoder.encode(part.column("text").to_pylist()), strict=True)):
                    for s in range(0, len(tokens), length):
                        x = tokens[s : s + length]
                        rows.append((doc, s, len(x), zlib.crc32(x.astype("<u4").tobytes()), len(tokens), lo + k))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECES)


def _knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Worth of the best filling of every capacity, and the class to take first (-1: leave one unit empty)."""
    worth = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for c in range(int(sizes[0]), capacity + 1):
        n = np.searchsorted(sizes, c, "right")
        gain = worth[c - sizes[:n]] + prices[:n]
        k = int(np.argmax(gain))
        worth[c] = worth[c - 1]
        if gain[k] > worth[c] + 1e-12:
            worth[c], choice[c] = gain[k], k
    return worth, choice


def _pattern(first: int, choice: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    counts, c = np.zeros(len(sizes), np.int64), capacity - int(sizes[first])
    counts[first] = 1
    while c >= sizes[0]:
        k = choice[c]
        if k < 0:
            c -= 1
        else:
            counts[k] += 1
            c -= int(sizes[k])
    return counts


def _reachable(sizes: np.ndarray, capacity: int) -> int:
    """Bit r is set if pieces of these sizes can fill exactly r."""
    bits, whole = 1, (1 << (capacity + 1)) - 1
    for s in map(int, sizes):
        while (more := (bits | bits << s) & whole) != bits:
            bits = more
    return bits


def _fill(left: np.ndarray, sizes: np.ndarray, capacity: int, bits: int) -> np.ndarray:
    """A full pattern of the classes still demanded, largest pieces first."""
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while True:
        fits = np.flatnonzero((left > counts) & (sizes <= room))[::-1]
        if not len(fits):
            return counts
        k = next((k for k in fits if bits >> (room - int(sizes[k])) & 1), fits[0]) if room < capacity else fits[0]
        counts[k] += 1
        room -= int(sizes[k])


def _start(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray, float]]:
    """A feasible basis: full patterns, each used until one of its classes is used up.

    Ordered by the class each uses up, the patterns form a triangular matrix, so they are independent.
    """
    left, open_, basis = demand.astype(float), np.ones(len(sizes), bool), []
    while open_.any():
        at = np.flatnonzero(open_)
        pattern = _fill(np.where(open_, capacity, 0), sizes, capacity, _reachable(sizes[at], capacity))
        some = np.flatnonzero(pattern)
        ratio = left[some] / pattern[some]
        n = float(ratio.min())
        left[some] = np.where(ratio <= n, 0, left[some] - n * pattern[some])
        done = [int(k) for k in some if left[k] <= 1e-9]
        basis.append((done[0], pattern, n))
        basis += [(k, np.eye(1, len(sizes), k, dtype=np.int64)[0], 0.0) for k in done[1:]]
        open_[done] = False
    return basis


def _pivot(inverse: np.ndarray, d: np.ndarray, r: int) -> None:
    """Bring in the column whose image is ``d`` at row ``r``."""
    row = inverse[r] / d[r]
    inverse -= np.outer(d, row)
    inverse[r] = row


def relax(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, columns: int = 32, rounds: int = 10_000
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Patterns, how often to use each (fractions allowed), and the class prices that prove how good that is.

    Revised simplex with an explicit basis inverse, from full patterns found greedily. One knapsack prices, for every
    class, the best pattern that holds it; up to ``columns`` of them enter per round. Prices divided by the worth of
    the best pattern prove a lower bound (as total / capacity does): it ends when no pattern is worth more than one
    sequence, or the bound is less than half a sequence or one in ``EXACT`` away. It warns if neither is so after
    ``rounds``.
    """
    m = len(sizes)
    bound = float(sizes @ demand) / capacity
    basis, x, inverse = [np.zeros(m, np.int64)] * m, np.zeros(m), np.eye(m)
    for r, pattern, n in reversed(_start(sizes, demand, capacity)):
        _pivot(inverse, np.einsum("ij,j->i", inverse, pattern), r)
        basis[r], x[r] = pattern, n
    for _ in range(rounds):
        prices = np.maximum(inverse.sum(axis=0), 0)
        worth, choice = _knapsack(prices, sizes, capacity)
        value = prices + worth[capacity - sizes]
        bound = max(bound, float(prices @ demand) / max(1.0, float(value.max())))
        if x.sum() - bound <= max(0.5, x.sum() / EXACT):
            break
        entered = 0
        for first in np.argsort(-value)[: 4 * columns]:
            if value[first] <= 1 + 1e-7 or entered >= columns:
                break
            column = _pattern(int(first), choice, sizes, capacity)
            if inverse.sum(axis=0) @ column <= 1 + 1e-7:
                continue
            d = np.einsum("ij,j->i", inverse, column)
            up = d > 1e-9
            if not up.any():
                continue
            ratio = np.where(up, x / np.where(up, d, 1), np.inf)
            r = int(np.argmin(ratio))
            t = ratio[r]
            x = np.maximum(x - t * d, 0)
            x[r] = t
            _pivot(inverse, d, r)
            basis[r] = column
            entered += 1
        if not entered:
            break
    else:
        warnings.warn(f"column generation not at its end after {rounds} rounds", stacklevel=3)
    return basis, x, np.maximum(inverse.sum(axis=0), 0)


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use them, so that every demanded piece has exactly one slot; ``sizes`` ascend."""
    if not len(sizes):
        return []
    basis, x, _ = relax(sizes, demand, capacity)
    used: list[tuple[np.ndarray, int]] = []
    left = demand.copy()
    for k in np.argsort(-x):
        n = int(x[k] + 1e-6)
        some = basis[k] > 0
        n = min(n, int((left[some] // basis[k][some]).min())) if some.any() else 0
        if n:
            used.append((basis[k], n))
            left = left - n * basis[k]
    while left.any():  # fewer pieces than classes times pieces per sequence
        at = np.flatnonzero(left)
        pattern = _fill(left, sizes, capacity, _reachable(sizes[at], capacity))
        some = pattern > 0
        n = int((left[some] // pattern[some]).min())
        used.append((pattern, n))
        left = left - n * pattern
    return used


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = cut_pieces(docs, path, length)
    class_of = F.ceil(F.col("length") / F.lit(step)).cast("int")
    block = F.pmod(F.xxhash64("doc_id", "start", "piece"), F.lit(_BLOCKS)).cast("int")
    rows = saved(
        cut.withColumn("piece", F.monotonically_increasing_id())
        .withColumn("class", class_of)
        .withColumn("block", block)
        .drop("row")
    )
    counts = saved(rows.groupBy("class", "block").agg(F.count(F.lit(1)).alias("n")))
    # at most LENGTH / STEP classes, so this histogram is bounded however many documents there are
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    full = length // step
    some = sorted(c for c in histogram if c < full)
    patterns = solve(np.array(some, np.int64), np.array([histogram[c] for c in some], np.int64), full)
    slots, base, ahead = [], 0, dict.fromkeys(some, 0)
    for pattern, n in patterns:
        for k in np.flatnonzero(pattern):
            c, each = some[k], int(pattern[k])
            slots.append((c, ahead[c], ahead[c] + n * each, base, each))
            ahead[c] += n * each
        base += n
    if full in histogram:
        slots.append((full, 0, histogram[full], base, 1))
    # one row per class and pattern that uses it: bounded by the square of the number of classes
    table = spark.createDataFrame(slots, "class int, lo long, hi long, base long, each long")
    offsets = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    ).select("class", "block", F.coalesce("before", F.lit(0)).alias("before"))
    inside = Window.partitionBy("class", "block").orderBy("piece")
    ranked = (
        rows.join(F.broadcast(offsets), ["class", "block"])  # at most classes x blocks rows
        .withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    )
    by_class = table.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "base", "each"))).alias("slots"))
    placed = ranked.join(F.broadcast(by_class), "class").withColumn(
        "slot", F.filter("slots", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"]))[0]
    )
    placed = placed.withColumn(
        "sequence_id", F.col("slot.base") + F.floor((F.col("rank") - F.col("slot.lo")) / F.col("slot.each")).cast("long")
    )
    order = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
    at = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(at, F.lit(0)).cast("long").alias("offset"),
    )
