"""Removal of word sequences that occur elsewhere, by compressed FM-indexes over shards.

A window is ``WINDOW`` consecutive words. To meet its equals it must reach the shard that holds them, so
shards are made by content:

1. Every window has a minimiser, the smallest hash of the ``GRAM``-word sequences inside it. Consecutive windows
   with one minimiser form a run; equal windows have equal minimisers, wherever they stand.
2. Only runs whose minimiser occurs twice can hold repeats. Runs with equal words are one segment with a number
   of copies; copies of the only segment of a minimiser are repeated whole, of the others one occurrence is read out. A minimiser with more than ``HOT`` occurrences (a passage in a
   third of all documents) has its runs cut to single windows with the window's own hash as key: all equal
   windows become one segment, and no key gathers the differing surroundings.
3. Segments are dealt to shards of about ``SHARD_WORDS`` words by minimiser. Each shard builds one FM-index and
   streams its segments through backward search; windows with two occurrences, or in a segment with
   copies, are reported as ranges.
4. Ranges go back to every occurrence of the segment, and each document drops the words they cover.

Documents that are needed again are picked by a broadcast of at most 2^``tables.FILTER_BITS`` rows of 64 hash slots; the
others are not shuffled. Above some 10^8 such documents the filter is full, saves nothing and loses nothing.

Words are compared as 64-bit hashes. Cases: null text has no words; texts shorter than a window lose nothing;
rows that repeat both doc_id and text are documents of their own and repeat each other; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resight.llm.fm_index import FMIndex, repeated_windows
from resight.llm.tables import slots, touched
from resight.llm.word_arrays import Words, mix, pieces, utf8
from resight.session import saved, saved_counting

WINDOW = 35
GRAM = 6
HOT = 60_000
SHARD_WORDS = 400_000
LONGEST_RUN = 256  # windows; longer runs (periodic text) are cut
_ODD = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _sliding(x: np.ndarray, size: int, best) -> np.ndarray:
    """Minimum (or maximum) of every ``size`` consecutive values, by doubling."""
    width = 1
    while width * 2 <= size:
        x = best(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def _spans(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any span of words follows (see :func:`_span_hash`)."""
    power = np.full(len(hashes), _STEP, np.uint64)
    power[:1] = 1
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * np.cumprod(power), out=out[1:])
    return out


def _span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    power = np.full(int(start.max()) + 1 if len(start) else 1, _BACK, np.uint64)
    power[0] = 1
    return mix((sums[end] - sums[start]) * np.cumprod(power)[start] + (end - start).astype(np.uint64))


def runs_of(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per run of one text: first window, number of windows, minimiser, its occurrences, hash of its words."""
    n = len(hashes) - window + 1
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    for k in range(gram):
        grams += hashes[k : k + len(grams)] * _ODD[k]
    grams = mix(grams)
    width = window - gram + 1
    least = _sliding(grams, width, np.minimum)
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], cut])
    size = np.diff(np.append(first, n))
    # occurrences of its minimiser among the grams a run spans
    values = least[first]
    at = np.flatnonzero(np.isin(grams, values))
    kinds, of_gram = np.unique(grams[at], return_inverse=True)
    slots = np.sort(of_gram * (len(grams) + 1) + at)
    base = np.searchsorted(kinds, values) * (len(grams) + 1) + first
    occurs = np.searchsorted(slots, base + size + width - 1) - np.searchsorted(slots, base)
    # runs longer than the longest are cut; each part keeps a count that marks it as repeated
    parts = -(-size // LONGEST_RUN)
    at = np.repeat(np.arange(len(first)), parts)
    part = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first[at] + part * LONGEST_RUN
    size = np.minimum(size[at] - part * LONGEST_RUN, LONGEST_RUN)
    sums = _spans(hashes)
    return start, size, least[first[at]], occurs[at], _span_hash(sums, start, start + size + window - 1)


def _arrow(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int32 if n in ("start", "size", "occurs") else np.int64))
            for n, c in zip(names, columns, strict=True)
        ],
        names,
    )


_RUN = ["rid", "start", "size", "key", "occurs", "segment"]
_RUN_SCHEMA = "rid long, start int, size int, key long, occurs int, segment long"


def find_runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                words = Words(*utf8(part.column("text")))
                rid = part.column("rid").to_numpy()
                got = []
                for i in np.flatnonzero(np.diff(words.first) >= window):
                    found = runs_of(words.hash[words.first[i] : words.first[i + 1]], window, gram)
                    got.append((np.full(len(found[0]), rid[i]), *found))
                if got:
                    yield _arrow(_RUN, [np.concatenate(c) for c in zip(*got, strict=True)])

    return docs.select("rid", "text").mapInArrow(run, _RUN_SCHEMA)


def _single_windows(docs: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """The windows of the given runs, each a run of its own keyed by its whole content."""
    wanted = runs.groupBy("rid").agg(F.collect_list(F.struct("start", "size")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                words = Words(*utf8(part.column("text")))
                rid = part.column("rid").to_numpy()
                got = []
                for i, spans in enumerate(part.column("runs").to_pylist()):
                    sums = _spans(words.hash[words.first[i] : words.first[i + 1]])
                    start = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["size"]) for s in spans]))
                    whole = _span_hash(sums, start, start + window)
                    one = np.ones(len(start), np.int64)
                    got.append((np.full(len(start), rid[i]), start, one, mix(whole), one, whole))
                if got:
                    yield _arrow(_RUN, [np.concatenate(c) for c in zip(*got, strict=True)])

    return docs.join(wanted, "rid").select("rid", "text", "runs").mapInArrow(run, _RUN_SCHEMA)


def _read_out(docs: DataFrame, segments: DataFrame, window: int) -> DataFrame:
    """``key``, ``segment``, ``copies`` and the word hashes of one occurrence of every segment."""
    wanted = segments.groupBy("rid").agg(F.collect_list(F.struct("start", "size", "key", "segment", "copies")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                words = Words(*utf8(part.column("text")))
                out: list[tuple] = []
                for i, spans in enumerate(part.column("runs").to_pylist()):
                    at = words.first[i]
                    out += [
                        (s["key"], s["segment"], s["copies"], words.hash[at + s["start"] : at + s["start"] + s["size"] + window - 1].tobytes())
                        for s in spans
                    ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    ["key", "segment", "copies", "words"],
                )

    # rows that repeat id and text read out the same segments; one is enough
    once = docs.join(slots(wanted, "rid"), touched("rid"), "left_semi").join(wanted, "rid").select("rid", "text", "runs").dropDuplicates(["rid"])
    return once.mapInArrow(run, "key long, segment long, copies long, words binary")


def _search(segments: DataFrame, shards: int, window: int) -> DataFrame:
    """``key``, ``segment`` and the ranges (lo, hi) of their repeated windows, shard by shard."""

    def search(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
        copies = table.column("copies").to_numpy()
        sizes = np.array([len(w) for w in words])
        end = np.cumsum(sizes + 1) - 1
        begin = end - sizes
        text = np.ones(int(end[-1]) + 1, np.int64)  # 1 separates segments
        inside = np.ones(len(text), bool)
        inside[end] = False
        text[inside] = np.unique(np.concatenate(words), return_inverse=True)[1] + 2
        single = np.flatnonzero(copies == 1)
        found: list[list[tuple[int, int]]] = [[(0, int(s) - window + 1)] for s in sizes]
        for i, ranges in zip(single, repeated_windows(FMIndex(text), text, begin[single], end[single], window), strict=True):
            found[i] = ranges
        each = np.array([len(f) for f in found])
        flat = np.array([r for f in found for r in f], np.int64).reshape(-1, 2)
        at = np.repeat(np.arange(len(found)), each)
        return pa.table(
            {
                "key": table.column("key").to_numpy()[at],
                "segment": table.column("segment").to_numpy()[at],
                "lo": flat[:, 0],
                "hi": flat[:, 1],
            }
        )

    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    return segments.select(shard, "key", "segment", "copies", "words").groupBy("shard").applyInArrow(
        search, "key long, segment long, lo long, hi long"
    )


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``rid``, ``start``, ``end``: word spans covered by repeated windows (spans of one document may overlap).

    ``docs``: (rid, text); rows with one ``rid`` must have one text.
    """
    runs = saved(find_runs(docs, window, gram))
    shared, seen = saved_counting(
        runs.groupBy("key").agg(F.sum("occurs").alias("n")).filter("n > 1"), F.count_if(F.col("n") > hot).alias("hot")
    )
    cold = runs.join(shared.filter(F.col("n") <= hot).select("key"), "key")
    if seen["hot"]:
        warm = saved(runs.join(shared.filter(F.col("n") > hot).select("key"), "key"))
        windows = saved(_single_windows(docs, warm, window))
        again = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
        cold = cold.select(*_RUN).union(windows.join(again, "key").select(*_RUN))
    runs = saved(cold.select("rid", "start", "size", "key", "segment"))
    segments = saved(
        runs.groupBy("key", "segment").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "start", "size")).alias("at")
        ).select("key", "segment", "copies", "at.*")
    )
    # copies of the only segment of a minimiser are repeated whole, whatever the index would say
    several = segments.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = segments.join(several, "key")
    alone = (F.col("kinds") == 1) & (F.col("copies") > 1)
    whole = kinds.filter(alone).select("key", "segment", F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi"))
    indexed, total = saved_counting(kinds.filter(~alone).drop("kinds"), F.sum(F.col("size") + window).alias("words"))
    shards = -(-(total["words"] or 0) // shard_words) or 1
    found = saved(_search(_read_out(docs, indexed, window), shards, window)).union(whole)
    return runs.join(found, ["key", "segment"]).select(
        "rid", (F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi") + window - 1).alias("end")
    )


def _row_id() -> Column:
    return F.xxhash64("doc_id", "text")


def remove_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the kept words joined by one space."""
    docs = docs.select(_row_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = repeated_spans(docs, **options)
    per_doc = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True)
            for doc_id, text, spans in rows:
                words = (text or "").encode().split()  # exactly the ASCII white space of the word rule
                keep = np.ones(len(words), bool)
                for s in spans or ():
                    keep[s["start"] : s["end"]] = False
                kept = words if keep.all() else [words[k] for k in np.flatnonzero(keep)]
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    per_doc = saved(per_doc)
    some = slots(per_doc, "rid")
    changed = docs.join(some, touched("rid"), "left_semi").join(per_doc, "rid", "left").select("doc_id", "text", "spans")
    same = docs.join(some, touched("rid"), "left_anti").select("doc_id", "text", F.lit(None).cast(per_doc.schema["spans"].dataType).alias("spans"))
    joined = changed.union(same)
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")

