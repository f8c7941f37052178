"""Audit of how the sources of a language diverge in their vocabulary.

Every (language, source) group gives each kept term a probability p in 10^-9 steps, smoothed by one; the divergence of
a group from another is the sum of (p - q)^2 / q, rounded down per term. Terms are counted inside tasks and summed by
Spark. Terms whose counts agree in all sources of a language become one weighted row, the rows are dealt out in
ranges of their counts, and in a range each source is a run-length column of p. Per pair of sources the run boundaries
are merged and the function is computed once per run and multiplied by its length. Ranges add up, so the work is
split however large a language is. All arithmetic is exact.

Cases: null text, lang and source count as ''. Every occurring group has its rows, also without terms; in a language
without kept terms all pairs have value 0. Repeated rows count repeatedly. An empty table has no rows. Texts are counted
whole, whatever their length. Columns beside text, lang and source are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.session import saved

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
MEMORY_TERMS = 400_000  # entries counted in a task before they are passed on
RANGE_ROWS = 65_536

_FIND = re.compile(TERM).findall


def terms_of(text: str) -> list[str]:
    """The terms in order; of bytes only A-Z are lower-cased, at the speed of C for any script."""
    return _FIND(text.encode().lower().decode())


def _groups(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def count_terms(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` and documents ``docs`` per (lang, source, term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple[str, str], Counter] = defaultdict(Counter)
        seen: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in count.items():
                names = list(terms)  # both counters meet the terms in one order
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(names), pa.string()),
                        pa.array([source] * len(names), pa.string()),
                        pa.array(names, pa.string()),
                        pa.array(list(terms.values()), pa.int64()),
                        pa.array(list(seen[lang, source].values()), pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
            count.clear()
            seen.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                terms = terms_of(text)
                of = count[lang, source]
                size -= len(of)
                of.update(terms)
                size += len(of)
                seen[lang, source].update(tuple(dict.fromkeys(terms)))
                if size > MEMORY_TERMS:
                    yield from flush()
                    size = 0
        yield from flush()

    parts = _groups(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame) -> DataFrame:
    """Per kept (lang, term): the counts by source in order, and their sum."""
    return (
        counts.groupBy("lang", "term")
        .agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"), F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= MIN_DOCS)
        .drop("docs")
    )


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + 1) / (total + terms)), exact for any counts."""
    dividend = (n + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", dividend, (total + terms).cast("decimal(19,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _probabilities(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """:func:`probability` in 64-bit steps: 10^9 = 31250 x 32000, so nothing overflows below 2.8e14 occurrences."""
    whole, rest = np.divmod((n + 1) * 31_250, total + terms)
    return 1 + whole * 32_000 + rest * 32_000 // (total + terms)


def _run_columns(rows: np.ndarray, source: np.ndarray, n: np.ndarray, totals: list[int], terms: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per source the first rows of its runs and p in each run; rows without an entry count 0."""
    order = np.lexsort((rows, source))
    rows, source, n = rows[order], source[order], n[order]
    bounds = np.searchsorted(source, np.arange(len(totals) + 1))
    out = []
    for k, total in enumerate(totals):
        at, count = rows[bounds[k] : bounds[k + 1]], n[bounds[k] : bounds[k + 1]]
        gap = np.ones(len(at), bool)
        gap[:-1] = at[1:] != at[:-1] + 1
        starts = np.concatenate(([0], at, at[gap] + 1))
        values = np.concatenate(([0], count, np.zeros(gap.sum(), np.int64)))
        order = np.argsort(starts, kind="stable")
        starts, p = starts[order], _probabilities(values[order], total, terms)
        last = np.append(starts[1:] != starts[:-1], True)  # an entry in row 0 overrides the leading zero
        starts, p = starts[last], p[last]
        change = np.append(True, p[1:] != p[:-1])
        out.append((starts[change], p[change]))
    return out


def pair_sums(columns: list[tuple[np.ndarray, np.ndarray]], ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per group i the sums of i from each group before it, and of those from i. ``ends`` are the terms up to and
    with each row."""
    ahead = np.concatenate(([0], ends))
    for i, (starts_i, p_i) in enumerate(columns):
        sums = np.zeros((2, i), np.int64)
        for j in range(i):
            starts_j, p_j = columns[j]
            bounds = np.union1d(starts_i, starts_j)
            bounds = bounds[bounds < len(ends)]
            length = np.diff(ahead[np.append(bounds, len(ends))])
            p = p_i[np.searchsorted(starts_i, bounds, "right") - 1]
            q = p_j[np.searchsorted(starts_j, bounds, "right") - 1]
            square = (p - q) ** 2
            sums[:, j] = (square // q * length).sum(), (square // p * length).sum()
        yield sums[0], sums[1]


_PAIRS = "lang string, source string, item string, value long"


def _range_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of one range of a language. The one row with ``sources`` names them, with their totals."""
    table = pa.Table.from_batches(list(batches))
    is_head = pc.is_valid(table.column("sources"))
    head = table.filter(is_head).to_pylist()[0]
    names = pa.array([s["source"] for s in head["sources"]], pa.string())
    totals = [s["total"] for s in head["sources"]]
    body = table.filter(pc.invert(is_head)).sort_by("place").combine_chunks()
    if body.num_rows:
        counts = body.column("counts").combine_chunks()
        entries = counts.flatten()
        rows = pc.list_parent_indices(counts).to_numpy()
        source = pc.index_in(entries.field("source"), names).to_numpy()
        columns = _run_columns(rows, source, entries.field("n").to_numpy(), totals, head["terms"])
        sums = pair_sums(columns, np.cumsum(body.column("terms").to_numpy()))
    else:
        sums = ((np.zeros(i, np.int64),) * 2 for i in range(len(names)))
    for i, (to, back) in enumerate(sums):
        this, others = pa.array([names[i].as_py()] * i, pa.string()), names.slice(0, i)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([head["lang"]] * 2 * i, pa.string()),
                pa.concat_arrays([this, others]),
                pa.concat_arrays([others, this]),
                pa.array(np.concatenate((to, back))),
            ],
            ["lang", "source", "item", "value"],
        )


def pairs(terms: DataFrame, totals: DataFrame) -> DataFrame:
    """``value`` of every (lang, source, item) with another source as item.

    ``terms`` as from :func:`kept_terms`; ``totals`` has (lang, source, total, terms) of every occurring group.
    """
    rows = saved(terms.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms")))
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    order = [F.col("lang"), F.col("counts")]
    placed = saved(
        rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ).withColumn("range", F.shiftright("place", 33))
    heads = totals.groupBy("lang").agg(
        F.max("terms").alias("terms"), F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources")
    )
    # a language without kept terms still has one range, without rows
    where = placed.select("lang", "range").distinct()
    heads = heads.join(where, "lang", "left").withColumn("range", F.coalesce("range", F.lit(-1).cast("long")))
    both = placed.unionByName(heads, allowMissingColumns=True)
    sums = both.groupBy("lang", "range").applyInArrow(_range_sums, _PAIRS)
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: all pairs, and the ``TOP_TERMS`` terms in which a
    group stands out most from its language."""
    terms = saved(kept_terms(count_terms(docs)))
    cells = terms.select("lang", "term", "total", F.inline("counts"))
    per_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    per_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    totals = saved(
        _groups(docs).select("lang", "source").distinct()
        .join(per_lang, "lang", "left")
        .join(per_group, ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
    )

    known = cells.withColumnRenamed("total", "term_total").join(totals, ["lang", "source"])
    known = known.withColumn("p", probability(F.col("n"), F.col("total"), F.col("terms")))
    known = known.withColumn("q", probability(F.col("term_total"), F.col("lang_total"), F.col("terms")))
    standing = known.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
    )

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    top = standing.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= TOP_TERMS)
    between = pairs(terms, totals.drop("lang_total")).withColumn("rank", F.row_number().over(ranked))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        between.withColumn("part", F.lit("pair")).select(columns).unionByName(top.withColumn("part", F.lit("term")).select(columns))
    )
