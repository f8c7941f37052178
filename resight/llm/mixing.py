"""Mixing sources to target weights (built-in functions only).

Sizes are summed per source, targets filled by weight up to a number of repetitions, and every document is
emitted floor(rate) times plus one more copy if a hash-seeded draw falls below the fraction of its source's
rate. The draw is the document's MD5 turned by one of ``TURNS`` equal angles; per source the turn whose
total comes nearest to the target is used, so sources of few or very uneven documents hit it too. Every
turn alone is a fair draw.

Cases: null text counts zero words; a null source is a source of its own, last in order; rows with the same
``doc_id`` draw alike; a source without words gets target 0 and copies none; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.llm.tables import text_of, words_of
from resight.session import saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all sizes
MOST_REPEATS = 2
TURNS = 32
SALTS = 16
_BITS = 48


def sizes(docs: DataFrame, keys: Sequence[str], text: str = "text", source: str = "source") -> DataFrame:
    return docs.select(
        *keys, F.col(source).alias("source"), F.size(words_of(text_of(text))).cast("long").alias("size")
    )


def draw(doc_id: str = "doc_id") -> Column:
    """Uniform integer below 2^48 from the document's id (null ids draw alike)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("long")


def _turned(u: Column, k) -> Column:
    return F.pmod(u + k * F.lit((1 << _BITS) // TURNS), F.lit(1 << _BITS))


def ranked_sources(per_source: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 by code point, null last: ranges are counted, then numbered inside."""
    ranged = saved(
        per_source.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range, not per source
    offsets = counts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.withColumn("i", F.row_number().over(inside) - 1)
        .join(offsets, "part")
        .select("source", "source_size", (F.col("i") + F.col("offset")).alias("rank"))
    )


def targets(per_source: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Add ``target``: weight times a common level, capped at ``MOST_REPEATS`` times the size.

    Each step returns the excess of the sources above their cap to the others; it only needs three sums,
    and ends when no further source is above.
    """
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int")
    )
    rows = saved(
        ranked_sources(per_source).withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * MOST_REPEATS)
    )
    total = rows.agg(F.sum("source_size").alias("s")).first().s or 0
    level, known = 0.0, -1
    while True:
        capped = F.col("cap") <= F.col("weight") * F.lit(level)
        sums = rows.agg(
            F.count_if(capped).alias("n"),
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("w"),
        ).first()
        if sums.n == known:
            break
        known = sums.n
        if sums.w:
            level = (SHARE * total - sums.given) / sums.w
    full = F.col("weight") * F.lit(level)
    return rows.withColumn("target", F.least(F.col("cap").cast("double"), full.cast("double")))


def plan(sized: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per source: size, target, whole copies, fraction and the chosen turn."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rated = targets(per_source).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    rated = rated.withColumn("whole", F.floor("rate").cast("long")).withColumn("fraction", F.col("rate") - F.floor("rate"))
    rated = saved(rated)
    u = draw(doc_id)
    sums = [
        F.sum(F.when(_turned(F.col("u"), F.lit(k)) < F.col("fraction") * F.lit(float(1 << _BITS)), F.col("size")).otherwise(0)).alias(f"t{k}")
        for k in range(TURNS)
    ]
    drawn = attach(sized.withColumn("u", u), rated.select("source", "fraction")).groupBy("source").agg(*sums)
    gaps = F.array(
        *[
            F.struct(
                F.abs(F.col("whole") * F.col("source_size") + F.col(f"t{k}") - F.col("target")).alias("gap"),
                F.lit(k).alias("turn"),
            )
            for k in range(TURNS)
        ]
    )
    return saved(
        rated.join(drawn, rated.source.eqNullSafe(drawn.source))
        .select(rated["*"], F.array_min(gaps)["turn"].alias("turn"))
    )


def attach(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join the source table with every source, hot or not, dealt over ``SALTS`` keys."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    left = rows.withColumn("_salt", salt).withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    right = per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn(
        "_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    ).drop("source")
    return left.join(right, ["_source", "_salt"]).drop("_source", "_salt")


def copies(u: Column) -> Column:
    """Copies of a document, once the plan's columns are attached."""
    extra = _turned(u, F.col("turn")) < F.col("fraction") * F.lit(float(1 << _BITS))
    return F.col("whole") + F.when(extra, F.lit(1)).otherwise(F.lit(0))


def taken(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: size, its source's size and target, the copies and the words the mix takes."""
    sized = saved(sizes(docs, ["doc_id"], text))
    parts = plan(sized).select("source", "source_size", "target", "whole", "fraction", "turn")
    return attach(sized, parts).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies(draw()).cast("long").alias("copies"),
        (copies(draw()) * F.col("size")).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mixed documents: each repeated as often as the mix takes it, columns unchanged."""
    parts = plan(saved(sizes(docs, ["doc_id"], text))).select("source", "whole", "fraction", "turn")
    whole = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    counted = attach(whole, parts).withColumn("_n", copies(draw()).cast("int")).filter("_n > 0")
    repeated = counted.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i"))
    return repeated.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
