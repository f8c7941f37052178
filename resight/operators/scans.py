"""Operators that walk a group in order: fills, gaps, sessions, running counts.

A plain ``partitionBy(id)`` window would put every row of an individual into one task. Here the rows are dealt once
into ranges of (key, order), whatever the sizes of the groups: a range is a segment, a large group lies in several of
them. A window runs inside (segment, key), one small row per (segment, key) says what it holds, and a window over
those rows carries the state from segment to segment. The carry table is joined back once, for all values together.

The ranged rows are written, so both passes and a retried task see the same segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.functions.dates import wall_micros
from resight.operators.order import Order
from resight.session import saved

_MINUTE = 60_000_000  # microseconds
_DAY = 1440 * _MINUTE

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)
SEGMENT = "_segment"


def segmented(rows: DataFrame, key: str, sort: Sequence[Column]) -> DataFrame:
    """Rows with the ``_segment`` they lie in: segments ascend with (key, order), rows without a key come first."""
    ranged = rows.repartitionByRange(F.col(key).asc_nulls_first(), *sort)
    return saved(ranged.withColumn(SEGMENT, F.spark_partition_id()))


def _within(key: str, sort: Sequence[Column]):
    return Window.partitionBy(SEGMENT, key).orderBy(*sort)


def _earlier(key: str):
    """Over one row per (segment, key): the segments before this one."""
    return Window.partitionBy(key).orderBy(SEGMENT).rowsBetween(*_BEFORE)


def _later(key: str):
    return Window.partitionBy(key).orderBy(F.desc(SEGMENT)).rowsBetween(*_BEFORE)


def fill_group(
    rows: DataFrame,
    key: str,
    value: str | Sequence[str],
    order: Order,
    direction: str = "down",
    out: str | Sequence[str] | None = None,
) -> DataFrame:
    """Fill nulls of ``value`` from the nearest earlier ("down") or later ("up") row of the group.

    "downup" fills down, then up; "updown" the reverse. Several values are filled in the same pass. Rows with a null
    key are left as they are.
    """
    if direction not in ("down", "up", "downup", "updown"):
        raise ValueError(f"unknown fill direction: {direction}")
    values = [value] if isinstance(value, str) else list(value)
    outs = values if out is None else [out] if isinstance(out, str) else list(out)
    up, both = direction.startswith("up"), direction in ("downup", "updown")

    inside = _within(key, order.descending() if up else order.ascending()).rowsBetween(*_UP_TO)
    cut = segmented(rows, key, order.ascending())
    local = cut.withColumns({f"_local{i}": F.last(v, ignorenulls=True).over(inside) for i, v in enumerate(values)})

    ends = []
    for i, v in enumerate(values):
        at = F.when(F.col(v).isNotNull(), order.key())
        ends += [F.min_by(v, at).alias(f"_head{i}"), F.max_by(v, at).alias(f"_tail{i}")]
    carry = cut.filter(F.col(key).isNotNull()).groupBy(SEGMENT, key).agg(*ends)
    carried = {}
    for i in range(len(values)):
        carried[f"_before{i}"] = F.last(f"_tail{i}", ignorenulls=True).over(_earlier(key))
        carried[f"_after{i}"] = F.last(f"_head{i}", ignorenulls=True).over(_later(key))
    carry = carry.withColumns(carried)

    def filled(i: int, v: str) -> Column:
        down = [f"_before{i}", f"_head{i}", f"_after{i}"]  # beyond the first two, only rows before any value are empty
        steps = [f"_after{i}", f"_tail{i}", f"_before{i}"] if up else down
        new = F.coalesce(f"_local{i}", *(steps if both else steps[:1]))
        return F.when(F.col(key).isNull(), F.col(v)).otherwise(new)

    return (
        local.join(carry, [SEGMENT, key], "left")
        .withColumns({o: filled(i, v) for i, (o, v) in enumerate(zip(outs, values, strict=True))})
        .select(*dict.fromkeys([*rows.columns, *outs]))
    )


def running_number(rows: DataFrame, key: str, order: Order, out: str) -> DataFrame:
    """Position of each row in its group (1, 2, ...)."""
    cut = segmented(rows, key, order.ascending())
    sizes = cut.filter(F.col(key).isNotNull()).groupBy(SEGMENT, key).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(SEGMENT, key, F.sum("_n").over(_earlier(key)).alias("_ahead"))
    return (
        cut.withColumn("_local", F.row_number().over(_within(key, order.ascending())))
        .join(before, [SEGMENT, key], "left")
        .withColumn(out, F.col("_local") + F.coalesce("_ahead", F.lit(0)))
        .select(*rows.columns, out)
    )


def _with_sessions(
    rows: DataFrame, key: str, sort: Sequence[Column], begin: str, end: str, gap_minutes: int
) -> DataFrame:
    """Add ``encounter_id`` to rows that last from ``begin`` to ``end`` (microseconds, both null last in order)."""

    def starts(now: str, before: str) -> Column:
        far = F.col(now) - F.col(before) > gap_minutes * _MINUTE
        return F.when(F.col(now).isNull() | F.col(before).isNull() | far, 1).otherwise(0)

    inside = _within(key, sort)
    local = segmented(rows, key, sort).withColumns(
        {"_previous": F.lag(end).over(inside), "_place": F.row_number().over(inside)}
    )
    # whether the first row of a segment starts a session is only known from the segments before it
    local = local.withColumn("_new", F.when(F.col("_place") > 1, starts(begin, "_previous")).otherwise(0))
    carry = (
        local.filter(F.col(key).isNotNull())
        .groupBy(SEGMENT, key)
        .agg(F.min(begin).alias("_first"), F.max(end).alias("_last"), F.sum("_new").alias("_inner"))
        .withColumn("_last_before", F.last("_last", ignorenulls=True).over(_earlier(key)))
        .withColumn("_opens", starts("_first", "_last_before"))
        .withColumn("_ahead", F.coalesce(F.sum(F.col("_inner") + F.col("_opens")).over(_earlier(key)), F.lit(0)))
        .select(SEGMENT, key, (F.col("_ahead") + F.col("_opens")).alias("_ahead"))
    )
    numbered = F.sum("_new").over(_within(key, [F.col("_place")]).rowsBetween(*_UP_TO))
    return (
        local.withColumn("_within", numbered)
        .join(carry, [SEGMENT, key], "left")
        .withColumn("encounter_id", F.col("_ahead") + F.col("_within"))
        .select(*rows.columns, "encounter_id")
    )


def _by_time(ts: str, seq: str) -> list[Column]:
    return [F.col(ts).asc_nulls_last(), F.col(seq).asc_nulls_last()]


def sessionize(
    rows: DataFrame, key: str, ts: str, seq: str, gap_minutes: int = 30
) -> DataFrame:
    """Add ``encounter_id``, numbered from 1 within each key.

    A new session starts when more than ``gap_minutes`` passed since the previous record of the key; exactly the gap
    still belongs to it. A record without time is an encounter of its own, numbered after the timed ones. Records
    without a key stay, with a null ``encounter_id``.
    """
    timed = rows.withColumn("_micros", wall_micros(ts))
    return _with_sessions(timed, key, _by_time(ts, seq), "_micros", "_micros", gap_minutes).drop("_micros")


def session_buckets(rows: DataFrame, key: str, ts: str, gap_minutes: int = 30) -> DataFrame:
    """Sessions from one row per (key, time bucket): ``start``, ``end``, ``group_rows`` and ``encounter_id``.

    A bucket is no wider than the gap, so it lies in one session and its first and last time are all that matters.
    Records are reduced to those before any shuffle, and the buckets of a key are walked segment by segment, over
    however long a time. Records without key or time have no bucket.
    """
    micros = wall_micros(ts)
    width = F.lit(gap_minutes * _MINUTE)
    buckets = (
        rows.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .withColumns(
            {
                "_micros": micros,
                "_day": F.col(ts).cast("date"),
                "_bucket": F.floor(F.pmod(micros, F.lit(_DAY)) / width).cast("int"),  # never across midnight
            }
        )
        .groupBy(key, "_day", "_bucket")
        .agg(F.min("_micros").alias("start"), F.max("_micros").alias("end"), F.count(F.lit(1)).alias("group_rows"))
    )
    return _with_sessions(buckets, key, [F.col("start").asc()], "start", "end", gap_minutes)


def gap_to_previous(rows: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Minutes since the previous record of the key (``gap_minutes``), null for the first one; records of the same
    instant follow each other by ``seq``."""
    cut = segmented(rows.withColumn("_micros", wall_micros(ts)), key, _by_time(ts, seq))
    carry = (
        cut.filter(F.col(key).isNotNull())
        .groupBy(SEGMENT, key)
        .agg(F.max("_micros").alias("_last"))
        .select(SEGMENT, key, F.last("_last", ignorenulls=True).over(_earlier(key)).alias("_last_before"))
    )
    previous = F.coalesce(F.lag("_micros").over(_within(key, _by_time(ts, seq))), "_last_before")
    return (
        cut.join(carry, [SEGMENT, key], "left")
        .withColumn("_gap", F.col("_micros") - previous)
        .withColumn("gap_minutes", F.when(F.col(key).isNotNull(), F.col("_gap") / F.lit(_MINUTE)))
        .select(*rows.columns, "gap_minutes")
    )
