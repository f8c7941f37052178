"""Joining per-group values back onto rows without sending a hot group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group is split into parts of about this many rows. The list of groups that need splitting is
# the only broadcast: it cannot hold more than (rows / PART_ROWS) keys, whatever the data.
PART_ROWS = 4_000_000


def group_sizes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per group with a known key, as ``group_rows``."""
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))


def _parts(part_rows: int) -> Column:
    return F.ceil(F.col("group_rows") / F.lit(part_rows)).cast("int")


def mark_large(
    rows: DataFrame, keys: Sequence[str], sizes: DataFrame, part_rows: int | None = None
) -> DataFrame:
    """Add ``_parts``: the number of parts of a large group, null for all other rows."""
    part_rows = part_rows or PART_ROWS
    large = sizes.filter(F.col("group_rows") > part_rows)
    return rows.join(
        F.broadcast(large.select(*keys, _parts(part_rows).alias("_parts"))), list(keys), "left"
    )


def join_back(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    sizes: DataFrame | None = None,
    part_rows: int | None = None,
) -> DataFrame:
    """Left join of one row per group onto the detail rows.

    ``groups.group_rows`` is the number of detail rows of the group. A group of n parts has its
    detail rows dealt over n salts by a hash of the ``spread`` columns and its group row repeated n
    times, so no task gets more than a part of it. Rows with a null key match nothing and are
    spread freely. Where ``groups`` comes from a long plan, ``sizes`` may give the same counts
    more cheaply.
    """
    keys, part_rows = list(keys), part_rows or PART_ROWS
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    dealt = F.xxhash64(*spread)
    salt = (
        F.when(F.col("_parts").isNotNull(), F.pmod(dealt, F.col("_parts")))
        .when(no_key, F.pmod(dealt, F.lit(1 << 30)))
        .otherwise(F.lit(0))
    )
    marked = mark_large(rows, keys, groups if sizes is None else sizes, part_rows)
    salted = marked.withColumn("_salt", salt.cast("int"))
    last = F.greatest(_parts(part_rows) - 1, F.lit(0))
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    added = [c for c in groups.columns if c not in (*keys, "group_rows")]
    return salted.join(copies, [*keys, "_salt"], "left").select(*rows.columns, *added)


def attach_group(
    rows: DataFrame,
    keys: Sequence[str],
    values: Sequence[Column],
    spread: Sequence[str],
    **options: int,
) -> DataFrame:
    """Grouped mutate: aggregate per group (with map-side combine), then join back.

    Rows whose key is null get null values: nothing is ever spread over unidentified rows.
    """
    known = rows
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    groups = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"), *values)
    return join_back(rows, groups, keys, spread, **options)
