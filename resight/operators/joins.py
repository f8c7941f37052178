"""Join forms of the catalogue work. The physical strategy is left to the optimiser."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.operators.gates import require_unique
from resight.operators.skew import PART_ROWS, group_sizes, join_back


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which null keys match null keys; the keys appear once."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def many_to_one(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    check: bool = True,
    spread: Sequence[str] | None = None,
    part_rows: int | None = None,
) -> DataFrame:
    """Left join that must not multiply rows, null keys matching null keys; the right side is checked when asked.

    A key of n times ``part_rows`` left rows, the null key included, has them dealt over n salts by a hash of the ``spread``
    columns (all, unless given), and its right row repeated n times, so that no task gets a whole hot key.
    """
    keys = list(keys)
    if check:
        require_unique(right, keys)
    limit = part_rows or PART_ROWS
    sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    hot = sizes.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = F.pmod(F.xxhash64(*(spread or left.columns)), salts).cast("int")
    a = null_safe(left, hot, keys).withColumn("_salt", dealt).drop("_salts")
    b = null_safe(right, hot, keys).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return null_safe(a, b, [*keys, "_salt"]).drop("_salt")


PAIRS_PER_TASK = 10_000_000


def key_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n_left, n_right) of every key of either side, with map-side combine."""
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    both = left.select(key, one.alias("l"), zero.alias("r")).unionAll(right.select(key, zero.alias("l"), one.alias("r")))
    return both.groupBy(key).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def many_to_many(
    left: DataFrame, right: DataFrame, key: str, spread: Sequence[str], pairs_per_task: int | None = None
) -> DataFrame:
    """Inner join of sides that may both repeat a key, without one task for a key of very many pairs.

    A key with n times ``pairs_per_task`` pairs has its left rows dealt over n salts by a hash of the ``spread``
    columns and its right rows repeated n times. All other keys are joined as they are.
    """
    limit = pairs_per_task or PAIRS_PER_TASK
    counts = key_counts(left, right, key).filter(F.col("n_left") * F.col("n_right") > limit)
    n = F.least(F.ceil(F.col("n_left") * F.col("n_right") / limit), F.col("n_left")).cast("int")
    hot = counts.select(key, n.alias("_salts"))
    one = F.lit(1)
    dealt = F.pmod(F.xxhash64(*spread), F.coalesce("_salts", one)).cast("int")
    a = left.join(hot, key, "left").withColumn("_salt", dealt).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", one) - 1))
    b = right.join(hot, key, "left").withColumn("_salt", copies).drop("_salts")
    return a.join(b, [key, "_salt"]).drop("_salt")


def ids_present(rows: DataFrame, ids: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """Rows whose ID is in the list (semi join), large individuals split over tasks."""
    sizes = group_sizes(rows, [key])
    wanted = sizes.join(ids.select(key).distinct(), key, "left_semi").withColumn("_wanted", F.lit(True))
    return join_back(rows, wanted, [key], spread, sizes=sizes).filter("_wanted").drop("_wanted")


def ids_missing(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """IDs that the other side lacks (anti join); ``rows`` is a list of IDs, not of records."""
    return rows.join(ids.select(key).distinct(), key, "left_anti")


# Set operations reduce both sides to distinct IDs before the join they become, so the records of
# one individual shrink to a row in the task that reads them. Null counts as a value.


def id_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().subtract(right.select(key).distinct())


def id_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().intersect(right.select(key).distinct())


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns a natural join would use."""
    return [c for c in left.columns if c in set(right.columns)]


def apply_corrections(
    rows: DataFrame, corrections: DataFrame, keys: Sequence[str], column: str, new: str = "new_value", check: bool = True
) -> DataFrame:
    """Manual corrections: where (keys, current value) is listed, take the new value.

    ``corrections`` has the keys, ``column`` (value to replace, optional) and ``new``. Rows without a listed
    correction, null keys included, stay as they are. A correction listed twice with one new value counts once;
    with different ones it is an error, unless the table was checked before (``check=False``). The join is left to adaptive execution: a short list is broadcast by
    its measured size, with a longer one large groups are split.
    """
    on = [*keys, column] if column in corrections.columns else list(keys)
    listed = corrections.select(*on, F.col(new).alias("_new")).distinct()
    if check:
        require_unique(listed, on)
    joined = rows.join(listed.withColumn("_hit", F.lit(True)), on, "left")
    return joined.withColumn(
        column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    ).select(*rows.columns)


def first_match(
    targets: DataFrame, current: DataFrame, key: str, value: str, order: str, found: str = "found"
) -> DataFrame:
    """Look up the first row of ``current`` for each target key, with a found flag."""
    firsts = current.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(value, order).alias(value)
    )
    return targets.join(firsts.withColumn(found, F.lit(True)), key, "left").withColumn(
        found, F.coalesce(found, F.lit(False))
    )
