"""Grouped operators: first rows, whole-group values, ordered text lists, distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.functions.keywords import FEMALE, MALE, UNKNOWN, known
from resight.operators.order import Order
from resight.operators.skew import attach_group


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- aggregate expressions ----------------------------------------------------------------


def n_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def strict_min(c: Column | str) -> Column:
    """Minimum that is null when any value is null."""
    c = _col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.min(c))


def strict_max(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.max(c))


def distinct_with_null(c: Column | str) -> Column:
    """Distinct count in which null is a value."""
    c = _col(c)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def first_value(c: Column | str, order: Order, where: Column | None = None) -> Column:
    """First non-null value in the given order; null when there is none."""
    c = _col(c)
    ok = c.isNotNull() if where is None else c.isNotNull() & where
    return F.min_by(c, F.when(ok, order.key()))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def any_of(condition: Column) -> Column:
    return F.coalesce(F.bool_or(F.coalesce(condition, F.lit(False))), F.lit(False))


def sorted_labels(c: Column | str, separator: str = " & ") -> Column:
    """Distinct values, sorted, joined. Only for columns with a small fixed set of values."""
    return F.array_join(F.array_sort(F.collect_set(_col(c))), separator)


# ---- frames -------------------------------------------------------------------------------


def first_distinct_text(
    rows: DataFrame, keys: Sequence[str], text: str, order: Order, k: int, out: str, separator: str = " | "
) -> DataFrame:
    """First k distinct texts per group, in order, joined (null is a text here, shown as NA).

    Texts are made distinct before the per-group ranking, and the rank limit is applied on the
    map side, so a group with many distinct texts never travels whole.
    """
    key = order.key()
    firsts = rows.groupBy(*keys, text).agg(F.min(key).alias("_at"))
    w = Window.partitionBy(*keys).orderBy("_at")
    best = firsts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)
    shown = F.struct("_rank", F.coalesce(F.col(text), F.lit("NA")).alias("t"))
    return best.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(shown)), lambda s: s["t"]), separator
        ).alias(out)
    )


def first_row(rows: DataFrame, keys: Sequence[str], order: Order, columns: Sequence[str]) -> DataFrame:
    """One row per group, the first in order, as an aggregate (partial on the map side)."""
    picked = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*columns), order.key()).alias("_first"),
    )
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns])


def sample_one(
    rows: DataFrame, keys: Sequence[str], row_key: str, columns: Sequence[str], seed: int = 0
) -> DataFrame:
    """One pseudo-random row per group: the smallest MD5 of seed and row key.

    A retried task, or a second run, picks the same row.
    """
    draw = F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_key).cast("string"))), F.col(row_key))
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), draw).alias("_one"))
    return picked.select(*keys, *[F.col(f"_one.{c}").alias(c) for c in columns])


def repeated_groups(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group has more than one row."""
    many = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return counts.join(many, list(keys), "left_semi")


def group_bounds(rows: DataFrame, keys: Sequence[str], column: str, spread: Sequence[str]) -> DataFrame:
    """Group minimum, maximum and inclusive span on every row."""
    lo, hi = F.min(column), F.max(column)
    return attach_group(
        rows, keys, [lo.alias(f"min_{column}"), hi.alias(f"max_{column}")], spread
    ).withColumn(f"{column}_span", F.col(f"max_{column}") - F.col(f"min_{column}") + 1)


PRECEDENCE = (UNKNOWN, FEMALE, MALE)  # weakest first


def label_rank(label: Column | str, ranking: Sequence[str] = PRECEDENCE) -> Column:
    """Position in the precedence, null for null. Numbers aggregate in place, texts do not."""
    out = F
    for i, name in enumerate(ranking):
        out = out.when(_col(label) == name, i)
    return out


def label_of_rank(rank: Column, ranking: Sequence[str] = PRECEDENCE) -> Column:
    return F.get(F.array(*[F.lit(name) for name in ranking]), rank)


def precedence_label(
    rows: DataFrame, key: str, label: str, spread: Sequence[str], ranking: Sequence[str] = PRECEDENCE
) -> DataFrame:
    """Overwrite the label on every row by the strongest label of the group."""
    best = F.max(F.coalesce(label_rank(label, ranking), F.lit(0))).alias("_rank")
    out = attach_group(rows, [key], [best], spread)
    return out.withColumn(
        label,
        F.when(F.col("_rank").isNull(), F.col(label)).otherwise(label_of_rank(F.col("_rank"), ranking)),
    ).drop("_rank")


def first_known_label(
    rows: DataFrame, key: str, label: str, order: Order, spread: Sequence[str]
) -> DataFrame:
    """Overwrite the label on every row by the first known label of the group, else keep UNK."""
    first = first_value(label, order, known(label)).alias("_known")
    out = attach_group(rows, [key], [first], spread)
    return out.withColumn(
        label, F.when(F.col(key).isNull(), F.col(label)).otherwise(F.coalesce("_known", F.lit(UNKNOWN)))
    ).drop("_known")


def class_of_first_year(year: str, cls: str) -> Column:
    """Aggregate: class in the first known year."""
    return F.min_by(F.col(cls), F.when(F.col(year).isNotNull(), F.struct(year, cls)))


def first_year_class(
    rows: DataFrame, key: str, year: str, cls: str, spread: Sequence[str], out: str = "first_year_class"
) -> DataFrame:
    """Class of the first year on every row of the individual (single-valued by contract)."""
    return attach_group(rows, [key], [class_of_first_year(year, cls).alias(out)], spread)


def first_reliable_year(
    rows: DataFrame, keys: Sequence[str], year: str, is_reliable: Column, out: str = "year_reliable"
) -> DataFrame:
    """First year with a reliable photo per group, null when there is none."""
    return rows.groupBy(*keys).agg(F.min(F.when(is_reliable, F.col(year))).alias(out))
