"""Data-quality gates: each is one small aggregate that must come back empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions.keywords import known
from resight.session import saved_counting


class GateError(ValueError):
    """A data-quality gate did not pass."""


def label_conflicts(rows: DataFrame, key: str, label: str, ignore_unknown: bool = False) -> DataFrame:
    """Groups with more than one label. UNK counts as a label unless ``ignore_unknown``."""
    labelled = rows.filter(F.col(key).isNotNull()).filter(
        known(label) if ignore_unknown else F.col(label).isNotNull()
    )
    return labelled.groupBy(key).agg(F.count_distinct(label).alias("n_labels")).filter("n_labels > 1")


def _halt(bad: DataFrame, what: str) -> None:
    """Raise if the table has rows: all of them are written, the message has their number and place."""
    found, seen = saved_counting(bad, F.count(F.lit(1)).alias("n"))
    if seen["n"]:
        first = ", ".join("/".join(str(v) for v in r) for r in found.orderBy(*found.columns).limit(20).collect())
        raise GateError(f"{what}: {seen['n']} groups, all listed in {found.inputFiles()[0].rsplit('/', 1)[0]}; first: {first}")


def halt_on_conflicts(rows: DataFrame, key: str, label: str, ignore_unknown: bool = False) -> DataFrame:
    """Raise when labels conflict, naming the table of all conflicting IDs; otherwise hand the rows on."""
    _halt(label_conflicts(rows, key, label, ignore_unknown).select(key), "propagation halted, conflicting labels")
    return rows


def multi_valued(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Groups in which the column (null counted as a value) is not single."""
    value = F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))
    return rows.groupBy(*keys).agg(value.alias("n_values")).filter("n_values > 1")


def require_single(rows: DataFrame, keys: Sequence[str], column: str) -> None:
    _halt(multi_valued(rows, keys, column).select(*keys), f"{column} is not single-valued")


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    _halt(duplicate_keys(rows, keys).select(*keys), f"keys ({', '.join(keys)}) are not unique")


def require_columns(rows: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise GateError(f"missing columns in {what}: {', '.join(missing)}")
    return rows
