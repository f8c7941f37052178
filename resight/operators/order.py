"""The total order of a listing.

File order is not kept by a distributed engine, so every order-dependent operator takes an ``Order``: the columns
rows are sorted by, nulls last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Order:
    columns: tuple[str, ...]

    def key(self) -> Column:
        """Comparable value of the order, nulls last."""
        if len(self.columns) == 1:
            return F.col(self.columns[0])  # a sequence number, never null
        parts = []
        for i, c in enumerate(self.columns):
            parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"c{i}")]
        return F.struct(*parts)

    def ascending(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in self.columns]

    def descending(self) -> list[Column]:
        return [F.col(c).desc_nulls_first() for c in self.columns]


def by_date(date: str = "date", seq: str = "photo_seq") -> Order:
    """(date, unique sequence number)."""
    return Order((date, seq))


def by_sequence(seq: str = "photo_seq") -> Order:
    """A unique sequence number alone."""
    return Order((seq,))
