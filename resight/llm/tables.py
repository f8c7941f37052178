"""Reading the given tables, and column expressions several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


FILTER_BITS = 20


def _hash(column: str) -> Column:
    return F.xxhash64(column, F.lit(1))


def _slot(column: str) -> Column:
    return F.pmod(_hash(column), F.lit(1 << FILTER_BITS)).cast("int")


def _bit(column: str) -> Column:
    place = F.shiftrightunsigned(_hash(column), 40).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def slots(rows: DataFrame, column: str) -> DataFrame:
    """The hash slots that a column fills, as at most 2^FILTER_BITS small rows of 64 slots each, marked for a broadcast.

    For pre-filters whose broadcast must not grow with the data: with some 2^(FILTER_BITS + 5) values a third of the others
    passes, with many more all do.
    """
    return F.broadcast(rows.groupBy(_slot(column).alias("slot")).agg(F.bit_or(_bit(column)).alias("bits")))


def touched(column: str) -> Column:
    """Join condition with :func:`slots`: true for every value that is in them, and for few others."""
    return (_slot(column) == F.col("slot")) & (_bit(column).bitwiseAND(F.col("bits")) != 0)
