"""Writing snapshots, exports and lists. Every write is one file per task, never a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resight.functions.text import path_name


def write_snapshot(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ("photo_seq",)
) -> None:
    """Parquet between cleaning and later steps; partition by year for year filters.

    Rows are range-partitioned by (partition columns, ``cluster_by``) first: a task then writes to
    one or two partitions instead of to all, and a year with very many rows is still cut into many
    tasks. ``cluster_by`` should be unique, or nearly so.
    """
    if partition_by:
        ranged = df.repartitionByRange(*partition_by, *cluster_by)
        ranged.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, folder: str, name: str, version: str, null: str = "NA") -> str:
    path = f"{folder}/{name}_{version}"
    df.write.mode("overwrite").option("header", True).option("nullValue", null).csv(path)
    return path


def write_ordered(df: DataFrame, folder: str, name: str, version: str, order: Sequence[Column], null: str = "NA") -> str:
    """As :func:`write_csv`, sorted over all part files: each holds a range of the order, in order.

    With an order that leaves ties, rows that tie may change places between runs.
    """
    return write_csv(df.orderBy(*order), folder, name, version, null)


def read_ordered(spark: SparkSession, path: str, schema: str, number: str = "row_no", null: str = "NA") -> DataFrame:
    """An export of :func:`write_ordered` with the number of each row, from 1, without sorting the rows again.

    A row's place is its place in its piece of a part file, plus the rows of all pieces before: only the counts of the pieces
    (one row per file and split) are summed up in order. Values must be free of line breaks.
    """
    rows = spark.read.csv(path, schema=schema, header=True, nullValue=null)
    placed = rows.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),  # without gaps inside a piece
    )
    pieces = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    part = F.regexp_extract("_file", "^part-([0-9]+)", 1).cast("int")
    before = Window.orderBy(part, "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1
    starts = pieces.select("_file", "_block", shift.alias("_shift"))
    return placed.join(starts, ["_file", "_block"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(number))


def write_ids(df: DataFrame, column: str, path: str) -> None:
    """One ID per line."""
    df.filter(F.col(column).isNotNull()).select(F.col(column).cast("string")).write.mode(
        "overwrite"
    ).text(path)


def write_per_source(df: DataFrame, folder: str, source: str = "source_file") -> tuple[str, str]:
    """One output per input file (a folder each, named by the file's whole path, so equal names in
    different folders stay apart) and one compiled output.

    A task reads few input files, so it writes to few folders without a shuffle.
    """
    per_file, compiled = f"{folder}/per_file", f"{folder}/compiled"
    named = df.withColumn("source", path_name(source)).drop(source)
    named.write.mode("overwrite").partitionBy("source").option("header", True).csv(per_file)
    named.drop("source").write.mode("overwrite").option("header", True).csv(compiled)
    return per_file, compiled
