"""Folders of import sheets with headers of their own, read in one pass whatever the number of files.

The first line of every file is its header and stays in a table: neither file names nor headers reach the driver.
Each line meets its file's header in a join, is cut into fields, and gives the wanted columns by name. A line whose
number of fields differs from the header's keeps its text in ``bad_record``. A file that cannot be read is skipped by
the readers and appears in :func:`file_status`, which starts from the inventory of the folder.

A record is a line here; sheets with line breaks in quotes are read by
:func:`resight.sources.readers.read_listing`. A compressed file that breaks off in the middle delivers what
comes before the break, and counts as read. A file without bytes is no file to the readers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resight.session import saved

_FIELD = r',("(?:[^"\\]|\\.|"")*+"|[^,]*+)'
_MARK = "﻿"  # byte order mark


@dataclass(frozen=True)
class Sheets:
    rows: DataFrame  # wanted columns, bad_record, source_file
    headers: DataFrame  # file, header, names
    inventory: DataFrame  # file


def fields_of(line: Column) -> Column:
    """Fields of a CSV line as text; blank and 'NA' both mean missing."""
    plain = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))

    def value(x: Column) -> Column:
        inner = F.regexp_replace(F.substr(x, F.lit(2), F.length(x) - 2), r'\\(.)|"(")', "$1$2")
        text = F.when(x.startswith('"'), inner).otherwise(F.trim(x))
        return F.when(~text.isin("", "NA"), text)

    return F.transform(plain, value)


def snake_names(names: Column) -> Column:
    """As :func:`resight.sources.readers.snake`, for an array of header names."""

    def name(x: Column) -> Column:
        return F.trim(F.regexp_replace(F.lower(F.trim(x)), "[^0-9a-z]+", "_"), F.lit("_"))

    return F.transform(names, name)


SHEETS = "*.{csv,csv.gz}"


def _files(spark: SparkSession, glob: str, modified_after: str | None):
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true")
    return files.option("modifiedAfter", modified_after).option("timeZone", "UTC") if modified_after else files


def read_sheets(
    spark: SparkSession, root: str, wanted: Sequence[str], glob: str = SHEETS, modified_after: str | None = None
) -> Sheets:
    """All sheets under a folder, or those modified after a time (UTC); ``wanted`` are snake_case names, absent ones are null."""
    files = _files(spark, glob, modified_after)
    lines = files.text(root).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_at")
    )
    first = lines.filter("_at = 0").groupBy("source_file").agg(F.first("value").alias("header"))
    names = snake_names(fields_of(F.regexp_replace("header", f"^{_MARK}", "")))
    headers = saved(first.withColumn("names", names))

    fields = fields_of(F.col("value"))
    rows = (
        lines.join(headers, "source_file")
        .filter((F.col("_at") > 0) | (F.col("value") != F.col("header")))  # also drops a header that is repeated
        .filter(F.trim("value") != "")
        .withColumn("_fields", fields)
    )
    picked = [F.get("_fields", (F.array_position("names", c) - 1).cast("int")).alias(c) for c in wanted]
    bad = F.when(F.size("_fields") != F.size("names"), F.col("value")).alias("bad_record")
    inventory = files.format("binaryFile").load(root).select(F.col("_metadata.file_path").alias("source_file"))
    return Sheets(rows.select(*picked, bad, "source_file"), headers, inventory)


def bad_records(sheets: Sheets) -> DataFrame:
    """Lines of the wrong width, with their file."""
    return sheets.rows.filter(F.col("bad_record").isNotNull()).select("source_file", "bad_record")


def unreadable(sheets: Sheets) -> DataFrame:
    """Files that delivered no line."""
    return sheets.inventory.join(sheets.headers, "source_file", "left_anti")


def file_status(sheets: Sheets, name: str = "file_name") -> DataFrame:
    """Every file of the folder: ``state`` ('read' or 'unreadable'), rows, rows of the wrong width and rows without a
    ``name``."""
    counts = sheets.rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("bad_record").alias("n_bad"), F.count_if(F.col(name).isNull()).alias("n_unnamed")
    )
    state = F.when(F.col("names").isNotNull(), "read").otherwise("unreadable")
    return (
        sheets.inventory.join(sheets.headers, "source_file", "left")
        .join(counts, "source_file", "left")
        .select("source_file", state.alias("state"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_bad", "n_unnamed")])
    )
