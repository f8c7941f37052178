"""Outputs per input file, brought up to date: only files that are new or changed are read and written again.

A run lists the input files with size and time and compares them with the manifest of the run before. Rows of changed files
go to a folder named by file and state, so a run that is repeated after a failure writes the same folders again.
The manifest is written last: until then readers see the state before. Files that are gone, and older states, stay on
disk but are in no manifest, so :func:`current` leaves them out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resight.functions.text import path_name
from resight.session import saved


def inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``source_file``, ``modified`` (microseconds) and ``version`` (path, size and time) of every file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    file = files.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
    )
    state = F.concat_ws("|", "source_file", "size", "modified")
    return file.select("source_file", "modified", F.concat(F.lit("v"), F.md5(state)).alias("version"))


def _manifest(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """The newest manifest and its number; an empty one with number 0 before the first run."""
    try:
        runs = spark.read.schema("source_file string, version string, run int").parquet(f"{folder}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "source_file string, version string"), 0
    run = runs.agg(F.max("run")).first()[0]
    return runs.filter((F.col("run") == run) & F.col("version").isNotNull()).select("source_file", "version"), run


def changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """Every file of either list with its ``state``: new, changed, same or gone."""
    both = now.join(before.withColumnRenamed("version", "old"), "source_file", "full_outer")
    state = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("version").isNull(), "gone")
        .when(F.col("version") == F.col("old"), "same")
        .otherwise("changed")
    )
    return both.select("source_file", "modified", "version", state.alias("state"))


def refresh(
    spark: SparkSession, root: str, folder: str, read: Callable[[str], DataFrame], glob: str = "*"
) -> DataFrame:
    """Bring the outputs in ``folder`` up to date; the files of this and the last run with their state.

    ``read`` is given a time (UTC, ISO) and returns the rows, with ``source_file``, of at least all files modified after it; handed
    to the reader as ``modifiedAfter``, it keeps older files out of the scan.
    """
    before, run = _manifest(spark, folder)
    found = saved(changes(inventory(spark, root, glob), before))  # one listing decides what is written and what the manifest says
    stale = found.filter(F.col("state").isin("new", "changed"))
    oldest = stale.agg(F.min("modified")).first()[0]
    if oldest is not None:
        after = dt.datetime.fromtimestamp(oldest // 1_000_000 - 1, dt.UTC).strftime("%Y-%m-%dT%H:%M:%S")
        rows = read(after).join(stale.select("source_file", "version"), "source_file")
        named = rows.withColumn("source", path_name("source_file"))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "version").parquet(
            f"{folder}/per_file"
        )
    live = found.filter("state <> 'gone'").select("source_file", "version")
    mark = spark.createDataFrame([(None, None)], live.schema)  # a run without files is a run as well
    live.union(mark).write.mode("overwrite").parquet(f"{folder}/manifest/run={run + 1}")
    return found.select("source_file", "state")


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The compiled rows of all files as the last manifest has them. There must have been rows in some run."""
    manifest, _ = _manifest(spark, folder)
    rows = spark.read.parquet(f"{folder}/per_file")
    return rows.join(manifest.select("version"), "version", "left_semi").drop("source", "version")
