"""Rename plans for photo files. Only the plan table is made; no file is touched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions import text
from resight.operators.joins import first_match


def suffix_plan(files: DataFrame, suffix: str) -> DataFrame:
    """Add a suffix to every name in ``path``; names already taken in the folder are skipped."""
    folder = F.substring_index("path", "/", -1)
    parts = files.select(
        "path",
        F.expr("left(path, length(path) - length(substring_index(path, '/', -1)))").alias("folder"),
        folder.alias("old_name"),
        text.with_suffix("path", suffix).alias("new_name"),
    )
    taken = parts.select("folder", F.col("old_name").alias("new_name"), F.lit(True).alias("_taken")).distinct()
    return parts.join(taken, ["folder", "new_name"], "left").select(
        "path", "old_name", "new_name", F.coalesce("_taken", F.lit(False)).alias("skipped")
    )


def match_plan(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Wanted final names against current files by stem without '-n'; the first file in name
    order is used, and files already named right need no rename."""
    targets = wanted.select(
        text.base_name(F.trim("file_name")).alias("target_name"),
        text.rename_key("file_name").alias("key"),
    )
    current = files.select(
        text.base_name("path").alias("current_name"), text.rename_key("path").alias("key")
    )
    found = first_match(targets, current, "key", "current_name", "current_name", "found_in_dir")
    rename = F.col("found_in_dir") & (F.col("current_name") != F.col("target_name"))
    return found.select(
        "target_name", "current_name", "found_in_dir", F.coalesce(rename, F.lit(False)).alias("to_rename")
    )
