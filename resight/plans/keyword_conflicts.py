"""Conflicting label keywords within a photo, within an individual and over its years."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.functions import dates, keywords as kw


def flagged_photos(listing: DataFrame) -> DataFrame:
    """Listing with the twelve keyword flags and the three indicators."""
    flags = listing.select(
        "photo_seq",
        "file_name",
        F.col("title").alias("id"),
        F.col("keyword_export").alias("keyword"),
        dates.year_in_text("file_name").alias("year"),
        *kw.keyword_flags("keyword_export"),
    )
    return flags.select("*", *kw.indicators())


def photo_conflicts(flagged: DataFrame) -> DataFrame:
    kinds = sum(
        (F.col(c).cast("int") for c in ("has_melon_f", "has_melon_m", "has_melon_unk")), F.lit(0)
    )
    conflict = (
        (kinds > 1)
        | (F.col("has_melon_f") & kw.any_flag("has_m2", "has_m3", "has_malem"))
        | (F.col("has_melon_m") & kw.any_flag("has_f2", "has_f3", "has_femalej"))
    )
    return flagged.filter(conflict).select(
        "file_name", "id", "year", "current_sex", "old_keyword_sex", "summary_sex", "keyword"
    )


def _female_words() -> Column:
    return kw.any_flag("has_f2", "has_f3", "has_femalej", "has_sum_f")


def _male_words() -> Column:
    return kw.any_flag("has_m2", "has_m3", "has_malem", "has_sum_m")


def _counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_photos"),
        F.count_if("has_melon_f").alias("n_melon_f"),
        F.count_if("has_melon_m").alias("n_melon_m"),
        F.count_if("has_melon_unk").alias("n_melon_unk"),
        F.count_if("has_sum_unk").alias("n_sum_unk"),
        F.count_if(_female_words()).alias("n_female_keywords"),
        F.count_if(_male_words()).alias("n_male_keywords"),
    )


def _in_conflict(count: Callable[[str], Column] = F.col) -> Column:
    """A definite morphology label against the other sex, against unknown, or both at once."""
    f, m = count("n_melon_f") > 0, count("n_melon_m") > 0
    unknown = (count("n_melon_unk") > 0) | (count("n_sum_unk") > 0)
    return (
        (f & (count("n_male_keywords") > 0))
        | (m & (count("n_female_keywords") > 0))
        | (f & m)
        | ((f | m) & unknown)
    )


def id_conflicts(flagged: DataFrame) -> DataFrame:
    return _counts(flagged, "id").withColumn("has_conflict", _in_conflict()).filter("has_conflict")


def conflict_timeline(flagged: DataFrame) -> DataFrame:
    """All years of the individuals in conflict, each year flagged for itself.

    The window sums the yearly counts, a row per year of the individual.
    """
    w = Window.partitionBy("id")
    years = _counts(flagged, "id", "year").withColumns(
        {"wanted": _in_conflict(lambda c: F.sum(c).over(w)), "year_has_conflict": _in_conflict()}
    )
    return years.filter("wanted and year is not null").select(
        "id",
        "year",
        "n_photos",
        "n_melon_f",
        "n_melon_m",
        "n_melon_unk",
        F.col("n_female_keywords").alias("n_fj"),
        F.col("n_male_keywords").alias("n_mm"),
        F.col("n_sum_unk").alias("n_unk"),
        "year_has_conflict",
    )
