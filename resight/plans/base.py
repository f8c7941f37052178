"""Listing to clean photo table, and the lists a reviewer gets from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions import dates, ids, keywords as kw, ratings
from resight.operators.groups import first_distinct_text, first_value
from resight.operators.joins import ids_present, null_safe
from resight.operators.order import by_sequence

FILE_ORDER = by_sequence("photo_seq")


def derive(listing: DataFrame) -> DataFrame:
    """All derived columns of the newest cleaning rules in one projection; no row is dropped."""
    keyword = F.col("keyword_export")
    typed = listing.select(
        "photo_seq",
        "file_name",
        F.col("title").alias("id_original"),
        ids.canonical_id("title").alias("id"),
        "date_original",
        dates.listing_date("date_original").alias("date"),
        keyword.alias("keyword"),
        kw.side(keyword).alias("side"),
        ratings.stars("rating").alias("qrate"),
        kw.reliable(keyword).alias("reliable"),
        kw.biopsy(keyword).alias("biopsy"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        kw.label(keyword, "listing_2025").alias("sex"),
        kw.label(keyword, "morphology_2025").alias("melon_sex"),
    )
    return typed.withColumns(
        {
            "year": F.year("date"),
            "film": kw.medium("keyword", F.year("date")),
            "location": kw.place("keyword", "longitude"),
            "genetic_sex": kw.genetic_label("sex", "biopsy"),
        }
    )


def clean_base(listing: DataFrame, drop_invalid_ids: bool = True) -> DataFrame:
    """Photos with a known side and, by default, a valid individual."""
    out = derive(listing).filter(F.col("side") != kw.UNKNOWN)
    return out.filter(F.col("id").isNotNull()) if drop_invalid_ids else out


def non_numeric_ids(derived: DataFrame) -> DataFrame:
    """Identifiers that are no numbers, with photo counts."""
    return (
        derived.filter(F.col("id").isNull())
        .groupBy("id_original")
        .agg(F.count(F.lit(1)).alias("n_photos"))
    )


def _with_samples(rows: DataFrame, k: int, *extra) -> DataFrame:
    keys = ["id", "id_original"]
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_photos"),
        *extra,
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
    samples = first_distinct_text(rows, keys, "keyword", FILE_ORDER, k, "sample_keywords")
    return null_safe(counts, samples, keys)


def photos_without_side(derived: DataFrame) -> DataFrame:
    return _with_samples(derived.filter(F.col("side") == kw.UNKNOWN), 3)


def photos_without_location(derived: DataFrame) -> DataFrame:
    lost = derived.filter((F.col("side") != kw.UNKNOWN) & (F.col("location") == "??"))
    return _with_samples(
        lost,
        2,
        F.count("latitude").alias("has_lat"),
        F.count("longitude").alias("has_long"),
        first_value("latitude", FILE_ORDER).alias("sample_lat"),
        first_value("longitude", FILE_ORDER).alias("sample_long"),
    )


def biopsied_without_genetic_label(base: DataFrame) -> DataFrame:
    """Biopsied individuals without a genetic label, by what their photos do say."""
    unresolved = (
        base.groupBy("id")
        .agg(F.count("biopsy").alias("b"), F.count("genetic_sex").alias("g"))
        .filter("b > 0 and g = 0")
    )
    biopsied = base.filter(F.col("biopsy").isNotNull())
    return (
        ids_present(biopsied, unresolved, "id", ["photo_seq"])
        .groupBy("id", "sex", "melon_sex")
        .agg(
            F.count(F.lit(1)).alias("n_photos"),
            first_value("keyword", FILE_ORDER).alias("sample_keyword"),
        )
    )


def summary(rows: DataFrame) -> DataFrame:
    """Whole-table figures: rows, individuals, date and year range."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_distinct("id").alias("n_ids"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def frequency(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
