"""One sampled record per individual and year, with label, span and minimum age."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions import dates, keywords as kw
from resight.operators.gates import require_single
from resight.operators.groups import class_of_first_year, sample_one
from resight.operators.joins import apply_corrections
from resight.operators.skew import attach_group

COLUMNS = [
    "title", "side", "year", "sex", "min_year", "max_year", "year_span", "minimum_age",
    "age_class", "yday",
]


def side_photos(listing: DataFrame, side: str, fixes: DataFrame | None = None) -> DataFrame:
    """Photos of one side with label, age class and date parts.

    Crops and unidentified photos go, and so do rows without a title.
    """
    keyword = F.col("keyword_export")
    date = dates.listing_date("date_original")
    rows = listing.filter((F.col("title") != "see crops") & (F.lower("title") != "unk")).select(
        "photo_seq",
        "title",
        kw.side_last_wins(keyword).alias("side"),
        F.year(date).alias("year"),
        F.dayofyear(date).alias("yday"),
        kw.label(keyword, "metadata").alias("sex"),
        kw.age_class(keyword).alias("age_class"),
    )
    rows = rows.filter(F.col("side") == side)
    if fixes is not None:
        rows = apply_corrections(rows, fixes, ["title", "year"], "age_class")
    return rows


def with_ages(rows: DataFrame) -> DataFrame:
    out = attach_group(
        rows,
        ["title"],
        [
            F.min("year").alias("min_year"),
            F.max("year").alias("max_year"),
            class_of_first_year("year", "age_class").alias("first_year_class"),
        ],
        ["photo_seq"],
    )
    return out.withColumns(
        {
            "year_span": dates.year_span(F.col("min_year"), F.col("max_year")),
            "young": kw.is_young("age_class"),
            "minimum_age": kw.minimum_age(F.col("first_year_class"), F.col("year"), F.col("min_year")),
        }
    )


def individual_year_metadata(
    listing: DataFrame, side: str, seed: int = 0, fixes: DataFrame | None = None, check: bool = False
) -> DataFrame:
    """One record per (individual, year). The sampled record is the same on every run.

    Undated photos form a year of their own, without an age.
    """
    rows = with_ages(side_photos(listing, side, fixes))
    if check:
        require_single(rows, ["title"], "sex")
        require_single(rows, ["title", "year"], "minimum_age")
    keep = [c for c in COLUMNS if c not in ("title", "year")]
    return sample_one(rows, ["title", "year"], "photo_seq", keep, seed).select(*COLUMNS)


def individual_years(listing: DataFrame, side: str) -> DataFrame:
    """The part of the metadata that does not depend on which record is sampled."""
    rows = with_ages(side_photos(listing, side))
    return rows.groupBy("title", "year").agg(
        F.min("min_year").alias("min_year"),
        F.max("max_year").alias("max_year"),
        F.max("year_span").alias("year_span"),
        F.max("minimum_age").alias("minimum_age"),
        F.count(F.lit(1)).alias("n"),
    )
