"""Two catalogues side by side: label mismatch, per-ID labels, biopsy reconciliation, year checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resight.functions import dates, ids, keywords as kw, ratings
from resight.operators.groups import (
    any_of,
    distinct_with_null,
    first_value,
    label_of_rank,
    label_rank,
    repeated_groups,
)
from resight.operators.joins import ids_missing
from resight.operators.order import by_sequence
from resight.operators.scans import fill_group
from resight.sources.readers import find_columns

FILE_ORDER = by_sequence("photo_seq")


def clean_catalogue(listing: DataFrame, rule_set: str = "catalogue_tags") -> DataFrame:
    """Catalogue listing: placeholder IDs to null, side needed, label by the given rule set."""
    keyword = F.col("keyword_export")
    date = dates.listing_date("date_original")
    return listing.select(
        "photo_seq",
        "file_name",
        ids.null_placeholder("title").alias("id"),
        date.alias("date"),
        F.year(date).alias("year"),
        kw.side(keyword, ignore_case=True).alias("side"),
        ratings.stars("rating").alias("qrate"),
        kw.biopsy(keyword, ignore_case=True).alias("biopsy"),
        kw.label(keyword, rule_set).alias("sex"),
        keyword.alias("keyword"),
    ).filter(F.col("side") != kw.UNKNOWN)


def clean_dorsal(listing: DataFrame) -> DataFrame:
    """Dorsal catalogue: as above without placeholder IDs, plus marks, place, medium and filled
    biopsy and label; labels of an individual are filled in file order, down and then up."""
    keyword = F.col("keyword_export")
    date = dates.listing_date("date_original")
    typed = listing.select(
        "photo_seq",
        "file_name",
        ids.null_placeholder("title").alias("id"),
        "date_original",
        date.alias("date"),
        F.year(date).alias("year"),
        kw.side(keyword, ignore_case=True).alias("side"),
        ratings.stars("rating").alias("qrate"),
        kw.reliable(keyword).alias("reliable"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        kw.biopsy(keyword, ignore_case=True).alias("biopsy"),
        kw.label(keyword, "dorsal_tags").alias("sex"),
        keyword.alias("keyword"),
    ).filter((F.col("side") != kw.UNKNOWN) & F.col("id").isNotNull())
    placed = typed.withColumns(
        {
            "location": kw.place("keyword", "longitude"),
            "film": kw.medium("keyword", "year"),
        }
    )
    filled = fill_group(placed, "id", ["sex", "biopsy"], FILE_ORDER, "downup")
    sex = F.coalesce("sex", F.lit(kw.UNKNOWN))
    return filled.withColumns(
        {
            "sex": sex,
            "sex_genetic": F.coalesce(kw.genetic_label(sex, "biopsy"), F.lit(kw.UNKNOWN)),
            "id_side": ids.id_side("id", "side"),
        }
    )


def id_labels(rows: DataFrame, how: str) -> DataFrame:
    """One label per individual: 'precedence' (MaleM before FemaleJ) or 'first_known'.

    The same labels as overwriting every photo and then taking distinct pairs, without the
    overwrite.
    """
    labelled = rows.filter(F.col("id").isNotNull())
    if how == "precedence":
        best = label_of_rank(F.max(F.coalesce(label_rank("sex"), F.lit(0))))
    else:
        best = F.coalesce(first_value("sex", FILE_ORDER, kw.known("sex")), F.lit(kw.UNKNOWN))
    return labelled.groupBy("id").agg(best.alias("sex"))


def label_mismatch(annual: DataFrame, primary: DataFrame) -> DataFrame:
    """Individuals in both catalogues whose labels differ."""
    a = id_labels(annual, "first_known").withColumnRenamed("sex", "sex_annual")
    p = id_labels(primary, "precedence").withColumnRenamed("sex", "sex_primary")
    return a.join(p, "id").filter("sex_annual != sex_primary")


def format_keywords(listing: DataFrame) -> DataFrame:
    """Short label codes, and keywords delimited by semicolons for import elsewhere."""
    return listing.select(
        "photo_seq",
        ids.null_placeholder("title").alias("id"),
        kw.label("keyword_export", "short_codes").alias("sex"),
        kw.delimiter_to_semicolon("keyword_export").alias("keywords"),
    )


def label_counts(formatted: DataFrame) -> DataFrame:
    return formatted.groupBy("id", "sex").agg(F.count(F.lit(1)).alias("n")).dropna(subset=["id", "sex"])


def several_labels(formatted: DataFrame) -> DataFrame:
    return repeated_groups(label_counts(formatted), ["id"])


def primary_labels(dorsal: DataFrame, fixes: Mapping[str, str]) -> DataFrame:
    return dorsal.select(ids.remap("id", fixes).alias("id"), F.col("sex").alias("sex_primary")).distinct()


# ---- biopsy datasets ----------------------------------------------------------------------


def _evidence(order: Column) -> list[Column]:
    known = F.when(F.col("sex") != kw.UNKNOWN, F.col("sex"))
    return [
        any_of(F.col("biopsy") == "YES").alias("has_biopsy"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.min_by(known, F.when(known.isNotNull(), order)).alias("sex"),
        F.count(F.lit(1)).alias("n_sightings"),
    ]


def dataset_summary(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("id").isNotNull()).groupBy("id").agg(*_evidence(FILE_ORDER.key()))


def tagged_union(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Rows of both datasets by column name, tagged by source; missing columns become null."""
    parts = [
        d.filter(F.col("id").isNotNull()).select("*", F.lit(n).alias("source"), F.lit(i).alias("source_no"))
        for i, (d, n) in enumerate(zip((first, second), names))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def consolidated(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One row per individual over both datasets, the sources in their given order."""
    both = tagged_union(first, second, names)
    order = F.struct("source_no", FILE_ORDER.key())
    in_order = F.array_sort(F.collect_set(F.struct("source_no", "source")))
    return both.groupBy("id").agg(
        *_evidence(order),
        F.array_join(F.transform(in_order, lambda s: s["source"]), ", ").alias("sources"),
    )


def id_overlap(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Every individual with the datasets it occurs in."""
    both = tagged_union(first.select("id"), second.select("id"), names)
    lo, hi = F.min("source_no"), F.max("source_no")
    where = F.when(lo < hi, "both").when(lo == 0, f"only {names[0]}").otherwise(f"only {names[1]}")
    return both.groupBy("id").agg(where.alias("found_in"))


def biopsy_agreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two-by-two table of biopsy evidence for individuals in both datasets."""
    both = tagged_union(first.select("id", "biopsy"), second.select("id", "biopsy"), ("1", "2"))
    yes, no = F.col("biopsy") == "YES", F.col("source_no")
    per_id = both.groupBy("id").agg(
        any_of(yes & (no == 0)).alias("b1"),
        any_of(yes & (no == 1)).alias("b2"),
        (F.min(no) < F.max(no)).alias("shared"),
    )
    b1, b2 = F.col("b1"), F.col("b2")
    return per_id.filter("shared").agg(
        F.count_if(b1 & b2).alias("in_both"),
        F.count_if(b1 & ~b2).alias("only_first"),
        F.count_if(~b1 & b2).alias("only_second"),
        F.count_if(~b1 & ~b2).alias("in_none"),
    )


def biopsies_by_year(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    return (
        tagged_union(first, second, names)
        .filter(F.col("biopsy") == "YES")
        .groupBy("year", "source")
        .agg(F.count_distinct("id").alias("biopsy_count"))
    )


def reconcile(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> dict[str, DataFrame]:
    return {
        "summary_1": dataset_summary(first),
        "summary_2": dataset_summary(second),
        "overlap": id_overlap(first, second, names),
        "agreement": biopsy_agreement(first, second),
        "consolidated": consolidated(first, second, names),
        "by_year": biopsies_by_year(first, second, names),
    }


# ---- one-year evidence check --------------------------------------------------------------

SHEET_COLUMNS = {"date_text": "date", "keywords": "keyword", "id": "id|title"}


def evidence(sheet: DataFrame) -> DataFrame:
    """Master sheet with free column names: date in any format, cleaned ID, biopsy flag."""
    found = find_columns(sheet, SHEET_COLUMNS)
    date = dates.any_date("date_text")
    return found.select(
        ids.null_placeholder("id").alias("id"),
        date.alias("date"),
        F.year(date).alias("year"),
        "keywords",
        F.coalesce(F.lower("keywords").contains("biopsy"), F.lit(False)).alias("has_biopsy"),
    )


def evidence_for_year(sheet: DataFrame, year: int) -> DataFrame:
    return (
        evidence(sheet)
        .filter((F.col("year") == year) & F.col("has_biopsy"))
        .withColumn("biopsy_text", kw.biopsy_text("keywords"))
    )


def evidence_by_month(found: DataFrame) -> DataFrame:
    """Months in calendar order with counts; a missing ID counts as one individual."""
    return found.groupBy(
        F.month("date").alias("month_no"), F.date_format("date", "MMM").alias("month")
    ).agg(F.count(F.lit(1)).alias("count"), distinct_with_null("id").alias("unique_ids"))


def missing_evidence(found: DataFrame, catalogue: DataFrame, year: int) -> DataFrame:
    """Individuals with evidence in the sheet for the year but none in the catalogue."""
    have = catalogue.filter((F.col("year") == year) & (F.col("biopsy") == "YES")).select("id")
    return ids_missing(found.filter(F.col("id").isNotNull()).select("id").distinct(), have, "id")
