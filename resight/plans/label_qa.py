"""Label checks before anything is propagated. Read-only: each function returns a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions import dates, keywords as kw
from resight.operators.groups import (
    any_of,
    count_where,
    first_distinct_text,
    first_value,
    strict_max,
    strict_min,
)
from resight.operators.joins import ids_present, null_safe
from resight.operators.order import by_date
from resight.plans.base import FILE_ORDER

DATE_ORDER = by_date("date", "photo_seq")
DETAIL = ["id", "date", "year", "sex", "melon_sex", "biopsy", "keyword", "qrate", "reliable"]


def label_conflicts(base: DataFrame) -> DataFrame:
    """Individuals with more than one label (UNK counts), with counts and dates per label.

    Photos are reduced to one row per (individual, label) first; all later steps are small.
    """
    per_label = base.groupBy("id", "sex").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("biopsy").alias("n_biopsy"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.min("photo_seq").alias("seen"),
    )
    sex, labelled = F.col("sex"), F.col("sex").isNotNull()

    def of(label: str, column: str):
        return F.max(F.when(sex == label, F.col(column)))

    first_seen = F.array_sort(F.collect_list(F.when(labelled, F.struct("seen", "sex"))))
    return (
        per_label.groupBy("id")
        .agg(
            F.count("sex").alias("n_sex_categories"),
            F.array_join(F.transform(first_seen, lambda s: s["sex"]), " & ").alias("sex_categories"),
            F.sum(F.when(labelled, F.col("n"))).alias("n_photos_total"),
            F.coalesce(of(kw.FEMALE, "n"), F.lit(0)).alias("n_femalej"),
            F.coalesce(of(kw.MALE, "n"), F.lit(0)).alias("n_malem"),
            F.when(F.sum(F.when(labelled, F.col("n_biopsy"))) > 0, "YES").otherwise("NO").alias("biopsied"),
            of(kw.FEMALE, "first").alias("first_femalej_date"),
            of(kw.FEMALE, "last").alias("last_femalej_date"),
            of(kw.MALE, "first").alias("first_malem_date"),
            of(kw.MALE, "last").alias("last_malem_date"),
            F.min("first").alias("first_date"),
            F.max("last").alias("last_date"),
        )
        .filter("n_sex_categories > 1")
        .withColumn("date_range_years", dates.years_between(F.col("first_date"), F.col("last_date")))
    )


def conflict_photos(base: DataFrame) -> DataFrame:
    """Every photo of the individuals with conflicting labels."""
    return ids_present(base, label_conflicts(base), "id", ["photo_seq"]).select(*DETAIL)


def label_timeline(base: DataFrame) -> DataFrame:
    return (
        base.filter(F.col("sex").isNotNull())
        .groupBy("id", "sex")
        .agg(
            strict_min("date").alias("first_sex_date"),
            strict_min("year").alias("first_sex_year"),
            F.count(F.lit(1)).alias("n_photos_with_sex"),
        )
    )


def label_history(base: DataFrame) -> DataFrame:
    """Per individual: sightings, labelled photos, first label and years until it was known."""
    labelled = F.col("sex").isNotNull()
    labelled_date = F.when(labelled, F.col("date"))
    return (
        base.groupBy("id")
        .agg(
            strict_min("date").alias("first_sighting"),
            strict_max("date").alias("last_sighting"),
            F.count(F.lit(1)).alias("total_photos"),
            F.count("sex").alias("photos_with_sex"),
            count_where(~labelled).alias("photos_without_sex"),
            F.when(F.count("sex") == F.count(labelled_date), F.min(labelled_date)).alias(
                "first_sex_determination"
            ),
            first_value("sex", DATE_ORDER).alias("sex_determined"),
        )
        .withColumn(
            "years_before_sex_known",
            F.when(
                F.col("first_sighting") != F.col("first_sex_determination"),
                dates.years_between(F.col("first_sighting"), F.col("first_sex_determination")),
            ),
        )
    )


def never_labelled(base: DataFrame) -> DataFrame:
    return label_history(base).filter("photos_with_sex = 0")


def top_never_labelled(base: DataFrame, k: int = 10) -> DataFrame:
    return (
        never_labelled(base)
        .select("id", "first_sighting", "last_sighting", "total_photos")
        .orderBy(F.desc("total_photos"), "id")
        .limit(k)
    )


def label_vs_morphology(base: DataFrame) -> DataFrame:
    match = F.when(F.col("sex") == F.col("melon_sex"), "Match").otherwise("Mismatch")
    return (
        base.filter(F.col("sex").isNotNull() & (F.col("melon_sex") != kw.UNKNOWN))
        .groupBy(match.alias("sex_match"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _labelled_without_morphology(base: DataFrame) -> DataFrame:
    return base.filter(kw.known("sex") & (F.col("melon_sex") == kw.UNKNOWN))


def labelled_without_morphology(base: DataFrame) -> DataFrame:
    return (
        _labelled_without_morphology(base)
        .groupBy("id", "sex")
        .agg(
            F.count(F.lit(1)).alias("n_photos"),
            any_of(F.col("biopsy").isNotNull()).alias("has_biopsy"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
    )


def biopsy_check(base: DataFrame) -> DataFrame:
    """All photos of the individuals labelled without morphology: biopsy and label evidence."""
    lacking = kw.known("sex") & (F.col("melon_sex") == kw.UNKNOWN)
    return (
        base.groupBy("id")
        .agg(
            any_of(F.col("biopsy").isNotNull()).alias("has_biopsy"),
            F.count("biopsy").alias("n_biopsy_photos"),
            F.count(F.lit(1)).alias("n_total_photos"),
            first_value("sex", FILE_ORDER).alias("sex"),
            any_of(F.col("melon_sex") != kw.UNKNOWN).alias("has_melon_sex"),
            any_of(lacking).alias("_wanted"),
        )
        .filter("_wanted")
        .drop("_wanted")
    )


def evidence_overlap(base: DataFrame) -> DataFrame:
    """Which individuals are biopsied, labelled without morphology, or both."""
    lacking = kw.known("sex") & (F.col("melon_sex") == kw.UNKNOWN)
    per_id = base.groupBy("id").agg(
        any_of(F.col("biopsy").isNotNull()).alias("biopsied"), any_of(lacking).alias("lacking")
    )
    overlap = (
        F.when(F.col("biopsied") & F.col("lacking"), "biopsied_and_no_melon")
        .when(F.col("lacking"), "no_melon_not_biopsied")
        .when(F.col("biopsied"), "biopsied_with_melon")
    )
    return per_id.select("id", overlap.alias("overlap")).filter("overlap is not null")


def problem_ids(base: DataFrame) -> DataFrame:
    """Labelled without morphology and never biopsied: where does the label come from?"""
    bad = evidence_overlap(base).filter("overlap = 'no_melon_not_biopsied'")
    rows = ids_present(base, bad, "id", ["photo_seq"])
    counts = rows.groupBy("id").agg(
        first_value("sex", FILE_ORDER, kw.known("sex")).alias("sex"),
        F.count(F.lit(1)).alias("n_photos"),
    )
    sample = first_distinct_text(rows, ["id"], "keyword", FILE_ORDER, 1, "keywords_sample")
    return null_safe(counts, sample, ["id"])


def biopsy_first_year(base: DataFrame) -> DataFrame:
    return (
        base.filter(F.col("biopsy").isNotNull())
        .groupBy("id")
        .agg(
            strict_min("date").alias("first_biopsy_date"),
            strict_min("year").alias("first_biopsy_year"),
            F.count(F.lit(1)).alias("n_biopsy_photos"),
            first_value("sex", FILE_ORDER).alias("sex"),
        )
    )


def genetic_vs_morphology(base: DataFrame) -> DataFrame:
    return base.filter(
        F.col("biopsy").isNotNull()
        & (F.col("melon_sex") != kw.UNKNOWN)
        & (F.col("sex") != F.col("melon_sex"))
    ).select("id", "date", "sex", "melon_sex", "biopsy", "keyword")
