"""Corrections, gate, propagation, sighting history and the analysis tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resight.functions import dates, ids, keywords as kw
from resight.operators.gates import halt_on_conflicts
from resight.operators.groups import (
    first_reliable_year,
    label_of_rank,
    label_rank,
    strict_max,
    strict_min,
)
from resight.operators.joins import apply_corrections
from resight.operators.order import by_date
from resight.operators.scans import fill_group
from resight.operators.skew import attach_group, group_sizes, join_back

DATE_ORDER = by_date("date", "photo_seq")


def corrections_from_precedence(base: DataFrame) -> DataFrame:
    """Corrections table for every conflicting individual: weaker labels become the strongest."""
    labels = base.filter(F.col("sex").isNotNull() & F.col("id").isNotNull()).select("id", "sex").distinct()
    best = labels.groupBy("id").agg(label_of_rank(F.max(label_rank("sex"))).alias("new_value"))
    return labels.join(best, "id").filter("sex != new_value").select("id", "sex", "new_value")


def finalize(
    base: DataFrame,
    corrections: DataFrame | None = None,
    gate: bool = True,
    ignore_unknown: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """Final listing: one label per individual on all its photos, biopsy, side key and span.

    With the strict gate passed an individual has at most one label, so the ordered fill is a
    group value and no row-level window is needed. Without it the labels are filled in date
    order, down and then up.
    """
    rows = base
    if gate:  # on one row per individual and label: the photos meet the corrections once, below
        labels = base.select("id", "sex").distinct()
        if corrections is not None:
            labels = apply_corrections(labels, corrections, ["id"], "sex")
        halt_on_conflicts(labels, "id", "sex", ignore_unknown)
    if corrections is not None:
        rows = apply_corrections(base, corrections, ["id"], "sex", check=not gate)
    single = gate and not ignore_unknown
    if not single:
        rows = fill_group(rows, "id", "sex", DATE_ORDER, "downup")

    per_side = (
        rows.filter(F.col("id").isNotNull())
        .groupBy("id", "side")
        .agg(
            F.count(F.lit(1)).alias("group_rows"),
            F.count("biopsy").alias("_biopsies"),
            F.max(label_rank("sex")).alias("_rank"),
            dates.year_span(F.year(strict_min("date")), F.year(strict_max("date")), inclusive).alias(
                "animal_yrs"
            ),
        )
    )
    per_id = per_side.groupBy("id").agg(
        F.when(F.sum("_biopsies") > 0, "YES").alias("_id_biopsy"),
        label_of_rank(F.max("_rank")).alias("_id_sex"),
    )
    facts = per_side.drop("_biopsies", "_rank").join(per_id, "id")
    sizes = group_sizes(base, ["id", "side"])
    filled = join_back(rows, facts, ["id", "side"], ["photo_seq"], sizes=sizes)
    sex = F.coalesce("sex", "_id_sex", F.lit(kw.UNKNOWN)) if single else F.coalesce("sex", F.lit(kw.UNKNOWN))
    biopsy = F.coalesce("biopsy", "_id_biopsy")
    return filled.withColumns(
        {
            "biopsy": biopsy,
            "sex": sex,
            "sex_genetic": F.coalesce(kw.genetic_label(sex, biopsy), F.lit(kw.UNKNOWN)),
            "id_side": ids.id_side("id", "side"),
        }
    ).drop("_id_biopsy", "_id_sex")


def primary_ids(final: DataFrame, inclusive: bool = True) -> DataFrame:
    """One row per individual and side: span, photo count and attributes of its first photo."""
    first, last = F.year(strict_min("date")), F.year(strict_max("date"))
    rows = final.groupBy("id", "id_side").agg(
        F.count(F.lit(1)).alias("n_photos"),
        first.alias("year1"),
        last.alias("yearlast"),
        dates.year_span(first, last, inclusive).alias("animal_yrs"),
        F.min_by(F.struct("melon_sex", "sex_genetic"), DATE_ORDER.key()).alias("f"),
    )
    return rows.select(
        ids.id_number("id").alias("id_numeric"),
        "id_side",
        "f.melon_sex",
        "f.sex_genetic",
        "year1",
        "yearlast",
        "animal_yrs",
        "n_photos",
    )


def catalogue_years(final: DataFrame, better_than: int = 2) -> DataFrame:
    return final.filter(F.col("qrate") > better_than).select("year").distinct()


def social_photos(final: DataFrame) -> DataFrame:
    return final.select(
        "qrate", "date", "date_original", "location", "latitude", "longitude",
        "side", "reliable", "sex", "id",
    )


def simple_photos(final: DataFrame) -> DataFrame:
    return final.select("id_side", "qrate", "date", "location", "reliable", "sex", "id")


def social_supplement(final: DataFrame) -> DataFrame:
    """Individual, M/F/UNK and whether it ever had a reliable photo in a dated year."""
    per_label = first_reliable_year(
        final.withColumn("sex", kw.short_code("sex")), ["id", "sex"], "year", F.col("reliable") == "Yes"
    )
    per_id = per_label.groupBy("id").agg(F.min("year_reliable").alias("y"))
    return per_label.join(per_id, "id").select("id", "sex", F.col("y").isNotNull().alias("reliable"))


def supplement_by_side(final: DataFrame) -> DataFrame:
    """Older form: photos per individual, side, label and reliable year."""
    year = F.when(F.col("reliable") == "Yes", F.col("year")).alias("year_reliable")
    return final.groupBy("id", "side", "sex", year).agg(F.count(F.lit(1)).alias("n"))


def supplement_counts(final: DataFrame) -> DataFrame:
    """Oldest form: plain counts."""
    return final.groupBy("id", "side", "sex").agg(F.count(F.lit(1)).alias("n"))


def master_ids(final: DataFrame, inclusive: bool = False, strict: bool = True) -> DataFrame:
    """Older master table: distinct photo descriptions per individual, side and label."""
    keys = ["id", "id_side", "sex", "sex_genetic"]
    described = final.groupBy(*keys, "qrate", "reliable", "keyword").agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"), F.count_if(F.col("date").isNull()).alias("undated")
    )
    counts = described.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum("undated").alias("undated"),
    )
    # One row per label of an individual's side, so the window is tiny.
    w = Window.partitionBy("id", "id_side")
    known = (F.sum("undated").over(w) == 0) if strict else F.lit(True)
    year1 = F.when(known, F.year(F.min("lo").over(w)))
    yearlast = F.when(known, F.year(F.max("hi").over(w)))
    return counts.select(
        ids.id_number("id").alias("id"),
        "id_side",
        "sex",
        "sex_genetic",
        year1.alias("year1"),
        yearlast.alias("yearlast"),
        dates.year_span(year1, yearlast, inclusive).alias("animal_yrs"),
        "n",
    )


def biopsied_ids(final: DataFrame) -> DataFrame:
    return (
        final.filter(F.col("biopsy") == "YES")
        .groupBy("id", "biopsy", "sex_genetic")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def unlabelled_ids(final: DataFrame) -> DataFrame:
    return (
        final.filter(F.col("sex") == kw.UNKNOWN)
        .groupBy("id", "sex", "biopsy")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ids_by_label_year(final: DataFrame) -> DataFrame:
    return final.groupBy("id", "sex", "year").agg(F.count(F.lit(1)).alias("n"))


def with_span(rows: DataFrame, inclusive: bool = True) -> DataFrame:
    """Years between first and last record of the individual and side, on every photo."""
    span = dates.year_span(F.year(strict_min("date")), F.year(strict_max("date")), inclusive)
    return attach_group(rows, ["id", "side"], [span.alias("animal_yrs")], ["photo_seq"])
