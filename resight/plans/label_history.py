"""Label history per individual: votes, current label, transitions, sources, timelines.

All reports start from one small table, a row per (individual, year); photos are read once and
aggregated on the map side, so an individual with very many photos costs one row per year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.functions import dates, keywords as kw
from resight.operators.joins import ids_present

LABELS = {"f": kw.FEMALE, "m": kw.MALE, "u": kw.UNKNOWN}

MAX_YEARS = 300  # columns of an exported timeline


def melon_photos(listing: DataFrame) -> DataFrame:
    """Melon photos with the label of either keyword source; the year is read from the file name."""
    keyword = F.col("keyword_export")
    return (
        listing.select(
            "photo_seq",
            "file_name",
            F.col("title").alias("id"),
            dates.year_in_text("file_name").alias("year"),
            keyword.alias("keyword"),
            kw.photo_type(keyword).alias("photo_type"),
            kw.label(keyword, "summary_source").alias("sex"),
            kw.label(keyword, "melon_source").alias("sex_from_melon"),
            kw.label(keyword, "summary_source").alias("sex_from_sum"),
        )
        .filter("photo_type = 'Melon'")
    )


def _joined(counts: dict[str, Column], separator: str = " & ") -> Column:
    """Names whose count is above zero, in alphabetical order."""
    parts = [F.when(counts[k] > 0, F.lit(LABELS[k])) for k in ("f", "m", "u")]
    return F.concat_ws(separator, *parts)


def _cols(prefix: str) -> dict[str, Column]:
    return {k: F.col(f"{prefix}{k}") for k in LABELS}


def per_year(photos: DataFrame) -> DataFrame:
    """Counts per (individual, year) for both label sources."""
    aggs = [F.count(F.lit(1)).alias("n"), F.count("sex").alias("n_sex")]
    for prefix, column in (("s_", "sex"), ("k_", "sex_from_melon"), ("q_", "sex_from_sum")):
        aggs += [F.count_if(F.col(column) == name).alias(prefix + k) for k, name in LABELS.items()]
    tagged = F.col("sex_from_melon").isNotNull() | F.col("sex_from_sum").isNotNull()
    aggs += [
        F.count("sex_from_melon").alias("n_melon_tagged"),
        F.count("sex_from_sum").alias("n_sum_tagged"),
        F.count_if(tagged).alias("n_tagged"),
    ]
    return photos.groupBy("id", "year").agg(*aggs)


def _sums(names: Sequence[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


_SUMMED = [
    "n", "n_sex", "n_melon_tagged", "n_sum_tagged", "n_tagged",
    *[p + k for p in ("s_", "k_", "q_") for k in LABELS],
]


def _source_columns() -> list[Column]:
    melon, summed = _joined(_cols("k_")), _joined(_cols("q_"))
    has_f = (F.col("k_f") + F.col("q_f")) > 0
    has_m = (F.col("k_m") + F.col("q_m")) > 0
    both = (F.col("n_melon_tagged") > 0) & (F.col("n_sum_tagged") > 0)
    present = F.concat_ws(
        ", ", F.when(F.col("n_melon_tagged") > 0, "Melon"), F.when(F.col("n_sum_tagged") > 0, "Sum")
    )
    return [
        present.alias("keywords_present"),
        (has_f & has_m).alias("inter_keyword_conflict"),
        (both & (melon == summed)).alias("all_keywords_identical"),
        melon.alias("melon_sex_values"),
        summed.alias("sum_sex_values"),
    ]


def source_comparison(photos: DataFrame) -> DataFrame:
    """What each keyword source says about an individual, and whether they disagree."""
    totals = per_year(photos).groupBy("id").agg(*_sums(_SUMMED)).filter("n_tagged > 0")
    return totals.select("id", "n_melon_tagged", "n_sum_tagged", *_source_columns())


def vote(female: Column, male: Column) -> Column:
    return (
        F.when(female > male, kw.FEMALE)
        .when(male > female, kw.MALE)
        .when(female > 0, "CONFLICT")
        .otherwise(kw.UNKNOWN)
    )


def current_label(recent: Column) -> Column:
    """Label from the counts of the most recent labelled year."""
    f, m, u = (recent[k] > 0 for k in LABELS)
    return (
        F.when(f & m, "CONFLICT")
        .when((f | m) & u, "UNK_from_known")
        .when(f, kw.FEMALE)
        .when(m, kw.MALE)
        .otherwise(kw.UNKNOWN)
    )


def id_summary(photos: DataFrame, reference_year: int) -> DataFrame:
    """Per individual: counts, vote, years, current label, transition and source check."""
    year, labelled = F.col("year"), (F.col("n_sex") > 0) & F.col("year").isNotNull()
    first_f = F.min(F.when(F.col("s_f") > 0, year))
    first_m = F.min(F.when(F.col("s_m") > 0, year))
    counts = F.struct(F.col("s_f").alias("f"), F.col("s_m").alias("m"), F.col("s_u").alias("u"))
    totals = (
        per_year(photos)
        .groupBy("id")
        .agg(
            *_sums(_SUMMED),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
            first_f.alias("first_femalej_year"),
            first_m.alias("first_malem_year"),
            F.max(F.when(labelled, year)).alias("most_recent_sex_year"),
            F.max_by(counts, F.when(labelled, year)).alias("recent"),
        )
    )
    has_labelled_year = F.col("most_recent_sex_year").isNotNull()
    tagged = F.col("n_tagged") > 0
    matured = F.coalesce(F.col("first_femalej_year") < F.col("first_malem_year"), F.lit(False))
    sources = _source_columns()
    names = [
        "keywords_present", "inter_keyword_conflict", "all_keywords_identical",
        "melon_sex_values", "sum_sex_values",
    ]
    return totals.select(
        "id",
        F.col("n").alias("n_photos_total"),
        F.col("n").alias("n_melon_photos"),
        F.lit(0).cast("bigint").alias("n_dorsal_photos"),
        F.lit(0).cast("bigint").alias("n_other_photos"),
        F.col("n_sex").alias("n_photos_with_sex"),
        F.col("s_f").alias("n_femalej"),
        F.col("s_m").alias("n_malem"),
        F.col("s_u").alias("n_unk"),
        vote(F.col("s_f"), F.col("s_m")).alias("primary_sex"),
        "first_year",
        "last_year",
        dates.year_span(F.col("first_year"), F.col("last_year")).alias("melon_age"),
        (F.lit(reference_year) - F.col("last_year")).alias("yrs_since_melon_age"),
        "first_femalej_year",
        "first_malem_year",
        "most_recent_sex_year",
        F.when(has_labelled_year, current_label(F.col("recent"))).alias("current_sex"),
        F.when(has_labelled_year, matured).alias("possible_maturation"),
        *[F.when(tagged, c).alias(n) for c, n in zip(sources, names)],
    )


def label_totals(summary: DataFrame) -> DataFrame:
    """One row of counts over :func:`id_summary`: labelled IDs, votes, current labels, transitions, source checks."""

    def each(column: str, prefix: str, labels: Sequence[str]) -> list[Column]:
        return [F.count_if(F.col(column) == v).alias(f"{prefix}_{v.lower()}") for v in labels]

    known = (kw.FEMALE, kw.MALE, kw.UNKNOWN)
    return summary.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("n_photos_with_sex") > 0).alias("n_labelled"),
        *each("primary_sex", "vote", (*known, "CONFLICT")),
        *each("current_sex", "current", (*known, "UNK_from_known", "CONFLICT")),
        F.count_if("possible_maturation").alias("n_possible_maturation"),
        F.count_if("inter_keyword_conflict").alias("n_source_conflicts"),
        F.count_if("all_keywords_identical").alias("n_identical_sources"),
        F.min("first_year").alias("first_year"),
        F.max("last_year").alias("last_year"),
    )


def without_year(photos: DataFrame) -> DataFrame:
    """Reject table: photos whose name tells no year."""
    return photos.filter(F.col("year").isNull()).select("photo_seq", "file_name", "id")


def year_coverage(photos: DataFrame) -> DataFrame:
    """Photos, photos with a year, and the years they cover."""
    return photos.agg(
        F.count(F.lit(1)).alias("n_photos"),
        F.count("year").alias("n_with_year"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def years_of(photos: DataFrame, limit: int = MAX_YEARS) -> list[int]:
    """Calendar years present. More than ``limit`` are an error: file names can hold any four digits, and a table of
    so many columns is of no use; :func:`timeline` has no such limit."""
    rows = photos.select("year").distinct().filter("year is not null").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} years: check the file names, or use the timeline without columns")
    return sorted(r["year"] for r in rows)


def timeline(photos: DataFrame) -> DataFrame:
    """Label text per individual as a map from year to label, in order of years, and ``year_na``, the label of photos
    without a year. The years need not be known."""
    labelled = per_year(photos).filter("n_sex > 0").withColumn("sex_annual", _joined(_cols("s_")))
    dated = F.when(F.col("year").isNotNull(), F.struct("year", "sex_annual"))
    return labelled.groupBy("id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(dated))).alias("labels"),
        F.max(F.when(F.col("year").isNull(), F.col("sex_annual"))).alias("year_na"),
    )


def timeline_wide(photos: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Label text per individual and year, years as columns in order.

    An export form of :func:`timeline`. Years must be complete, so they are looked up unless given; labelled photos
    without a year go to ``year_na``.
    """
    years = years_of(photos) if years is None else years
    columns = [F.col("labels")[F.lit(y)].alias(f"year_{y}") for y in sorted(years)]
    return timeline(photos).select("id", *columns, "year_na")


def history_detailed(photos: DataFrame) -> DataFrame:
    f, m, u = F.col("s_f") > 0, F.col("s_m") > 0, F.col("s_u") > 0
    annual = (
        F.when(f & m, "CONFLICT")
        .when(f, kw.FEMALE)
        .when(m, kw.MALE)
        .when(u, kw.UNKNOWN)
        .otherwise("No Sex")
    )
    return per_year(photos).select(
        "id",
        "year",
        F.col("n").alias("n_melon_photos"),
        F.col("n_sex").alias("n_with_sex"),
        F.col("s_f").alias("n_femalej"),
        F.col("s_m").alias("n_malem"),
        F.col("s_u").alias("n_unk"),
        annual.alias("sex_annual"),
    )


def mixed_labels(summary: DataFrame) -> DataFrame:
    """Individuals with more than one kind of label among their photos."""
    f, m, u = F.col("n_femalej") > 0, F.col("n_malem") > 0, F.col("n_unk") > 0
    return summary.filter((f & m) | (u & m) | (u & f))


def _mixed_years(photos: DataFrame) -> DataFrame:
    """(individual, year) rows of the individuals with mixed labels.

    The window runs over the yearly counts, so it holds as many rows as an individual has years.
    """
    w = Window.partitionBy("id")
    f, m, u = (F.sum(c).over(w) > 0 for c in ("s_f", "s_m", "s_u"))
    years = per_year(photos).withColumn("mixed", (f & m) | (u & m) | (u & f))
    return years.filter("mixed and n_sex > 0 and year is not null").drop("mixed")


def conflict_years(photos: DataFrame) -> DataFrame:
    f, m, u = F.col("s_f") > 0, F.col("s_m") > 0, F.col("s_u") > 0
    annual = (
        F.when(f & m, "CONFLICT")
        .when((f | m) & u, "UNK_from_known")
        .when(f, kw.FEMALE)
        .when(m, kw.MALE)
        .otherwise(kw.UNKNOWN)
    )
    return _mixed_years(photos).select(
        "id",
        "year",
        F.col("s_f").alias("n_femalej"),
        F.col("s_m").alias("n_malem"),
        F.col("s_u").alias("n_unk"),
        annual.alias("primary_sex_annual"),
    )


def conflict_patterns(photos: DataFrame) -> DataFrame:
    """Per mixed individual: the years of each class as text and a possible transition."""
    cls, year = F.col("primary_sex_annual"), F.col("year")

    def listed(name: str) -> Column:
        # At most one entry per calendar year.
        return F.array_join(F.array_sort(F.collect_list(F.when(cls == name, year))).cast("array<string>"), ", ")

    first_f, first_m = F.min(F.when(cls == kw.FEMALE, year)), F.min(F.when(cls == kw.MALE, year))
    return (
        conflict_years(photos)
        .groupBy("id")
        .agg(
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
            listed(kw.FEMALE).alias("years_as_femalej"),
            listed(kw.MALE).alias("years_as_malem"),
            listed(kw.UNKNOWN).alias("years_as_unk"),
            listed("CONFLICT").alias("years_with_conflict"),
            first_f.alias("first_femalej_year"),
            first_m.alias("first_malem_year"),
            F.coalesce(first_f < first_m, F.lit(False)).alias("possible_maturation"),
        )
    )


def conflict_details(photos: DataFrame) -> DataFrame:
    """Labelled photos of the individuals with mixed labels."""
    labelled = photos.filter(F.col("sex").isNotNull())
    kinds = labelled.groupBy("id").agg(F.count_distinct("sex").alias("kinds")).filter("kinds > 1")
    return ids_present(labelled, kinds, "id", ["photo_seq"]).select(
        "id", "year", "photo_type", "sex", "keyword"
    )


def review_tables(summary: DataFrame) -> DataFrame:
    """Genuine conflicts, minor flags and transition candidates, tagged by table."""
    columns = [
        "id", "primary_sex", "current_sex", "first_year", "last_year",
        "first_femalej_year", "first_malem_year", "n_femalej", "n_malem",
    ]

    tags = F.array_compact(
        F.array(
            F.when(F.col("current_sex") == "CONFLICT", "conflict"),
            F.when(F.col("current_sex") == "UNK_from_known", "unk_from_known"),
            F.when(F.col("possible_maturation"), "maturation"),
        )
    )
    return summary.withColumn("review", F.explode(tags)).select("review", *columns)
