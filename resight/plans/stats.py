"""Catalogue statistics: pivots, shares, sites and marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resight.functions import keywords as kw
from resight.operators.groups import n_rows

PLACES = ["Gully", "Haldimand", "Shortland"]


def pivot_counts(
    rows: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], other: str | None = None
) -> DataFrame:
    """Long counts to one column per value; absent combinations are null. A group that only has
    other values keeps its row, and ``other`` names a column that counts them."""
    cols = [
        F.nullif(F.count_if(F.col(column) == v), F.lit(0)).alias(v.lower()) for v in values
    ]
    if other:
        listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
        cols.append(F.nullif(F.count_if(~listed), F.lit(0)).alias(other))
    return rows.groupBy(*keys).agg(*cols)


def share_within(rows: DataFrame, group: str, column: str, values: Sequence[str]) -> DataFrame:
    """Share of each value within its group, one column per value."""
    total = F.count(F.lit(1))
    cols = [
        (F.nullif(F.count_if(F.col(column) == v), F.lit(0)) / total).alias(v.lower()) for v in values
    ]
    return rows.groupBy(group).agg(*cols)


def share_across(rows: DataFrame, group: str, groups: Sequence[str], column: str) -> DataFrame:
    """The same shares laid out with the groups as columns."""
    # The window sees the counts, one row per (group, value), not the rows.
    total = F.sum("n").over(Window.partitionBy(group))
    shares = rows.groupBy(group, column).agg(n_rows("n")).withColumn("share", F.col("n") / total)
    return shares.groupBy(column).agg(
        *[F.max(F.when(F.col(group) == g, F.col("share"))).alias(g.lower()) for g in groups]
    )


def survey_days(rows: DataFrame) -> DataFrame:
    """Records per day, place, individual, side and medium."""
    return rows.groupBy("date", "location", "id", "side", "film").agg(n_rows("count"))


def id_days_by_year(rows: DataFrame) -> DataFrame:
    days = survey_days(rows).withColumn("year", F.year("date"))
    return pivot_counts(days, ["year", "film"], "side", ["Left", "Right"])


def individual_days_per_year(rows: DataFrame) -> DataFrame:
    """Days with an individual, place, side and medium, counted per year of the day."""
    return survey_days(rows).groupBy(F.year("date").alias("year")).agg(n_rows("count"))


def photos_per_day_and_place(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date", "location", "side", "film").agg(n_rows("count"))


def reliability_by_label(rows: DataFrame, labels: Sequence[str], label: str = "sex") -> DataFrame:
    """Share of each reliability within each of the labels, labels as columns; other labels don't count."""
    return share_across(rows.filter(F.col(label).isin(*labels)), label, labels, "reliable")


def photos_by_year(rows: DataFrame) -> DataFrame:
    return pivot_counts(rows, ["year", "film"], "side", ["Left", "Right"])


def ids_at(rows: DataFrame, place: str, side: str, at_least: int = 3) -> DataFrame:
    """Individuals with good photos of one side at one place."""
    return (
        rows.filter(
            (F.col("location") == place) & (F.col("qrate") >= at_least) & (F.col("side") == side)
        )
        .groupBy("id", "side")
        .agg(n_rows("count"))
    )


def seen_everywhere(rows: DataFrame, side: str, places: Sequence[str] = PLACES) -> DataFrame:
    """Individuals of one side seen at every place, with day counts per place."""
    days = rows.filter(F.col("side") == side).select("date", "location", "id", "side").distinct()
    wide = pivot_counts(days, ["id", "side"], "location", places, "elsewhere")
    return wide.dropna(subset=[p.lower() for p in places])


def reliable_ids_at(rows: DataFrame, side: str, place: str, places: Sequence[str] = PLACES) -> DataFrame:
    """Reliable photos per individual and place, kept where the named place has any."""
    good = rows.filter((F.col("side") == side) & (F.col("reliable") == "Yes"))
    return pivot_counts(good, ["id"], "location", places, "elsewhere").dropna(subset=[place.lower()])


def ids_by_label(rows: DataFrame, label: str = "sex") -> DataFrame:
    """Individuals per side and label: a count of groups."""
    return (
        rows.groupBy("side", label, "id").agg(n_rows("n")).groupBy("side", label).agg(n_rows("count"))
    )


def good_ids_by_site(rows: DataFrame, side: str, labels: Sequence[str]) -> DataFrame:
    """Individuals with good reliable photos per place, labels as columns."""
    good = rows.filter(
        F.col("qrate").isin(3, 4) & (F.col("side") == side) & (F.col("reliable") == "Yes")
    )
    groups = good.select("side", "location", "sex", "id").distinct()
    return pivot_counts(groups, ["side", "location"], "sex", labels)


def mark_shares(listing: DataFrame) -> DataFrame:
    """Share of photos, of individuals and of individual-sides with each mark."""
    return _mark_rows(
        listing.select(
            "id", "side", *[kw.mark("keyword", p).alias(m) for m, p in kw.SINGLE_MARKS.items()]
        )
    )


def _mark_rows(rows: DataFrame) -> DataFrame:
    marks = list(kw.SINGLE_MARKS)
    per_side = rows.groupBy("id", "side").agg(
        n_rows("n"), *[F.count_if(F.col(m) == "Yes").alias(m) for m in marks]
    )
    per_id = per_side.groupBy("id").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("sides"),
        *[F.sum(m).alias(m) for m in marks],
        *[F.count_if(F.col(m) > 0).alias(f"{m}_sides") for m in marks],
    )
    shares = [
        (share / F.sum(total)).alias(f"{m}_{what}")
        for m in marks
        for what, share, total in (
            ("photo_share", F.sum(m), "n"),
            ("id_share", F.count_if(F.col(m) > 0), "one"),
            ("id_side_share", F.sum(f"{m}_sides"), "sides"),
        )
    ]
    return per_id.withColumn("one", F.lit(1)).agg(*shares)


# ---- regions and species ------------------------------------------------------------------


def good_photos(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("qrate").isin(3, 4))


def photos_per_id(rows: DataFrame, *conditions: Column) -> DataFrame:
    for c in conditions:
        rows = rows.filter(c)
    return rows.groupBy("id").agg(n_rows("count"))


def photos_per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date").agg(n_rows("count"))


def species_counts(listing_rows: DataFrame, at_least: int = 3) -> DataFrame:
    """Good photos per species, individual and year."""
    return (
        listing_rows.withColumn("species", kw.species("keyword"))
        .filter(F.col("qrate") >= at_least)
        .groupBy("species", "id", "year")
        .agg(n_rows("count"))
    )
