"""Annual report counts and the encounter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions import ids, text
from resight.operators.groups import n_rows
from resight.operators.scans import session_buckets


def photos_per_id_side(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id", "side").agg(n_rows("id_n"))


def ids_per_side(rows: DataFrame) -> DataFrame:
    """Individuals per side: a count of groups."""
    return rows.groupBy("side", "id").agg(n_rows("n")).groupBy("side").agg(n_rows("id_n"))


def both_sides(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.count_distinct("side").alias("n_sides")).filter("n_sides = 2")


def new_and_old(rows: DataFrame, first_new: int) -> DataFrame:
    """Totals of individuals; numbers from ``first_new`` on count as new."""
    per_id = rows.select("id").distinct()
    new = F.coalesce(ids.id_number("id") >= first_new, F.lit(False))
    return per_id.agg(
        n_rows("n_ids"), F.count_if(new).alias("n_new"), F.count_if(~new).alias("n_old")
    )


def ids_per_day(rows: DataFrame, better_than: int = 2) -> DataFrame:
    good = rows.filter(F.col("qrate") > better_than)
    return good.groupBy("date", "id").agg(n_rows("n")).groupBy("date").agg(n_rows("n"))


def days_per_id(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id", "date").agg(n_rows("n")).groupBy("id").agg(n_rows("n_days"))


def reliability_in_year(rows: DataFrame, year: int) -> DataFrame:
    return rows.filter(F.col("year") == year).groupBy("reliable", "id").agg(n_rows("count"))


def location_in_year(rows: DataFrame, year: int) -> DataFrame:
    return rows.filter(F.col("year") == year).groupBy("location").agg(n_rows("count"))


def in_extent(rows: DataFrame, west: float, east: float, south: float, north: float) -> DataFrame:
    """Rows with coordinates inside a map extent."""
    return rows.filter(
        F.col("longitude").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").between(west, east)
        & F.col("latitude").between(south, north)
    )


def encounters_per_day(
    sightings: DataFrame, first_new: int, gap_minutes: int = 30, year: int | None = None
) -> DataFrame:
    """Encounters of each individual on each day, with the new/old flag.

    Works from one row per (individual, time bucket), never from all records of an individual.
    Records without time are encounters of their own on a null day. Records without an individual have
    no encounters to count and are left out; ``sessionize`` keeps them.
    """
    rows = sightings if year is None else sightings.filter(F.year("datetime") == year)
    timed = session_buckets(rows, "id", "datetime", gap_minutes)
    per_day = timed.groupBy("id", F.col("_day").alias("date")).agg(
        F.count_distinct("encounter_id").alias("n_encounters")
    )
    untimed = (
        rows.filter(F.col("id").isNotNull() & F.col("datetime").isNull())
        .groupBy("id")
        .agg(n_rows("n_encounters"))
        .select("id", F.lit(None).cast("date").alias("date"), "n_encounters")
    )
    number = ids.id_number("id")
    is_new = number >= first_new
    return per_day.unionByName(untimed).select(
        "id",
        "date",
        "n_encounters",
        number.alias("id_numeric"),
        F.when(is_new, "new").when(~is_new, "old").alias("id_flag"),
        text.decorated_id("id", is_new).alias("id_label"),
    )


def encounter_range(encounters: DataFrame) -> DataFrame:
    return encounters.agg(
        F.min("n_encounters").alias("fewest"), F.max("n_encounters").alias("most")
    )
