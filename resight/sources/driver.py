"""Catalogue inputs derived from the given tables (rules in FIXTURES.md, section 3).

The listings are derived once per session and stored as Parquet, as a catalogue would be, so
that every query starts from a table with real columns to prune and filters to push down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resight.session import stored
from resight.sources.readers import table


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Photo listing, one row per order."""
    return stored(spark, "listing", folder, lambda: _listing(spark, folder))


def tagged_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Listing whose label words use the tag vocabulary of the catalogue checks."""
    return stored(spark, "tagged", folder, lambda: _tagged_listing(spark, folder))


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    y, day = F.year("o_orderdate"), F.col("o_orderdate").cast("date")
    priority = F.substring("o_orderpriority", 1, 1)

    def when(condition: Column, word: str) -> Column:
        return F.when(condition, F.lit(word))

    melon = (
        when((c % 3 == 0) & (s == "F"), "Melon_F")
        .when((c % 3 == 1) & (s == "F"), "Melon_M")
        .when((c % 6 == 2) & (s == "F"), "Melon_F")
        .when((c % 6 == 2) & (s == "O"), "Melon_M")
        .when(c % 6 == 2, "Melon_UNK")
    )
    assessed = (c + y + F.when(k % 12 == 8, 3).otherwise(0)) % 5  # changes with year and photo
    summary = F.when(
        k % 4 == 0, when(assessed < 3, "Sum_F").when(assessed == 3, "Sum_M").otherwise("Sum_UNK")
    )
    biopsy = F.when(
        k % 41 == 0, when(c % 3 == 0, "biopsy-Female").when(c % 3 == 1, "biopsy-Male").otherwise("biopsy")
    )
    age = when((c % 8 == 0) & (y <= 1996), "samCalf").when((c % 8 == 1) & (y <= 1997), "samJuv")
    words = [
        when(priority.isin("1", "2"), "Left").when(priority.isin("3", "4"), "Right"),
        melon,
        summary,
        when(k % 17 == 0, "F2"),
        when(k % 19 == 0, "M3"),
        biopsy,
        when(k % 5 == 0, "Indent"),
        when(k % 7 == 0, "Notch"),
        when(k % 9 == 0, "scar"),
        when(k % 10 == 0, "Patch"),
        when(k % 11 == 0, "Gully"),
        when(k % 13 == 0, "dorsal"),
        when(k % 6 == 0, "Digital"),
        age,
        when(c % 7 == 0, "SW").otherwise("NBW"),
    ]
    text_k, text_c = k.cast("string"), c.cast("string")
    title = (
        F.when(c % 29 == 0, "UNK")
        .when(c % 31 == 0, F.concat(text_c, F.lit("R")))
        .when(c % 37 == 0, F.concat(F.lit("0"), text_c))
        .otherwise(text_c)
    )

    def degrees(hundredths: Column) -> Column:
        return F.when(k % 53 == 0, "").otherwise((hundredths.cast("double") / 100).cast("string"))

    return table(spark, folder, "orders").select(
        k.alias("photo_seq"),
        F.concat(F.lit("IMG_"), F.date_format(day, "yyyyMMdd"), F.lit("_"), text_k, F.lit(".JPG")).alias(
            "file_name"
        ),
        title.alias("title"),
        F.when(k % 97 == 0, "")
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:00:00")))
        .alias("date_original"),
        F.concat_ws(", ", *words).alias("keyword_export"),
        F.repeat(F.lit("* "), (k % 5).cast("int")).alias("rating"),
        degrees(F.lit(4350) + k % 100).alias("latitude"),
        degrees(F.lit(-5920) + k % 150).alias("longitude"),
    )


def _tagged_listing(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("keyword_export")
    for old, new in [
        ("Melon_F", "Sex_F"),
        ("Melon_M", "Sex_M"),
        ("F2", "FJ"),
        ("M3", "MM"),
        ("Sum_F", "FemaleJ"),
    ]:
        text = F.replace(text, F.lit(old), F.lit(new))
    return listing(spark, folder).withColumn("keyword_export", text)


def mixed_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Listing days written in one of four styles by photo_seq."""
    day = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    style = k % 4
    return table(spark, folder, "orders").select(
        k.alias("photo_seq"),
        F.when(style == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(style == 1, F.date_format(day, "M/d/yyyy"))
        .when(style == 2, F.date_format(day, "d/M/yyyy"))
        .otherwise(F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 1:05:22 PM")))
        .alias("date_text"),
    )


def master_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Listing under free column names, its days written in the mixed styles."""
    return (
        listing(spark, folder)
        .join(mixed_dates(spark, folder), "photo_seq")
        .select(
            "photo_seq",
            F.col("date_text").alias("Photo Date"),
            F.col("keyword_export").alias("All Keywords"),
            F.col("title").alias("Whale ID"),
        )
    )


def annual_and_primary(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping catalogues: each lacks a third of the photos."""
    rows, k = tagged_listing(spark, folder), F.col("photo_seq")
    return rows.filter(k % 3 != 0), rows.filter(k % 3 != 1)


def encounter_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON task document per hundred events."""
    encounter = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("occ-"), F.col("user_id").cast("string")).alias("occurrenceId"),
        (F.col("event_id") % 7).alias("numberMediaAssets"),
        F.struct(F.concat(F.lit("team "), F.col("event_type")).alias("displayName")).alias("submitter"),
    )
    return (
        table(spark, folder, "events")
        .groupBy(F.floor(F.col("event_id") / 100).alias("doc"))
        .agg(F.array_sort(F.collect_list(encounter)).alias("encounters"))
        .select(F.to_json(F.struct(F.struct("encounters").alias("task"))).alias("value"))
    )


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    """Time-stamped sightings: one row per event."""
    return table(spark, folder, "events").select(
        F.col("event_id"), F.col("user_id").cast("string").alias("id"), F.col("ts").alias("datetime")
    )


def camera_names(spark: SparkSession, folder: str) -> DataFrame:
    """Listing in which every fourteenth photo still has the name the camera gave it, without a year."""
    k = F.col("photo_seq")
    name = F.concat(F.lit("DSC_"), (k % 1000).cast("string"), F.lit(".JPG"))
    return listing(spark, folder).withColumn("file_name", F.when(k % 14 == 5, name).otherwise(F.col("file_name")))


def auto_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One raw rating response per second photo: some unreadable, some in code fences."""
    return stored(spark, "responses", folder, lambda: _auto_responses(spark, folder))


def _auto_responses(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("photo_seq")
    quality = F.floor((k % 8) / 2) + 1
    rating = F.when(k % 23 != 0, quality)
    folder_name = (
        F.when(k % 23 == 0, "review_melon_only")
        .when(quality == 4, "Q4_excellent")
        .when(quality == 3, "Q3_good")
        .when(quality == 2, "Q2_poor")
        .otherwise("Q1_reject")
    )
    parts = F.when(k % 3 == 0, F.array(F.lit("dorsal_fin"), F.lit("melon"))).otherwise(
        F.array(F.lit("dorsal_fin"))
    )
    body = F.to_json(
        F.struct(
            (k % 31 != 0).alias("cetacean_present"),
            F.lit("clear").alias("species_confidence"),
            parts.alias("body_parts"),
            (k % 12 == 0).alias("multiple_whales"),
            rating.alias("dorsal_q_rating"),
            (k % 14 == 0).alias("borderline_Q3"),
            F.when(k % 18 != 0, k % 8 == 0).alias("trailing_edge_clear"),
            (k % 3 == 0).alias("melon_present"),
            (k % 22 == 0).alias("crop_recommended"),
            F.when(k % 92 != 0, folder_name).alias("output_folder"),
            F.concat(F.lit("note "), k.cast("string")).alias("rationale"),
        )
    )
    response = (
        F.when(k % 89 == 0, F.lit("{not json"))
        .when(k % 10 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .otherwise(body)
    )
    day = F.regexp_replace(F.substring("date_original", 1, 10), "-", ":")
    return (
        listing(spark, folder)
        .select(
            "photo_seq",
            F.concat(F.lit("/photos/"), F.col("file_name")).alias("path"),
            F.when(k % 3 == 0, F.nullif(F.concat(day, F.lit(" 08:00:00")), F.lit(" 08:00:00"))).alias(
                "date_time_original"
            ),
            F.nullif(F.concat(day, F.lit(" 09:00:00")), F.lit(" 09:00:00")).alias("create_date"),
            response.alias("response"),
        )
    )
