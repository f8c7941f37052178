"""Bulk-import sheets, encounter links and renamed exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resight.functions import dates, text
from resight.sources.readers import add_missing

REQUIRED = ["file_name", "latitude", "longitude", "date_original"]


def to_encounters(sheets: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Import rows: media asset, position, date parts and constant metadata."""
    when = dates.import_datetime("date_original")
    rows = add_missing(sheets, REQUIRED).filter(F.col("file_name").isNotNull())
    keep = [F.col("source_file")] if "source_file" in sheets.columns else []
    return rows.select(
        text.lower_jpg("file_name").alias("encounter_media_asset0"),
        *[F.lit(v).alias(k) for k, v in constants.items()],
        F.col("latitude").try_cast("double").alias("encounter_decimal_latitude"),
        F.col("longitude").try_cast("double").alias("encounter_decimal_longitude"),
        F.year(when).alias("encounter_year"),
        F.month(when).alias("encounter_month"),
        F.dayofmonth(when).alias("encounter_day"),
        *keep,
    )


def unparsed_dates(sheets: DataFrame) -> DataFrame:
    """Reject table: rows whose date text could not be read."""
    return sheets.filter(dates.import_datetime("date_original").isNull())


def encounter_links(encounters: DataFrame, base_url: str) -> DataFrame:
    url = text.link(base_url, "id")
    return encounters.select(
        "date",
        "id",
        F.col("occurrenceId").alias("occurrence_id"),
        F.col("numberMediaAssets").alias("number_media_assets"),
        url.alias("encounter_url"),
        text.hyperlink_formula(url).alias("encounter_link"),
        "submitter_display_name",
    )


def renamed_export(listing: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The same columns under the target system's names."""
    return listing.withColumnsRenamed(dict(names))
