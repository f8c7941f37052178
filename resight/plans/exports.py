"""Writing the analysis tables under their published column names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from resight.plans import finalize
from resight.sources.writers import write_csv

# Column names the receiving programs expect, in table order.
PRIMARY = ["ID_numeric", "ID.side", "Melon_Sex", "Sex_genetic", "YEAR1", "YEARLAST", "ANIMAL_YRS", "N_Photos"]
MASTER = ["ID", "ID.side", "Sex", "Sex_genetics", "YEAR1", "YEARLAST", "ANIMAL_YRS", "N"]
SOCIAL = [
    "QRATE", "Date", "Date.Original", "Location", "Latitude", "Longitude", "side", "Reliable", "Sex", "ID",
]
SUPPLEMENT = ["ID", "Sex", "Reliable"]
SIMPLE = ["ID.side", "QRATE", "Date", "Location", "Reliable", "Sex", "ID"]


def export_tables(final: DataFrame) -> dict[str, DataFrame]:
    """The analysis tables of a final listing, by export name."""
    return {
        "id_sex_primary_yrs": finalize.primary_ids(final).toDF(*PRIMARY),
        "id_sex_master": finalize.master_ids(final).toDF(*MASTER),
        "social_photos": finalize.social_photos(final).toDF(*SOCIAL),
        "social_supplement": finalize.social_supplement(final).toDF(*SUPPLEMENT),
        "simple_photos": finalize.simple_photos(final).toDF(*SIMPLE),
    }


def write_exports(final: DataFrame, version: str, folder: str) -> dict[str, str]:
    """Write every analysis table as CSV; the paths by export name.

    Several tables are read from ``final``, so hand in a saved listing, not a long plan.
    """
    return {name: write_csv(df, folder, name, version) for name, df in export_tables(final).items()}


def write_reports(reports: dict[str, DataFrame], version: str, folder: str) -> dict[str, str]:
    """Write review reports as CSV, leaving out the empty ones."""
    return {name: write_csv(df, folder, name, version) for name, df in reports.items() if not df.isEmpty()}
