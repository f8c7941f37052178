"""Reading catalogue exports: listings, nested folders of sheets, JSON documents, file lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resight.functions.text import base_name, extension

LISTING_COLUMNS = [
    "File.name",
    "Title",
    "Date.Original",
    "Keyword.export",
    "Rating",
    "Latitude",
    "Longitude",
]
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "tif", "tiff", "cr2", "nef", "arw"]


def snake(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def normalise_headers(df: DataFrame) -> DataFrame:
    """snake_case headers ('Date Original', 'Date.Original' -> date_original)."""
    return df.toDF(*[snake(c) for c in df.columns])


def add_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Required columns that are absent are added as null text."""
    absent = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def keep_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Optional columns: keep those that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def find_columns(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Rename the first column whose name matches each pattern; null text where none does."""
    picked = []
    for name, pattern in patterns.items():
        hits = [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]
        source = F.col(f"`{hits[0]}`") if hits else F.lit(None)
        picked.append(source.cast("string").alias(name))
    return df.select(*picked)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Blank and 'NA' both mean missing."""
    return df.select(
        [
            F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if t == "string" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_listing(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = LISTING_COLUMNS,
    multi_line: bool = False,
    bad_records: bool = False,
) -> DataFrame:
    """Listing CSV, every column as text; the header must name the columns in this order.

    ``multi_line`` reads quoted line breaks as part of their field; a file is then one task, so a long listing
    should be exported in several files. ``bad_records`` adds ``bad_record``, the text of a record whose number of
    fields is not the header's (its leading fields are read nevertheless).
    """
    schema = text_schema(columns)
    if bad_records:
        schema = schema.add("bad_record", T.StringType())
    raw = spark.read.option("columnPruning", str(not bad_records).lower()).csv(
        path,
        schema=schema,
        header=True,
        enforceSchema=False,
        nullValue="NA",
        multiLine=multi_line,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="bad_record",
    )
    return blank_to_null(normalise_headers(raw))


def read_typed_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with declared types; a field that does not fit becomes null."""
    return spark.read.csv(path, schema=schema, header=True, nullValue="NA", mode="PERMISSIVE")


def read_folder_csvs(
    spark: SparkSession,
    root: str,
    columns: Sequence[str],
    glob: str = "*.csv",
) -> DataFrame:
    """All CSVs under a folder with a common header, source file kept in ``source_file``.

    Rows that do not fit are kept with their text in ``bad_record``; one bad file does not stop
    the rest.
    """
    schema = text_schema(columns).add("bad_record", T.StringType())
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("columnPruning", "false")
        .csv(
            root,
            schema=schema,
            header=True,
            nullValue="NA",
            mode="PERMISSIVE",
            columnNameOfCorruptRecord="bad_record",
        )
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def read_import_sheets(
    spark: SparkSession, sheets: Mapping[tuple[str, ...], str | Sequence[str]], required: Sequence[str]
) -> DataFrame:
    """Sheets of a few known headers, one read per header, united by name, gaps as null. Folders of sheets with unknown
    headers are read by :mod:`resight.sources.sheets`."""
    frames = []
    for header, paths in sheets.items():
        # Without pruning a line of the wrong width is seen whichever columns are asked for.
        part = spark.read.option("columnPruning", "false").csv(
            list(paths) if not isinstance(paths, str) else paths,
            schema=text_schema(header).add("bad_record", T.StringType()),
            header=True,
            nullValue="NA",
            mode="PERMISSIVE",
            columnNameOfCorruptRecord="bad_record",
            recursiveFileLookup=True,
            pathGlobFilter="*.csv",
        ).withColumn("source_file", F.col("_metadata.file_path"))
        frames.append(blank_to_null(add_missing(normalise_headers(part), required)))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


ENCOUNTER_SCHEMA = T.StructType().add(
    "task",
    T.StructType().add(
        "encounters",
        T.ArrayType(
            T.StructType()
            .add("date", T.StringType())
            .add("id", T.StringType())
            .add("occurrenceId", T.StringType())
            .add("numberMediaAssets", T.LongType())
            .add("submitter", T.StructType().add("displayName", T.StringType()))
        ),
    ),
)


def read_encounter_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Task documents to one row per encounter. One document per line splits; a pretty-printed
    document needs ``multi_line``."""
    docs = spark.read.json(path, schema=ENCOUNTER_SCHEMA, multiLine=multi_line)
    return docs.select(F.explode("task.encounters").alias("e")).select(
        "e.date", "e.id", "e.occurrenceId", "e.numberMediaAssets",
        F.col("e.submitter.displayName").alias("submitter_display_name"),
    )


def file_inventory(
    spark: SparkSession, root: str, extensions: Sequence[str] = IMAGE_EXTENSIONS, recursive: bool = True
) -> DataFrame:
    """Files by extension (case ignored); contents are pruned away and never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modification_time"))
    )
    return files.filter(extension("path").isin(*extensions))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
