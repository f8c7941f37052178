"""Photo ratings: star text, automated JSON results, manual-versus-automated comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resight.functions.text import base_name

# Fields of one automated rating result and the run's folder names.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("cetacean_present", T.BooleanType()),
        T.StructField("species_confidence", T.StringType()),
        T.StructField("body_parts", T.ArrayType(T.StringType())),
        T.StructField("multiple_whales", T.BooleanType()),
        T.StructField("non_cetacean_present", T.BooleanType()),
        T.StructField("non_cetacean_note", T.StringType()),
        T.StructField("dorsal_q_rating", T.IntegerType()),
        T.StructField("borderline_Q3", T.BooleanType()),
        T.StructField("exposure_recoverable", T.BooleanType()),
        T.StructField("trailing_edge_clear", T.BooleanType()),
        T.StructField("melon_present", T.BooleanType()),
        T.StructField("crop_recommended", T.BooleanType()),
        T.StructField("output_folder", T.StringType()),
        T.StructField("rationale", T.StringType()),
        T.StructField("_bad", T.StringType()),
    ]
)
FOLDERS = [
    "Q4_excellent",
    "Q3_good",
    "Q2_poor",
    "Q1_reject",
    "review_melon_only",
    "review_unclear",
    "reject_no_whale",
]
PARSE_ERROR = "error_api_failure"
NO_FOLDER = "error_no_folder"
PARSE_ERROR_TEXT = "API call failed or response could not be parsed"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stars(text: Column | str) -> Column:
    """Most spaced stars found, 4 down to 1; no star is null."""
    text = _col(text)
    return (
        F.when(text.contains("* * * *"), 4)
        .when(text.contains("* * *"), 3)
        .when(text.contains("* *"), 2)
        .when(text.contains("*"), 1)
    )


def whole_rating(text: Column | str) -> Column:
    """Rating as a whole number, null when it is none; zero means unrated."""
    return F.nullif(_col(text).try_cast("int"), F.lit(0))


def parse_result(response: Column | str) -> Column:
    """Result struct of one response; code fences around the JSON are dropped."""
    clean = F.trim(F.regexp_replace(_col(response), "```json|```", ""))
    return F.from_json(
        clean, RESULT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    )


def result_columns(path: Column | str, exif_date: Column | str, result: Column | str) -> list[Column]:
    """Flat row of one result: missing fields stay null, an unreadable result is an error row."""
    r = _col(result)
    bad = r.isNull() | r["_bad"].isNotNull()
    parts = r["body_parts"]
    cols = [
        base_name(path).alias("filename"),
        _col(path).alias("filepath_full"),
        _col(exif_date).alias("exif_date"),
    ]
    for field in RESULT_SCHEMA.fieldNames():
        if field == "_bad":
            continue
        value = r[field]
        if field == "body_parts":
            value = F.when(F.size(parts) > 0, F.array_join(parts, "; "))
        elif field == "output_folder":
            value = F.coalesce(value, F.lit(NO_FOLDER))
        fallback = {"output_folder": PARSE_ERROR, "rationale": PARSE_ERROR_TEXT}.get(field)
        cols.append(F.when(bad, F.lit(fallback)).otherwise(value).alias(field))
    return cols


def comparison_columns(
    manual: Column | str, auto: Column | str, threshold: int = 0
) -> list[Column]:
    manual, auto = _col(manual), _col(auto)
    comparable = manual.isNotNull() & auto.isNotNull()
    gap = F.abs(manual - auto)
    flagged = F.coalesce(gap > threshold, F.lit(False))
    direction = (
        F.when(manual == auto, "agree")
        .when(auto > manual, "pipeline_higher")
        .when(auto < manual, "pipeline_lower")
    )
    return [
        comparable.alias("q_comparable"),
        gap.alias("q_diff"),
        (manual == auto).alias("q_agree"),
        flagged.alias("q_flag"),
        direction.alias("q_direction"),
        flagged.alias("any_flag"),
    ]
