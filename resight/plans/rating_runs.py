"""Automated rating results, their run summary, and comparison with manual ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resight.functions import dates, ratings, text
from resight.operators import joins
from resight.operators.gates import require_columns

PASS_THROUGH = [
    "output_folder", "borderline_Q3", "trailing_edge_clear", "exposure_recoverable",
    "multiple_whales", "melon_present", "rationale",
]
CONTEXT = ["year", "date", "location", "reliable", "biopsy", "title", "keyword"]


def parse_ratings(responses: DataFrame) -> DataFrame:
    """Raw responses (path, two EXIF tags, response text) to flat result rows."""
    parsed = responses.select(
        "path",
        dates.exif_day("date_time_original", "create_date").alias("exif_date"),
        ratings.parse_result("response").alias("result"),
    )
    return parsed.select(*ratings.result_columns("path", "exif_date", "result"))


def run_summary(results: DataFrame) -> DataFrame:
    folder = F.col("output_folder")
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(folder == name).alias(name.lower()) for name in ratings.FOLDERS],
        F.count_if(F.lower(folder).contains("error")).alias("errors"),
        F.count_if(F.col("borderline_Q3")).alias("borderline"),
        F.count_if(~F.col("trailing_edge_clear")).alias("trailing_edge_unclear"),
        F.count_if((folder == "Q3_good") & ~F.col("trailing_edge_clear")).alias("trailing_edge_review"),
        F.count_if(F.col("multiple_whales")).alias("multiple"),
        F.count_if(F.col("melon_present")).alias("melons"),
        F.count_if(F.col("crop_recommended")).alias("crops"),
    )


def manual_side(manual: DataFrame) -> DataFrame:
    require_columns(manual, ["file_name", "qrate"], "manual ratings")
    context = [c for c in CONTEXT if c in manual.columns]
    return manual.select(
        text.match_key("file_name").alias("match_key"),
        F.col("file_name").alias("lv_filename_raw"),
        ratings.whole_rating("qrate").alias("lv_q"),
        *context,
    )


def auto_side(auto: DataFrame) -> DataFrame:
    require_columns(auto, ["filename", "dorsal_q_rating"], "automated ratings")
    return auto.select(
        text.match_key("filename").alias("match_key"),
        F.col("filename").alias("pipe_filename_raw"),
        F.col("dorsal_q_rating").try_cast("int").alias("pipe_q"),
        *[c for c in PASS_THROUGH if c in auto.columns],
    )


def compare_ratings(manual: DataFrame, auto: DataFrame, threshold: int = 0) -> DataFrame:
    """Every manual rating with every automated one of the same name. Names that repeat on both sides, as those of
    photos in different folders do, give all pairs; :func:`repeated_keys` reports them."""
    left, right = manual_side(manual), auto_side(auto)
    joined = joins.many_to_many(left, right, "match_key", left.columns)
    return joined.select("*", *ratings.comparison_columns("lv_q", "pipe_q", threshold))


def export_order() -> list[Column]:
    """Flagged pairs first, then the largest differences; names make the order total where they are unique."""
    return [F.col("any_flag").desc_nulls_last(), F.col("q_diff").desc_nulls_last(), F.col("match_key"), F.col("pipe_filename_raw")]


def repeated_keys(manual: DataFrame, auto: DataFrame) -> DataFrame:
    """Names that stand for several photos on either side, with how often."""
    counts = joins.key_counts(manual_side(manual), auto_side(auto), "match_key")
    return counts.filter("n_left > 1 or n_right > 1").select(
        "match_key", F.col("n_left").alias("n_manual"), F.col("n_right").alias("n_auto")
    )


def unmatched(manual: DataFrame, auto: DataFrame) -> DataFrame:
    """Images without a partner on the other side, counted by anti joins (keys may repeat)."""
    a, b = manual_side(manual).select("match_key"), auto_side(auto).select("match_key")

    def count(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        return left.join(right, "match_key", "left_anti").agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_unmatched")
        )

    return count(a, b, "manual").unionByName(count(b, a, "automated"))


def disagreements(comparison: DataFrame) -> DataFrame:
    return comparison.filter("any_flag")


def boundary(comparison: DataFrame) -> DataFrame:
    """Usable against unusable: manual 3 and automated 2, or the reverse."""
    a, b = F.col("lv_q"), F.col("pipe_q")
    return comparison.filter(((a == 3) & (b == 2)) | ((a == 2) & (b == 3)))


def large_differences(comparison: DataFrame, at_least: int = 2) -> DataFrame:
    return comparison.filter(F.col("q_diff") >= at_least)


def notable(comparison: DataFrame, at_least: int = 2) -> DataFrame:
    """Boundary cases and large differences in one pass, tagged by kind."""
    a, b = F.col("lv_q"), F.col("pipe_q")
    tags = F.array_compact(
        F.array(
            F.when(((a == 3) & (b == 2)) | ((a == 2) & (b == 3)), "boundary"),
            F.when(F.col("q_diff") >= at_least, "large"),
        )
    )
    return comparison.select("*", F.explode(tags).alias("kind"))


def agreement(comparison: DataFrame) -> DataFrame:
    """Agreement counts and shares over the images rated by both."""
    a, b = F.col("lv_q"), F.col("pipe_q")
    counts = comparison.filter("q_comparable").agg(
        F.count(F.lit(1)).alias("q_total"),
        F.count_if("q_agree").alias("agree"),
        F.count_if("q_flag").alias("disagree"),
        F.count_if(F.col("q_direction") == "pipeline_higher").alias("pipeline_higher"),
        F.count_if(F.col("q_direction") == "pipeline_lower").alias("pipeline_lower"),
        F.count_if((a == 3) & (b == 2)).alias("manual3_auto2"),
        F.count_if((a == 2) & (b == 3)).alias("manual2_auto3"),
    )

    def share(c: str):
        return F.round(F.try_divide(F.lit(100.0) * F.col(c), F.col("q_total")), 1)

    return counts.withColumns({"agree_pct": share("agree"), "disagree_pct": share("disagree")})


def magnitudes(comparison: DataFrame) -> DataFrame:
    return comparison.filter("q_flag").groupBy("q_diff").agg(F.count(F.lit(1)).alias("n"))
