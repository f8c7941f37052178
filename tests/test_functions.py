"""Literal cases for the scalar rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from resight.functions import dates, ids, keywords as kw, ratings, text
from resight.functions.match import flag, has


def apply(spark, values, fn):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", fn(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_canonical_id(spark):
    values = ["0560", " 560 ", "56R", "560d", "1e3", "", None, "560.0", "56.50", "-7", "UNK", ".5"]
    assert apply(spark, values, ids.canonical_id) == [
        "560", "560", None, None, None, None, None, "560", "56.5", "-7", None, "0.5",
    ]
    assert apply(spark, ["0560", "56.5", "x"], ids.id_number) == [560, None, None]
    digits = "12345678901234567890123456789012345678901234567890"
    long = [digits, f" 00{digits}.500 ", f"-{digits}.0", f"+{digits}", f"{digits}x", f"{digits}e3"]
    assert apply(spark, long, ids.canonical_id) == [digits, f"{digits}.5", f"-{digits}", digits, None, None]


def test_placeholders_and_remap(spark):
    values = ["unk", "UNK-1", "See Crops", "5908", None]
    assert apply(spark, values, ids.null_placeholder) == [None, None, None, "5908", None]
    assert apply(spark, values, lambda c: ids.null_placeholder(c, ignore_case=False)) == [
        None, "UNK-1", "See Crops", "5908", None,
    ]
    assert apply(spark, ["56R", "x56R", None], lambda c: ids.remap(c, {"56R": "560"})) == ["560", "x56R", None]
    assert apply(spark, ["56R", "x56R"], lambda c: ids.remap_containing(c, {"56R": "56"})) == ["56", "56"]


def test_id_side_null_key(spark):
    assert apply(spark, ["5", None], lambda c: ids.id_side(c, F.lit("Left"))) == ["5-LEFT", None]


def test_has_literal_and_regex_agree(spark):
    values = ["Left, x", "left", "RIGHT", None, ""]
    literal = apply(spark, values, lambda c: has(c, "Left|left"))
    assert literal == [True, True, False, None, False]
    assert literal == apply(spark, values, lambda c: c.rlike("Left|left"))
    assert apply(spark, values, lambda c: has(c, "left|right", True)) == [True, True, True, None, False]
    assert apply(spark, values, lambda c: flag(c, "Left")) == [True, False, False, False, False]


def test_side_left_wins(spark):
    assert apply(spark, ["Right, Left", "right", "Melon", None], kw.side) == ["Left", "Right", "UNK", "UNK"]
    assert apply(spark, ["Right, Left", "Left", "x"], kw.side_last_wins) == ["right", "left", None]


def test_stars(spark):
    values = ["* * * * *", "* * * *", "* * *", "* *", "*", "", None]
    assert apply(spark, values, ratings.stars) == [4, 4, 3, 2, 1, None, None]


def test_label_comma_rule(spark):
    values = ["Melon_F", "Melon_F, x", "x, biopsy-Female", "Melon_M, Melon_UNK", "Melon_UNK", "x", None]
    assert apply(spark, values, kw.label) == [None, "FemaleJ", "FemaleJ", "MaleM", "UNK", None, None]
    assert apply(spark, ["Melon_F"], lambda c: kw.label(c, "melon_source")) == ["FemaleJ"]
    assert apply(spark, ["Melon_F", None], lambda c: kw.label(c, "morphology_2025")) == ["UNK", "UNK"]


def test_label_word_boundaries(spark):
    values = ["Sex_F", "xSex_F", "FJ, MM", "FJX", "MM", "biopsy-Male"]
    assert apply(spark, values, lambda c: kw.label(c, "catalogue_tags")) == [
        "FemaleJ", "UNK", "FemaleJ", "UNK", "MaleM", "UNK",
    ]
    assert apply(spark, ["biopsy-Male", "FemaleJ", "Female"], lambda c: kw.label(c, "dorsal_tags")) == [
        "MaleM", "FemaleJ", None,
    ]
    assert apply(spark, ["FemaleJ, Male", "FemaleJ"], lambda c: kw.label(c, "metadata")) == [
        "Male", "Female-Juvenile",
    ]


@pytest.mark.parametrize(
    "lon, keyword, place",
    [(-58.7, "", "Gully"), (-58.6999, "", "Shortland"), (-58.1, "", "Haldimand"), (None, "Gully", "Gully"), (None, "x", "??"), (-57.0, "Gully", "Gully")],
)
def test_place_edges(spark, lon, keyword, place):
    df = spark.createDataFrame([(lon, keyword)], "lon double, k string")
    assert df.select(kw.place("k", "lon").alias("p")).first()["p"] == place


def test_medium_null_year(spark):
    assert apply(spark, ["Digital", "x", None], lambda c: kw.medium(c, F.lit(None).cast("int"))) == [
        "Digital", "Film", "Film",
    ]
    assert apply(spark, ["x"], lambda c: kw.medium(c, F.lit(2015))) == ["Digital"]


def test_listing_date(spark):
    d = dt.date
    values = ["2025-07-14 13:05:22", "2025-7-4", "2025-7-4 08:00", "2025-07-14abc", "2025-7-4abc", "2025", "2025-07", "14/07/2025", "", None, "2025-13-40"]
    assert apply(spark, values, dates.listing_date) == [
        d(2025, 7, 14), d(2025, 7, 4), d(2025, 7, 4), d(2025, 7, 14), d(2025, 7, 4), None, None, None, None, None, None,
    ]


def test_any_date(spark):
    d = dt.date
    values = ["2019-07-27", "7/14/2019", "14/7/2019", "3/4/2019", "2019/7/27", "27-7-2019", "43673", "junk", None]
    assert apply(spark, values, dates.any_date) == [
        d(2019, 7, 27), d(2019, 7, 14), d(2019, 7, 14), d(2019, 3, 4), d(2019, 7, 27), d(2019, 7, 27), d(2019, 7, 27), None, None,
    ]
    assert apply(spark, ["3/4/2019", "4/14/2019"], dates.day_month_first) == [d(2019, 4, 3), d(2019, 4, 14)]


def test_import_datetime(spark):
    t = dt.datetime
    values = ["7/14/2025 1:05:22 PM", "‎2025-07-14 13:05", "2025/07/14 1:05:22 AM", "2025-07-14", "14 July", None, "7/14/2025 12:00 AM"]
    assert apply(spark, values, dates.import_datetime) == [
        t(2025, 7, 14, 13, 5, 22), t(2025, 7, 14, 13, 5), t(2025, 7, 14, 1, 5, 22), t(2025, 7, 14), None, None, t(2025, 7, 14),
    ]


def test_datetime_needs_all_parts(spark):
    t = dt.datetime
    values = ["2025-07-14 13:05:22", " 2025-7-4 1:02:03 ", "2025-07-14", "2025-07-14 13:05", "", None, "x:y:z"]
    assert apply(spark, values, dates.datetime) == [
        t(2025, 7, 14, 13, 5, 22), t(2025, 7, 4, 1, 2, 3), None, None, None, None, None,
    ]


def test_wall_micros_ignores_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Halifax")
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.5' a, timestamp_ntz'2024-03-10 01:30:00' b")
        row = df.select((dates.wall_micros("a") - dates.wall_micros("b")).alias("gap")).first()
        assert row["gap"] == 3_600_500_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_years_and_tags(spark):
    assert apply(spark, ["X_20190727_1.JPG", "none"], dates.year_in_text) == [2019, None]
    assert apply(spark, ["2012, 2007", "1999"], lambda c: dates.year_tag(c, range(2006, 2022))) == [2012, None]


def test_exif_day(spark):
    assert apply(spark, ["2022:11:01 10:00:00", None], lambda c: dates.exif_day(c, F.lit("2020:01:02 00:00:00"))) == [
        "2022-11-01", "2020-01-02",
    ]


def test_file_names(spark):
    assert apply(spark, ["/a/IMG_1.JPG", " b.Jpeg", "noext"], text.match_key) == ["img_1", "b", "noext"]
    assert apply(spark, ["/a/IMG-12.JPG", "a-b.jpg", "x-1-2.png"], text.rename_key) == ["IMG", "a-b", "x-1"]
    assert apply(spark, ["a.JPG", "a.jpg", "a.JPG.x"], text.lower_jpg) == ["a.jpg", "a.jpg", "a.JPG.x"]
    assert apply(spark, ["a.JPG", "a.b.png", "noext"], lambda c: text.with_suffix(c, "-3")) == [
        "a-3.JPG", "a.b-3.png", "noext-3",
    ]
    assert apply(spark, ["/x/A.JPG", "b.tiff", "c"], text.extension) == ["jpg", "tiff", ""]


def test_biopsy_text(spark):
    assert apply(spark, ["Left, biopsy-Female taken, x", "Biopsy; y", "nobiopsy", None], kw.biopsy_text) == [
        "biopsy-Female taken", "Biopsy", None, None,
    ]


def test_whole_rating(spark):
    assert apply(spark, ["0", "3", "x", None, ""], ratings.whole_rating) == [None, 3, None, None, None]


def test_comparison_columns(spark):
    rows = [(3, 2), (2, 3), (4, 4), (None, 1), (1, 4)]
    df = spark.createDataFrame(rows, "m int, a int").select("*", *ratings.comparison_columns("m", "a"))
    got = [(r["q_comparable"], r["q_diff"], r["q_agree"], r["q_flag"], r["q_direction"]) for r in df.collect()]
    assert got == [
        (True, 1, False, True, "pipeline_lower"),
        (True, 1, False, True, "pipeline_higher"),
        (True, 0, True, False, "agree"),
        (False, None, None, False, None),
        (True, 3, False, True, "pipeline_higher"),
    ]
    wide = spark.createDataFrame(rows, "m int, a int").select(*ratings.comparison_columns("m", "a", 1))
    assert [r["q_flag"] for r in wide.collect()] == [False, False, False, False, True]


def test_rating_json(spark):
    bodies = [
        '```json\n{"cetacean_present": true, "body_parts": ["dorsal_fin","melon"], "dorsal_q_rating": 3, "output_folder": "Q3_good"}\n```',
        '{"cetacean_present": false, "body_parts": []}',
        "not json",
        None,
    ]
    df = spark.createDataFrame([(f"/p/{i}.jpg", b) for i, b in enumerate(bodies)], "path string, response string")
    out = df.select("path", ratings.parse_result("response").alias("r")).select(
        *ratings.result_columns("path", F.lit(None).cast("string"), "r")
    )
    rows = out.collect()
    assert [r["filename"] for r in rows] == ["0.jpg", "1.jpg", "2.jpg", "3.jpg"]
    assert [r["body_parts"] for r in rows] == ["dorsal_fin; melon", None, None, None]
    assert [r["output_folder"] for r in rows] == ["Q3_good", "error_no_folder", "error_api_failure", "error_api_failure"]
    assert rows[0]["dorsal_q_rating"] == 3 and rows[2]["rationale"].startswith("API call failed")


def test_report_cells(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert tuple(text.report_cells(df).first()) == ("1", "—")


def test_path_names_keep_folders_apart(spark):
    from resight.functions.text import path_name

    paths = ["file:///in/a/x.csv", "/in/b/x.csv", "x.csv", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(path_name("p").alias("n"))
    assert [r.n for r in df.collect()] == ["in__a__x", "in__b__x", "x", None]


def test_dates_in_free_spellings(spark):
    from resight.functions.dates import any_date

    texts = {
        "20190727": "2019-07-27", "2019.07.27": "2019-07-27", "27 Jul 2019": "2019-07-27", "July 27, 2019": "2019-07-27",
        "27.07.2019": "2019-07-27", "07 27 2019": "2019-07-27", "2958465": "9999-12-31", "43673": "2019-07-27", "2019": None,
        "27Jul2019": "2019-07-27", "2019 Xyz 27": None, "9999999": None, "": None, "2019-7-27 10:00": "2019-07-27",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", any_date("t").cast("string").alias("d"))
    assert {r.t: r.d for r in df.collect()} == texts
