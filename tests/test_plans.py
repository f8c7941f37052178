"""Literal cases for the report plans, and round trips through files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from resight.operators import gates
from resight.plans import (
    annual, base, catalogues, exports, finalize, imports, keyword_conflicts as kc, label_history as lh, label_qa,
    metadata, rating_runs, renames, stats,
)
from resight.sources import readers, sheets, writers

LISTING = "photo_seq bigint, file_name string, title string, date_original string, keyword_export string, rating string, latitude string, longitude string"


def listing(spark, rows):
    """rows: (title, date, keyword) or with rating, latitude and longitude as well."""
    full = []
    for i, r in enumerate(rows):
        r = (*r, *("* * *", "44", "-59")[len(r) - 3 :]) if len(r) < 6 else r
        year = (r[1] or "2000")[:4]
        full.append((i, f"IMG_{year}0101_{i}.JPG", *r))
    return spark.createDataFrame(full, LISTING)


def photos(spark, rows):
    """rows: (id, year, keyword) for the label-history plans."""
    full = [(i, f"IMG_{y}0101_{i}.JPG" if y else "IMG.JPG", t, "", k, "", "", "") for i, (t, y, k) in enumerate(rows)]
    return lh.melon_photos(spark.createDataFrame(full, LISTING))


def by(rows, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in rows.collect()}


def test_base_keeps_or_drops_invalid_ids(spark):
    df = listing(spark, [("5", "2001-01-01", "Left"), ("UNK", "2001-01-01", "Left"), ("5", "2001-01-01", "Melon")])
    assert base.clean_base(df).count() == 1
    assert base.clean_base(df, drop_invalid_ids=False).count() == 2


def test_review_lists_group_unknown_ids(spark):
    df = base.derive(listing(spark, [("56R", "", "a"), ("56R", "2001-02-03", "b"), ("UNK", "", None), ("7", "2001-02-03", "Left")]))
    assert by(base.non_numeric_ids(df), "id_original", "n_photos") == {"56R": (2,), "UNK": (1,)}
    got = by(base.photos_without_side(df), "id_original", "n_photos", "sample_keywords", "first_date")
    assert got == {"56R": (2, "a | b", dt.date(2001, 2, 3)), "UNK": (1, "NA", None)}


def test_unknown_location(spark):
    df = base.derive(listing(spark, [("7", "2001-02-03", "Left, a", "", "44.5", ""), ("7", "", "Left, b", "", "", "x"), ("8", "", "Left, Gully", "", "", "")]))
    got = by(base.photos_without_location(df), "id", "n_photos", "has_lat", "has_long", "sample_lat", "sample_keywords")
    assert got == {"7": (2, 1, 0, 44.5, "Left, a | Left, b")}


def test_gate_then_propagation(spark):
    rows = [
        ("1", "2001-01-01", "Left, Melon_F, x"),
        ("1", "2003-05-01", "Left, biopsy"),
        ("1", "2002-01-01", "Right, Melon_M, x"),
        ("2", "", "Left"),
        ("2", "2004-01-01", "Left"),
        ("UNK", "2004-01-01", "Left, Melon_M, x"),
        ("FIX", "2004-01-01", "Left"),
    ]
    clean = base.clean_base(listing(spark, rows), drop_invalid_ids=False)
    with pytest.raises(gates.GateError, match="1"):
        finalize.finalize(clean)
    fixes = finalize.corrections_from_precedence(clean)
    assert [tuple(r) for r in fixes.collect()] == [("1", "FemaleJ", "MaleM")]
    out = finalize.finalize(clean, fixes)
    got = by(out, "photo_seq", "sex", "biopsy", "sex_genetic", "id_side", "animal_yrs")
    assert got[0] == ("MaleM", "YES", "Male", "1-LEFT", 3)
    assert got[2] == ("MaleM", "YES", "Male", "1-RIGHT", 1)
    assert got[3] == ("UNK", None, "UNK", "2-LEFT", None)  # an undated photo: the span is unknown
    assert got[5] == ("MaleM", None, "UNK", None, None)
    assert got[6] == ("UNK", None, "UNK", None, None)  # nothing spreads over unidentified photos
    table = by(finalize.primary_ids(out.filter("id is not null")), "id_side", "year1", "yearlast", "animal_yrs", "n_photos", "melon_sex")
    assert table == {"1-LEFT": (2001, 2003, 3, 2, "FemaleJ"), "1-RIGHT": (2002, 2002, 1, 1, "MaleM"), "2-LEFT": (None, None, None, 2, "UNK")}


def test_propagation_without_gate_fills_in_date_order(spark):
    rows = [("1", "2001-01-01", "Left"), ("1", "2002-01-01", "Left, Melon_F, x"), ("1", "2003-01-01", "Left"), ("1", "2004-01-01", "Left, Melon_M, x"), ("1", "", "Left")]
    out = finalize.finalize(base.clean_base(listing(spark, rows)), gate=False)
    assert [v[0] for _, v in sorted(by(out, "photo_seq", "sex").items())] == ["FemaleJ", "FemaleJ", "FemaleJ", "MaleM", "MaleM"]


def test_supplement_counts_only_dated_reliable_years(spark):
    rows = [("1", "", "Left, Notch"), ("1", "2001-01-01", "Left"), ("2", "2001-01-01", "Left, Indent"), ("2", "2001-01-01", "Right")]
    out = finalize.finalize(base.clean_base(listing(spark, rows)))
    assert by(finalize.social_supplement(out), "id", "sex", "reliable") == {"1": ("UNK", False), "2": ("UNK", True)}


def test_label_conflict_report(spark):
    rows = [("1", "2001-01-01", "Left, Melon_M, x"), ("1", "", "Left, Melon_F, x"), ("1", "2005-01-01", "Left, biopsy"), ("2", "2001-01-01", "Left, Melon_F, x")]
    clean = base.clean_base(listing(spark, rows))
    got = by(label_qa.label_conflicts(clean), "id", "sex_categories", "n_photos_total", "biopsied", "first_femalej_date", "last_date")
    assert got == {"1": ("MaleM & FemaleJ", 2, "NO", None, dt.date(2005, 1, 1))}
    assert label_qa.conflict_photos(clean).count() == 3
    assert gates.label_conflicts(clean, "id", "sex").count() == 1


def test_label_history_strict_dates(spark):
    rows = [("1", "2001-01-01", "Left"), ("1", "2003-01-01", "Left, Melon_F, x"), ("2", "", "Left, Melon_F, x"), ("2", "2001-01-01", "Left"), ("3", "2001-01-01", "Left")]
    got = by(label_qa.label_history(base.clean_base(listing(spark, rows))), "id", "first_sighting", "first_sex_determination", "sex_determined", "years_before_sex_known")
    assert got["1"] == (dt.date(2001, 1, 1), dt.date(2003, 1, 1), "FemaleJ", pytest.approx(730 / 365.25))
    assert got["2"] == (None, None, "FemaleJ", None)
    assert got["3"] == (dt.date(2001, 1, 1), None, None, None)


def test_genetic_vs_morphology(spark):
    rows = [("1", "2001-01-01", "Left, Melon_M, biopsy-Female, x"), ("2", "2001-01-01", "Left, Melon_M, biopsy-Male, x"), ("3", "2001-01-01", "Left, biopsy-Male")]
    assert by(label_qa.genetic_vs_morphology(base.clean_base(listing(spark, rows))), "id", "sex", "melon_sex") == {"1": ("FemaleJ", "MaleM")}


SUMMARY = [
    ("tie", 2000, "Sum_F"), ("tie", 2001, "Sum_M"),
    ("mix", 2000, "Sum_F"), ("mix", 2000, "Sum_UNK"),
    ("both", 2000, "Sum_F"), ("both", 2000, "Sum_M"), ("both", 2000, "Sum_UNK"),
    ("unk", 2000, "Sum_UNK"), ("none", 2000, "x"),
    ("back", 2000, "Sum_M"), ("back", 2002, "Sum_F"), ("back", 2003, "x"),
    ("src", 2001, "Melon_F, Sum_M"), ("same", 2001, "Melon_F, Sum_F"), ("noyear", None, "Sum_F"),
    ("dorsal", 2001, "Dorsal, Sum_F"),
]


def test_label_summary(spark):
    got = by(lh.id_summary(photos(spark, SUMMARY), 2025), "id", "primary_sex", "current_sex", "possible_maturation", "yrs_since_melon_age")
    assert got == {
        "tie": ("CONFLICT", "MaleM", True, 24),
        "mix": ("FemaleJ", "UNK_from_known", False, 25),
        "both": ("CONFLICT", "CONFLICT", False, 25),
        "unk": ("UNK", "UNK", False, 25),
        "none": ("UNK", None, None, 25),
        "back": ("CONFLICT", "FemaleJ", False, 22),
        "src": ("MaleM", "MaleM", False, 24),
        "same": ("FemaleJ", "FemaleJ", False, 24),
        "noyear": ("FemaleJ", None, None, None),
    }


def test_source_comparison(spark):
    got = by(lh.source_comparison(photos(spark, SUMMARY)), "id", "keywords_present", "inter_keyword_conflict", "all_keywords_identical", "melon_sex_values", "sum_sex_values")
    assert got["src"] == ("Melon, Sum", True, False, "FemaleJ", "MaleM")
    assert got["same"] == ("Melon, Sum", False, True, "FemaleJ", "FemaleJ")
    assert got["mix"] == ("Sum", False, False, "", "FemaleJ & UNK")
    assert "none" not in got


def test_year_classes(spark):
    history = {(r["id"], r["year"]): r["sex_annual"] for r in lh.history_detailed(photos(spark, SUMMARY)).collect()}
    assert history[("both", 2000)] == "CONFLICT" and history[("mix", 2000)] == "FemaleJ" and history[("none", 2000)] == "No Sex"
    years = {(r["id"], r["year"]): r["primary_sex_annual"] for r in lh.conflict_years(photos(spark, SUMMARY)).collect()}
    assert years[("mix", 2000)] == "UNK_from_known" and years[("both", 2000)] == "CONFLICT"
    patterns = by(lh.conflict_patterns(photos(spark, SUMMARY)), "id", "years_as_femalej", "years_as_malem", "years_with_conflict", "possible_maturation")
    assert patterns == {
        "tie": ("2000", "2001", "", True), "mix": ("", "", "", False),
        "both": ("", "", "2000", False), "back": ("2002", "2000", "", False),
    }


def test_timeline_keeps_undated_labels(spark):
    out = lh.timeline_wide(photos(spark, SUMMARY))
    assert out.columns == ["id", "year_2000", "year_2001", "year_2002", "year_2003", "year_na"]
    got = by(out, "id", "year_2000", "year_2002", "year_na")
    assert got["both"] == ("FemaleJ & MaleM & UNK", None, None) and got["noyear"] == (None, None, "FemaleJ")


def test_review_tables(spark):
    got = sorted((r["review"], r["id"]) for r in lh.review_tables(lh.id_summary(photos(spark, SUMMARY), 2025)).collect())
    assert got == [("conflict", "both"), ("maturation", "tie"), ("unk_from_known", "mix")]


def test_keyword_conflicts(spark):
    rows = [("1", "2001-01-01", "Melon_F, M3"), ("2", "2001-01-01", "Melon_F"), ("2", "2002-01-01", "Sum_UNK"), ("3", "2001-01-01", "Melon_M, M2"), ("4", "2001-01-01", "Melon_F, Melon_UNK")]
    flagged = kc.flagged_photos(listing(spark, rows))
    assert {r["id"] for r in kc.photo_conflicts(flagged).collect()} == {"1", "4"}
    assert {r["id"] for r in kc.id_conflicts(flagged).collect()} == {"1", "2", "4"}
    years = {(r["id"], r["year"]): r["year_has_conflict"] for r in kc.conflict_timeline(flagged).collect()}
    assert years == {("1", 2001): True, ("2", 2001): False, ("2", 2002): False, ("4", 2001): True}


def test_encounters_per_day(spark):
    t = dt.datetime(2024, 5, 1, 23, 50)
    rows = [("10", t), ("10", t + dt.timedelta(minutes=20)), ("10", t + dt.timedelta(hours=2)), ("10", None), ("10", None), ("x", t)]
    df = spark.createDataFrame(rows, "id string, datetime timestamp_ntz")
    got = {(r["id"], r["date"]): (r["n_encounters"], r["id_flag"]) for r in annual.encounters_per_day(df, 5).collect()}
    assert got == {
        ("10", dt.date(2024, 5, 1)): (1, "new"), ("10", dt.date(2024, 5, 2)): (2, "new"),
        ("10", None): (2, "new"), ("x", dt.date(2024, 5, 1)): (1, None),
    }


def test_label_mismatch_and_reconcile(spark):
    a = catalogues.clean_catalogue(listing(spark, [("1", "2001-01-01", "Left, Sex_F"), ("2", "2001-01-01", "Left, MM"), ("unk", "2001-01-01", "Left, MM"), ("3", "2001-01-01", "left, Biopsy")]))
    p = catalogues.clean_catalogue(listing(spark, [("1", "2001-01-01", "Left, Sex_F"), ("1", "2001-01-01", "Left, Sex_M"), ("2", "2001-01-01", "Left"), ("4", "2001-01-01", "Left")]))
    assert by(catalogues.label_mismatch(a, p), "id", "sex_annual", "sex_primary") == {"1": ("FemaleJ", "MaleM"), "2": ("MaleM", "UNK")}
    parts = catalogues.reconcile(a, p, ("A", "B"))
    assert by(parts["overlap"], "id", "found_in") == {"1": ("both",), "2": ("both",), "3": ("only A",), "4": ("only B",)}
    assert tuple(parts["agreement"].first()) == (0, 0, 0, 2)
    assert by(parts["consolidated"], "id", "has_biopsy", "sources", "n_sightings")["3"] == (True, "A", 1)
    assert by(parts["consolidated"], "id", "sources", "sex")["1"] == ("A, B", "FemaleJ")


def test_evidence_for_year(spark):
    sheet = spark.createDataFrame(
        [("7/27/2019", "biopsy-Male; x", "5"), ("2019-07-28", "Biopsy", "unk"), ("43700", "biopsy", "6"), ("2018-01-01", "biopsy", "7"), ("2019-08-01", None, "8")],
        ["Photo Date", "KEYWORDS", "Whale ID"],
    )
    found = catalogues.evidence_for_year(sheet, 2019)
    assert sorted((str(r["date"]), r["id"], r["biopsy_text"]) for r in found.collect()) == [
        ("2019-07-27", "5", "biopsy-Male"), ("2019-07-28", None, "Biopsy"), ("2019-08-23", "6", "biopsy"),
    ]
    assert by(catalogues.evidence_by_month(found), "month", "count", "unique_ids") == {"Jul": (2, 2), "Aug": (1, 1)}
    have = spark.createDataFrame([("5", 2019, "YES"), ("6", 2018, "YES")], "id string, year int, biopsy string")
    assert [r["id"] for r in catalogues.missing_evidence(found, have, 2019).collect()] == ["6"]


def test_ratings_with_repeated_keys(spark):
    manual = spark.createDataFrame([("A.jpg", 3), ("a.JPG", 0), ("b.jpg", 2)], "file_name string, qrate int")
    auto = spark.createDataFrame([("/x/a.png", 2), ("c.png", 1)], "filename string, dorsal_q_rating int")
    assert rating_runs.compare_ratings(manual, auto).count() == 2
    assert by(rating_runs.unmatched(manual, auto), "source", "n_unmatched") == {"manual": (1,), "automated": (1,)}
    with pytest.raises(gates.GateError, match="qrate"):
        rating_runs.compare_ratings(manual.drop("qrate"), auto)


def test_metadata_ages(spark):
    rows = [("1", "2001-06-01", "Left, samCalf, FemaleJ"), ("1", "2003-06-01", "Left"), ("2", "2001-06-01", "Left, samJuv"), ("3", "2001-06-01", "Left, Right"), ("see crops", "2001-06-01", "Left"), ("4", "", "Left")]
    out = metadata.individual_year_metadata(listing(spark, rows), "left", check=False)
    got = {(r["title"], r["year"]): (r["minimum_age"], r["year_span"], r["age_class"], r["yday"]) for r in out.collect()}
    assert got == {
        ("1", 2001): (0, 3, "Calf", 152), ("1", 2003): (2, 3, "Adult", 152), ("2", 2001): (1, 1, "Juvenile", 152), ("4", None): (None, None, "Adult", None),
    }
    fixes = spark.createDataFrame([("1", 2001, "Juvenile")], "title string, year int, new_value string")
    fixed = metadata.individual_year_metadata(listing(spark, rows), "left", fixes=fixes)
    assert by(fixed.filter("title = '1' and year = 2003"), "title", "minimum_age") == {"1": (3,)}
    with pytest.raises(gates.GateError, match="sex"):
        metadata.individual_year_metadata(listing(spark, rows), "left", check=True)


def test_rename_plans(spark):
    files = spark.createDataFrame([("/d/a.jpg",), ("/d/a-2.jpg",), ("/e/a.jpg",)], "path string")
    assert by(renames.suffix_plan(files, "-2"), "path", "new_name", "skipped") == {
        "/d/a.jpg": ("a-2.jpg", True), "/d/a-2.jpg": ("a-2-2.jpg", False), "/e/a.jpg": ("a-2.jpg", False),
    }
    wanted = spark.createDataFrame([(" x.jpg",), ("y-7.jpg",), ("z.jpg",)], "file_name string")
    have = spark.createDataFrame([("/d/x-3.jpg",), ("/d/x-2.jpg",), ("/d/y-7.jpg",)], "path string")
    assert by(renames.match_plan(wanted, have), "target_name", "current_name", "to_rename") == {
        "x.jpg": ("x-2.jpg", True), "y-7.jpg": ("y-7.jpg", False), "z.jpg": (None, False),
    }


def test_shares_and_pivots(spark):
    df = spark.createDataFrame([("G", "Yes"), ("G", "No"), ("G", "No"), ("H", "No"), (None, "Yes")], "place string, rel string")
    assert by(stats.share_within(df, "place", "rel", ["Yes", "No"]), "place", "yes", "no") == {
        "G": (pytest.approx(1 / 3), pytest.approx(2 / 3)), "H": (None, 1.0), None: (1.0, None),
    }
    assert by(stats.pivot_counts(df, ["place"], "rel", ["Yes"]), "place", "yes") == {"G": (1,), "H": (None,), None: (1,)}
    assert by(stats.share_across(df, "place", ["G", "H"], "rel"), "rel", "g", "h")["No"] == (pytest.approx(2 / 3), 1.0)


# ---- files ----------------------------------------------------------------------------------


def test_listing_csv_blank_and_na(spark, tmp_path):
    (tmp_path / "lv.csv").write_text('File.name,Title,Date.Original,Keyword.export,Rating,Latitude,Longitude\na.jpg,,NA,"Left, Melon_F",* * *,"",1\n')
    row = readers.read_listing(spark, str(tmp_path)).first()
    assert row.asDict() == {
        "file_name": "a.jpg", "title": None, "date_original": None, "keyword_export": "Left, Melon_F", "rating": "* * *", "latitude": None, "longitude": "1",
    }


def test_import_sheets_with_different_headers(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "one.csv").write_text("File name,Latitude,Longitude,Date Original\nA.JPG,1.5,2.5,2025-07-14 10:00:00\n,1,2,2025-07-14 10:00:00\n")
    (tmp_path / "x" / "y" / "two.csv").write_text("File.name,Latitude,Date Original\nB.JPG,1,7/14/2025 1:05:22 PM\nC.JPG,1,2025-07-15,extra,fields\n")
    (tmp_path / "x" / "notes.txt").write_text("no sheet")
    found = sheets.read_sheets(spark, str(tmp_path), imports.REQUIRED)
    assert found.headers.count() == 2
    status = by(sheets.file_status(found, "file_name"), "source_file", "n_rows", "n_bad", "n_unnamed")
    assert {k.rsplit("/x/", 1)[1]: v for k, v in status.items()} == {"one.csv": (2, 0, 1), "y/two.csv": (2, 1, 0)}
    out = imports.to_encounters(found.rows, {"encounter_genus": "Hyperoodon"})
    got = by(out, "encounter_media_asset0", "encounter_decimal_longitude", "encounter_year", "encounter_day", "encounter_genus")
    assert got["A.jpg"] == (2.5, 2025, 14, "Hyperoodon") and got["B.jpg"] == (None, 2025, 14, "Hyperoodon")
    assert set(got) == {"A.jpg", "B.jpg", "C.jpg"}
    assert {r["source_file"].rsplit("/", 1)[1] for r in out.select("source_file").collect()} == {"one.csv", "two.csv"}


def test_folder_scan_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("f,g\n1,2\n3,4,5\n")
    (tmp_path / "b.csv").write_text("f,g\n6,7\n")
    rows = readers.read_folder_csvs(spark, str(tmp_path), ["f", "g"]).cache()
    assert rows.count() == 3 and [r["bad_record"] for r in rows.filter("bad_record is not null").collect()] == ["3,4,5"]


def test_pretty_printed_json(spark, tmp_path):
    (tmp_path / "task.json").write_text('{\n "task": {"encounters": [\n {"id": "e1", "date": "2024-01-02", "submitter": {"displayName": "me"}, "numberMediaAssets": 3}]}}')
    got = imports.encounter_links(readers.read_encounter_json(spark, str(tmp_path), multi_line=True), "https://example.org/?n=").first()
    assert got["encounter_url"] == "https://example.org/?n=e1" and got["submitter_display_name"] == "me"
    assert got["encounter_link"] == '=HYPERLINK("https://example.org/?n=e1","https://example.org/?n=e1")'


def test_file_inventory_ignores_case(spark, tmp_path):
    for name in ("a.JPG", "b.jpeg", "c.txt"):
        (tmp_path / name).write_text("x")
    got = readers.file_inventory(spark, str(tmp_path))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in got.collect()) == ["a.JPG", "b.jpeg"]
    assert "content" not in got._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("2", "x")], "id string, v string")
    path = writers.write_csv(df, str(tmp_path), "table", "2025_01")
    assert path.endswith("table_2025_01")
    assert sorted(map(tuple, readers.read_typed_csv(spark, path, "id string, v string").collect())) == [("1", None), ("2", "x")]
    writers.write_ids(df, "id", str(tmp_path / "ids"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "ids")).collect()) == ["1", "2"]
    writers.write_snapshot(df.withColumn("year", F.lit(2001)), str(tmp_path / "snap"), ["year"], ["id"])
    assert readers_count(spark, tmp_path) == 2


def test_published_names_and_empty_reports(spark, tmp_path):
    final = finalize.finalize(base.clean_base(listing(spark, [("1", "2001-01-01", "Left, Notch"), ("1", "2003-01-01", "Left")])))
    paths = exports.write_exports(final, "v9", str(tmp_path))
    assert all(p.endswith("_v9") for p in paths.values())
    row = spark.read.csv(paths["id_sex_primary_yrs"], header=True).first().asDict()
    assert row == {
        "ID_numeric": "1", "ID.side": "1-LEFT", "Melon_Sex": "UNK", "Sex_genetic": "UNK", "YEAR1": "2001", "YEARLAST": "2003", "ANIMAL_YRS": "3", "N_Photos": "2",
    }
    assert spark.read.csv(paths["id_sex_master"], header=True).first()["ANIMAL_YRS"] == "2"  # older span excludes the first year
    assert spark.read.csv(paths["social_supplement"], header=True).columns == ["ID", "Sex", "Reliable"]
    reports = {"some": final, "none": final.filter("false")}
    assert list(exports.write_reports(reports, "v9", str(tmp_path))) == ["some"]


def readers_count(spark, tmp_path):
    return writers.read_snapshot(spark, str(tmp_path / "snap")).filter("year = 2001").count()


def test_find_columns_first_hit_or_null(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["Date Taken", "date.two", "Title"])
    got = readers.find_columns(df, {"date": "date", "keyword": "keyword", "id": "id|title"}).first()
    assert tuple(got) == ("a", None, "c")


def test_timeline_without_and_with_columns(spark):
    rows = [(i, f"DSC_{i:04d}.JPG", "x", "Sum_F") for i in range(1000, 1400)] + [(1, "IMG_2001_2.JPG", "y", "Sum_M"), (2, "x.JPG", "y", "Sum_F")]
    photos = lh.melon_photos(spark.createDataFrame(rows, "photo_seq long, file_name string, title string, keyword_export string"))
    got = {r["id"]: r for r in lh.timeline(photos).collect()}
    assert len(got["x"].labels) == 400 and got["y"].labels == {2001: "MaleM"} and got["y"].year_na == "FemaleJ"
    with pytest.raises(ValueError, match="more than 300 years"):
        lh.timeline_wide(photos)
    few = lh.timeline_wide(photos.filter("id = 'y'"))
    assert few.columns == ["id", "year_2001", "year_na"] and tuple(few.first()) == ("y", "MaleM", "FemaleJ")
