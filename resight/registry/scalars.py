"""Queries for projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from resight.functions import dates, ids, keywords as kw, ratings, text
from resight.operators.joins import apply_corrections
from resight.plans import annual, base as b, catalogues, finalize, imports, metadata, rating_runs, renames
from resight.registry.core import register
from resight.session import stored
from resight.sources import driver, readers

YEARS = range(1995, 2002)


def listing(*columns):
    return lambda spark, d: driver.listing(spark, d).select("photo_seq", *[c() for c in columns])


def derived(*columns):
    return lambda spark, d: b.derive(driver.listing(spark, d)).select("photo_seq", *columns)


# ---- projections --------------------------------------------------------------------------

PUBLISHED = ["photo seq", "File.name", "Title", "Date Original", "Keyword.export", "Rating", "Latitude", "Longitude"]

register(
    "p1_rename",
    lambda spark, d: driver.listing(spark, d).select("photo_seq", "date_original", "keyword_export").withColumnsRenamed(
        {"date_original": "date1", "keyword_export": "keyword"}
    ),
    "SELECT photo_seq, date_original AS date1, keyword_export AS keyword FROM listing",
)
register(
    "p2_normalise_headers",
    lambda spark, d: readers.normalise_headers(driver.listing(spark, d).toDF(*PUBLISHED)),
    "SELECT photo_seq, file_name, title, date_original, keyword_export, rating, latitude, longitude FROM listing",
)
register(
    "p3_find_columns",
    lambda spark, d: readers.find_columns(
        driver.master_sheet(spark, d), {**catalogues.SHEET_COLUMNS, "rating": "rating"}
    ),
    """SELECT date_text, keyword_export AS keywords, title AS id, CAST(NULL AS VARCHAR) AS rating
    FROM listing JOIN mixed USING (photo_seq)""",
)
register(
    "p4_add_missing_columns",
    lambda spark, d: readers.add_missing(
        driver.listing(spark, d).select("photo_seq", "file_name", "latitude"), imports.REQUIRED
    ),
    """SELECT photo_seq, file_name, latitude, CAST(NULL AS VARCHAR) AS longitude,
    CAST(NULL AS VARCHAR) AS date_original FROM listing""",
)
register(
    "p5_keep_present_columns",
    lambda spark, d: readers.keep_present(driver.listing(spark, d), ["photo_seq", "qrate", "title", "year", "rating"]),
    "SELECT photo_seq, title, rating FROM listing",
)
register(
    "p6_canonical_id",
    listing(lambda: F.col("title"), lambda: ids.canonical_id("title").alias("id"), lambda: ids.id_number("title").alias("id_numeric")),
    """SELECT photo_seq, title,
    CASE WHEN regexp_full_match(title, '[0-9]+') THEN CAST(CAST(title AS BIGINT) AS VARCHAR) END AS id,
    TRY_CAST(title AS BIGINT) AS id_numeric FROM listing""",
)
register(
    "p7_null_placeholder_ids",
    listing(
        lambda: ids.null_placeholder("title").alias("id"),
        lambda: ids.null_placeholder("title", ignore_case=False).alias("id_case_sensitive"),
    ),
    """SELECT photo_seq, nullif(title, 'UNK') AS id, title AS id_case_sensitive FROM listing""",
)
register(
    "p8_remap_ids",
    listing(
        lambda: ids.remap("title", {"31R": "31", "UNK": "5003"}).alias("id"),
        lambda: ids.remap_containing("title", {"31R": "31"}).alias("id_containing"),
    ),
    """SELECT photo_seq, CASE title WHEN '31R' THEN '31' WHEN 'UNK' THEN '5003' ELSE title END AS id,
    CASE WHEN contains(title, '31R') THEN '31' ELSE title END AS id_containing FROM listing""",
)
register("p9_date_and_year", derived("date", "year"), "SELECT photo_seq, date, year FROM derived")
register(
    "p10_any_date",
    lambda spark, d: driver.mixed_dates(spark, d).select(
        "photo_seq", "date_text", dates.any_date("date_text").alias("date"),
        dates.day_month_first("date_text").alias("day_first"),
    ),
    """SELECT photo_seq, date_text,
    CASE WHEN photo_seq % 4 = 2 THEN coalesce(CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE), CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE))
         ELSE true_date END AS date,
    CASE WHEN photo_seq % 4 = 0 THEN NULL ELSE coalesce(CAST(try_strptime(split_part(date_text, ' ', 1), '%d/%m/%Y') AS DATE),
         CAST(try_strptime(split_part(date_text, ' ', 1), '%m/%d/%Y') AS DATE)) END AS day_first FROM mixed""",
)
register(
    "p11_import_datetime",
    lambda spark, d: driver.mixed_dates(spark, d).select(
        "photo_seq",
        F.date_format(
            dates.import_datetime(F.concat(F.lit("‎"), F.col("date_text"))), "yyyy-MM-dd HH:mm:ss"
        ).alias("taken"),
    ),
    """SELECT photo_seq, CASE photo_seq % 4 WHEN 0 THEN strftime(true_date, '%Y-%m-%d') || ' 00:00:00'
    WHEN 3 THEN strftime(true_date, '%Y-%m-%d') || ' 13:05:22' END AS taken FROM mixed""",
)
register(
    "p12_datetime_and_day",
    listing(
        lambda: F.date_format(dates.datetime("date_original"), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        lambda: F.to_date(dates.datetime("date_original")).alias("date"),
    ),
    """SELECT photo_seq, nullif(date_original, '') AS datetime,
    TRY_CAST(substr(date_original, 1, 10) AS DATE) AS date FROM listing""",
)
register(
    "p13_date_parts",
    lambda spark, d: b.derive(driver.listing(spark, d)).select(
        "photo_seq", F.year("date").alias("y"), F.month("date").alias("m"), F.dayofmonth("date").alias("dd"),
        F.dayofyear("date").alias("yday"), F.date_format("date", "MMM").alias("month_name"),
    ),
    """SELECT photo_seq, year(date) AS y, month(date) AS m, day(date) AS dd, dayofyear(date) AS yday,
    strftime(date, '%b') AS month_name FROM derived""",
)
register(
    "p14_year_from_file_name",
    listing(lambda: dates.year_in_text("file_name").alias("year")),
    "SELECT photo_seq, CAST(substr(file_name, 5, 4) AS INTEGER) AS year FROM listing",
)
register(
    "p15_year_tag",
    listing(lambda: dates.year_tag("file_name", YEARS).alias("year"), lambda: dates.year_tag("keyword_export", YEARS).alias("none")),
    """SELECT photo_seq, TRY_CAST(nullif(regexp_extract(file_name, '1995|1996|1997|1998|1999|2000|2001'), '') AS INTEGER) AS year,
    TRY_CAST(nullif(regexp_extract(keyword_export, '1995|1996|1997|1998|1999|2000|2001'), '') AS INTEGER) AS none FROM listing""",
)
register(
    "p16_side",
    listing(
        lambda: kw.side("keyword_export").alias("side"),
        lambda: kw.side_last_wins("keyword_export").alias("side_lower"),
    ),
    """SELECT photo_seq, side, CASE side WHEN 'Left' THEN 'left' WHEN 'Right' THEN 'right' END AS side_lower FROM derived""",
)
register("p17_star_rating", derived("qrate"), "SELECT photo_seq, qrate FROM derived")
register("p18_reliable", derived("reliable"), "SELECT photo_seq, reliable FROM derived")
register(
    "p19_single_marks",
    listing(*[lambda m=m, p=p: kw.mark("keyword_export", p).alias(m) for m, p in kw.SINGLE_MARKS.items()]),
    """SELECT photo_seq, CASE WHEN photo_seq % 7 = 0 THEN 'Yes' ELSE 'No' END AS notch,
    CASE WHEN photo_seq % 5 = 0 THEN 'Yes' ELSE 'No' END AS indent,
    CASE WHEN photo_seq % 9 = 0 THEN 'Yes' ELSE 'No' END AS scar,
    CASE WHEN photo_seq % 10 = 0 THEN 'Yes' ELSE 'No' END AS patch FROM listing""",
)
register("p20_biopsy", derived("biopsy"), "SELECT photo_seq, biopsy FROM derived")
register(
    "p21_medium",
    lambda spark, d: b.derive(driver.listing(spark, d)).select(
        "photo_seq", "film", kw.medium("keyword", "year", 1996).alias("film_1996"),
        kw.medium_by_keyword("keyword", "Gully").alias("film_by_keyword"),
    ),
    """SELECT photo_seq, film, CASE WHEN contains(keyword, 'Digital') OR year >= 1996 THEN 'Digital' ELSE 'Film' END AS film_1996,
    CASE WHEN contains(keyword, 'Digital') OR contains(keyword, 'Gully') THEN 'Digital' ELSE 'Film' END AS film_by_keyword FROM derived""",
)
register("p22_location", derived("longitude", "location"), "SELECT photo_seq, longitude, location FROM derived")
register(
    "p23_location_by_keyword",
    lambda spark, d: b.derive(driver.listing(spark, d)).select(
        "photo_seq", kw.place_by_keyword("keyword", "latitude").alias("location")
    ),
    """SELECT photo_seq, CASE WHEN contains(keyword, 'Gully') THEN 'Gully' WHEN latitude >= 44 THEN 'Shortland'
    WHEN latitude < 44 THEN 'Gully' END AS location FROM derived""",
)
register(
    "p24_species",
    listing(lambda: kw.species("keyword_export").alias("species")),
    """SELECT photo_seq, CASE WHEN regexp_matches(keyword_export, 'SW') THEN 'Sperm whale'
    WHEN regexp_matches(keyword_export, 'NBW') THEN 'Northern bottlenose' ELSE 'UNK' END AS species FROM listing""",
)
register(
    "p25_photo_type",
    listing(lambda: kw.photo_type("keyword_export").alias("photo_type")),
    "SELECT photo_seq, CASE WHEN photo_seq % 13 = 0 THEN 'Dorsal' ELSE 'Melon' END AS photo_type FROM listing",
)
LISTING_SETS = ["listing_2025", "morphology_2025", "summary_source", "melon_source", "listing_2023", "listing_2020"]
TAG_SETS = ["catalogue_tags", "dorsal_tags", "biopsy_tags", "short_codes", "metadata"]
register(
    "p26_label_rules",
    lambda spark, d: driver.listing(spark, d).select(
        "photo_seq", *[kw.label("keyword_export", s).alias(s) for s in LISTING_SETS],
        kw.label_2021("keyword_export", dates.year_in_text("file_name"), kw.biopsy("keyword_export"), 1996).alias("listing_2021"),
    ),
    """SELECT photo_seq,
    CASE WHEN regexp_matches(t, 'Melon_F,|biopsy-Female') THEN 'FemaleJ' WHEN regexp_matches(t, 'Melon_M,|biopsy-Male') THEN 'MaleM' WHEN regexp_matches(t, 'Melon_UNK') THEN 'UNK' END AS listing_2025,
    CASE WHEN regexp_matches(t, 'Melon_F,') THEN 'FemaleJ' WHEN regexp_matches(t, 'Melon_M,') THEN 'MaleM' ELSE 'UNK' END AS morphology_2025,
    CASE WHEN regexp_matches(t, 'Sum_F') THEN 'FemaleJ' WHEN regexp_matches(t, 'Sum_M') THEN 'MaleM' WHEN regexp_matches(t, 'Sum_UNK') THEN 'UNK' END AS summary_source,
    CASE WHEN regexp_matches(t, 'Melon_F') THEN 'FemaleJ' WHEN regexp_matches(t, 'Melon_M') THEN 'MaleM' WHEN regexp_matches(t, 'Melon_UNK') THEN 'UNK' END AS melon_source,
    CASE WHEN regexp_matches(t, 'F,') THEN 'FemaleJ' WHEN regexp_matches(t, 'Male,|M,') THEN 'MaleM' WHEN regexp_matches(t, 'FJ') THEN 'FemaleJ' END AS listing_2023,
    CASE WHEN regexp_matches(t, 'Female,') THEN 'FemaleJ' WHEN regexp_matches(t, 'Male,|MM,') THEN 'MaleM' WHEN regexp_matches(t, 'FJ') THEN 'FemaleJ' END AS listing_2020,
    CASE WHEN regexp_matches(t, 'biopsy') AND regexp_extract(file_name, '[0-9]{4}') = '1996' THEN 'Female' WHEN regexp_matches(t, 'Female,') THEN 'FemaleJ' WHEN regexp_matches(t, 'Male,|MM,') THEN 'MaleM' WHEN regexp_matches(t, 'FJ') THEN 'FemaleJ' END AS listing_2021
    FROM (SELECT photo_seq, file_name, keyword_export AS t FROM listing)""",
)
register(
    "p26_label_rules_tagged",
    lambda spark, d: driver.tagged_listing(spark, d).select(
        "photo_seq", *[kw.label("keyword_export", s).alias(s) for s in TAG_SETS]
    ),
    r"""SELECT photo_seq,
    CASE WHEN regexp_matches(t, '\bFemale-Juvenile\b|\bSex_F\b|\bFJ\b') THEN 'FemaleJ' WHEN regexp_matches(t, '\bSex_M\b|\bMM\b') THEN 'MaleM' ELSE 'UNK' END AS catalogue_tags,
    CASE WHEN regexp_matches(t, '\bFemaleJ\b|\bbiopsy-Female\b') THEN 'FemaleJ' WHEN regexp_matches(t, '\bMale\b') THEN 'MaleM' END AS dorsal_tags,
    CASE WHEN regexp_matches(t, '\bFemaleJ\b') THEN 'FemaleJ' WHEN regexp_matches(t, '\bMale\b') THEN 'MaleM' ELSE 'UNK' END AS biopsy_tags,
    CASE WHEN regexp_matches(t, '\bSex_F\b') THEN 'FJ' WHEN regexp_matches(t, '\bSex_M\b') THEN 'MM' ELSE 'UNK' END AS short_codes,
    CASE WHEN contains(t, 'Male') THEN 'Male' WHEN contains(t, 'FemaleJ') THEN 'Female-Juvenile' END AS metadata
    FROM (SELECT photo_seq, keyword_export AS t FROM tagged)""",
)
register("p27_genetic_label", derived("genetic_sex"), "SELECT photo_seq, genetic_sex FROM derived")
register(
    "p28_keyword_flags",
    listing(*[lambda n=n, w=w: kw.flag("keyword_export", w).alias(n) for n, w in kw.SEX_KEYWORDS.items()]),
    "SELECT photo_seq, " + ", ".join(kw.SEX_KEYWORDS) + " FROM flagged",
)


def _flagged(spark, d):
    from resight.plans.keyword_conflicts import flagged_photos

    return flagged_photos(driver.listing(spark, d))


register(
    "p29_keyword_indicators",
    lambda spark, d: _flagged(spark, d).select("photo_seq", "current_sex", "old_keyword_sex", "summary_sex"),
    "SELECT photo_seq, current_sex, old_keyword_sex, summary_sex FROM flagged",
)
register(
    "p30_id_side",
    lambda spark, d: b.derive(driver.listing(spark, d)).select("photo_seq", ids.id_side("id", "side").alias("id_side")),
    "SELECT photo_seq, id || '-' || upper(side) AS id_side FROM derived",
)
register(
    "p31_short_codes",
    lambda spark, d: b.derive(driver.listing(spark, d)).select("photo_seq", kw.short_code("sex").alias("code")),
    "SELECT photo_seq, CASE sex WHEN 'MaleM' THEN 'M' WHEN 'FemaleJ' THEN 'F' ELSE 'UNK' END AS code FROM derived",
)


def _corrected(spark, d):
    rows = b.clean_base(driver.listing(spark, d))
    fixes = stored(spark, "corrections", d, lambda: finalize.corrections_from_precedence(rows))
    return apply_corrections(rows, fixes, ["id"], "sex").select("photo_seq", "id", "sex")


register(
    "p32_manual_corrections",
    _corrected,
    """SELECT photo_seq, id, CASE WHEN sex IS NOT NULL THEN
      CASE WHEN bool_or(sex = 'MaleM') OVER (PARTITION BY id) THEN 'MaleM'
           WHEN bool_or(sex = 'FemaleJ') OVER (PARTITION BY id) THEN 'FemaleJ' ELSE 'UNK' END END AS sex FROM base""",
)
register(
    "p33_age_class",
    listing(
        lambda: kw.age_class("keyword_export").alias("age_class"),
        lambda: kw.is_young(kw.age_class("keyword_export")).alias("young"),
    ),
    """SELECT photo_seq, a AS age_class, a <> 'Adult' AS young FROM (SELECT photo_seq,
    CASE WHEN contains(keyword_export, 'samCalf') THEN 'Calf' WHEN contains(keyword_export, 'samJuv') THEN 'Juvenile' ELSE 'Adult' END AS a FROM listing)""",
)
register(
    "p34_minimum_age",
    lambda spark, d: metadata.with_ages(metadata.side_photos(driver.tagged_listing(spark, d), "left")).select(
        "photo_seq", "title", "year", "minimum_age"
    ),
    """SELECT photo_seq, title, y AS year, y - fy + CASE WHEN cls = 'Calf' THEN 0 WHEN cls = 'Juvenile' THEN 1 ELSE 3 END AS minimum_age
    FROM (SELECT *, first_value(age) OVER (PARTITION BY title ORDER BY y NULLS LAST, age) AS cls, min(y) OVER (PARTITION BY title) AS fy
      FROM (SELECT photo_seq, title, year(TRY_CAST(substr(date_original, 1, 10) AS DATE)) AS y,
        CASE WHEN contains(keyword_export, 'samCalf') THEN 'Calf' WHEN contains(keyword_export, 'samJuv') THEN 'Juvenile' ELSE 'Adult' END AS age
        FROM tagged WHERE title <> 'UNK' AND contains(keyword_export, 'Left')))""",
)
register(
    "p35_match_keys",
    lambda spark, d: readers.table(spark, d, "pages").select(
        "page_id", text.base_name("url").alias("base"), text.match_key("url").alias("match_key"),
        text.rename_key("url").alias("rename_key"),
    ),
    r"""SELECT page_id, b AS base, lower(trim(regexp_replace(b, '\.[A-Za-z0-9]+$', ''))) AS match_key,
    regexp_replace(regexp_replace(b, '\.[A-Za-z0-9]+$', ''), '-[0-9]+$', '') AS rename_key
    FROM (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS b FROM pages)""",
)
register(
    "p36_file_name_edits",
    listing(
        lambda: text.lower_jpg("file_name").alias("lower_jpg"),
        lambda: text.with_suffix("file_name", "-3").alias("with_suffix"),
    ),
    r"""SELECT photo_seq, replace(file_name, '.JPG', '.jpg') AS lower_jpg, replace(file_name, '.JPG', '-3.JPG') AS with_suffix FROM listing""",
)
register(
    "p37_keyword_delimiter",
    listing(lambda: kw.delimiter_to_semicolon("keyword_export").alias("keywords")),
    "SELECT photo_seq, replace(keyword_export, ',', ';') AS keywords FROM listing",
)
register(
    "p38_annotation_text",
    listing(lambda: kw.biopsy_text("keyword_export").alias("biopsy_text")),
    r"""SELECT photo_seq, nullif(regexp_extract(keyword_export, '\b[Bb]iopsy\b[^,;.]*'), '') AS biopsy_text FROM listing""",
)
register(
    "p39_constant_columns",
    listing(lambda: F.lit("Hyperoodon").alias("encounter_genus"), lambda: F.lit("ampullatus").alias("encounter_specific_epithet")),
    "SELECT photo_seq, 'Hyperoodon' AS encounter_genus, 'ampullatus' AS encounter_specific_epithet FROM listing",
)
LINK = "https://example.org/encounter?number="
register(
    "p40_links",
    listing(
        lambda: text.link(LINK, "title").alias("url"),
        lambda: text.hyperlink_formula(text.link(LINK, "title")).alias("formula"),
    ),
    f"""SELECT photo_seq, '{LINK}' || title AS url,
    '=HYPERLINK("{LINK}' || title || '","{LINK}' || title || '")' AS formula FROM listing""",
)
register(
    "p41_new_old_flag",
    lambda spark, d: b.clean_base(driver.listing(spark, d)).select(
        "photo_seq",
        F.when(ids.id_number("id") >= 1000, "new").otherwise("old").alias("id_flag"),
        text.decorated_id("id", ids.id_number("id") >= 1000).alias("id_label"),
    ),
    """SELECT photo_seq, CASE WHEN CAST(id AS BIGINT) >= 1000 THEN 'new' ELSE 'old' END AS id_flag,
    CASE WHEN CAST(id AS BIGINT) >= 1000 THEN '<span style=''color:firebrick;''>' || id || '</span>' ELSE id END AS id_label FROM base""",
)
register(
    "p42_exif_day",
    lambda spark, d: driver.auto_responses(spark, d).select(
        "photo_seq", dates.exif_day("date_time_original", "create_date").alias("exif_date")
    ),
    "SELECT photo_seq, exif_date FROM auto",
)
AUTO = """filename, filepath_full, exif_date, cetacean_present, species_confidence, body_parts, multiple_whales,
    non_cetacean_present, non_cetacean_note, dorsal_q_rating, "borderline_Q3", exposure_recoverable, trailing_edge_clear,
    melon_present, crop_recommended, output_folder, rationale"""
register(
    "p43_rating_json",
    lambda spark, d: rating_runs.parse_ratings(driver.auto_responses(spark, d)),
    f"SELECT {AUTO} FROM auto",
)


def manual(spark, d):
    """Manual ratings: the match key is tested by mixed-case file names."""
    name = F.when(F.col("photo_seq") % 4 == 0, F.upper("file_name")).otherwise(F.lower("file_name"))
    return b.derive(driver.listing(spark, d)).withColumn("file_name", name).select(
        "file_name", "qrate", "year", "location", "reliable"
    )


def compared(spark, d):
    auto = rating_runs.parse_ratings(driver.auto_responses(spark, d)).select(
        "filename", "dorsal_q_rating", "output_folder", "trailing_edge_clear"
    )
    return rating_runs.compare_ratings(manual(spark, d), auto)


register(
    "p44_comparison_columns",
    lambda spark, d: compared(spark, d).select(
        "match_key", "q_comparable", "q_diff", "q_agree", "q_flag", "q_direction", "any_flag"
    ),
    "SELECT match_key, q_comparable, q_diff, q_agree, q_flag, q_direction, any_flag FROM rated",
)
register(
    "p45_whole_rating",
    listing(lambda: ratings.whole_rating((F.col("photo_seq") % 5).cast("string")).alias("q"), lambda: ratings.whole_rating("title").alias("t")),
    """SELECT photo_seq, nullif(photo_seq % 5, 0) AS q, nullif(TRY_CAST(title AS INTEGER), 0) AS t FROM listing""",
)
register(
    "p46_report_cells",
    lambda spark, d: text.report_cells(
        b.derive(driver.listing(spark, d)).select("photo_seq", "id", "year", "qrate", "sex", "biopsy")
    ),
    """SELECT CAST(photo_seq AS VARCHAR) AS photo_seq, coalesce(id, '—') AS id, coalesce(CAST(year AS VARCHAR), '—') AS year,
    coalesce(CAST(qrate AS VARCHAR), '—') AS qrate, coalesce(sex, '—') AS sex, coalesce(biopsy, '—') AS biopsy FROM derived""",
)

register(
    "p47_export_layout",
    lambda spark, d: b.derive(driver.listing(spark, d)).select("qrate", "date", "location", "side", "reliable", "sex", "id"),
    "SELECT qrate, date, location, side, reliable, sex, id FROM derived",
)

# ---- filters ------------------------------------------------------------------------------


def rows(condition, *columns):
    return lambda spark, d: b.derive(driver.listing(spark, d)).filter(condition()).select("photo_seq", *columns)


register("f1_known_side", rows(lambda: F.col("side") != kw.UNKNOWN, "side"), "SELECT photo_seq, side FROM derived WHERE side <> 'UNK'")
register("f2_known_id", rows(lambda: F.col("id").isNotNull(), "id"), "SELECT photo_seq, id FROM derived WHERE id IS NOT NULL")
register(
    "f3_non_numeric_ids",
    rows(lambda: F.col("id").isNull(), "id_original"),
    "SELECT photo_seq, id_original FROM derived WHERE TRY_CAST(id_original AS BIGINT) IS NULL",
)
register(
    "f4_null_tests",
    rows(lambda: F.col("date").isNull() | F.col("sex").isNotNull(), "date", "sex"),
    "SELECT photo_seq, date, sex FROM derived WHERE date IS NULL OR sex IS NOT NULL",
)
register(
    "f5_membership",
    lambda spark, d: b.derive(driver.listing(spark, d))
    .filter(kw.known("sex") & ~F.col("location").isin("Gully", "??"))
    .select("photo_seq", "sex", "location"),
    """SELECT photo_seq, sex, location FROM derived WHERE sex IN ('FemaleJ', 'MaleM') AND location NOT IN ('Gully', '??')""",
)
register("f6_rating_threshold", rows(lambda: F.col("qrate") > 2, "qrate"), "SELECT photo_seq, qrate FROM derived WHERE qrate > 2")
register(
    "f7_year_side_date",
    rows(
        lambda: ((F.col("year") == 1996) & (F.col("side") == "Left")) | (F.col("date") == F.lit("1997-03-02").cast("date")),
        "year", "side", "date",
    ),
    "SELECT photo_seq, year, side, date FROM derived WHERE (year = 1996 AND side = 'Left') OR date = DATE '1997-03-02'",
)
register(
    "f8_numeric_floor",
    rows(lambda: ids.id_number("id_original") >= 1000, "id"),
    "SELECT photo_seq, id FROM derived WHERE CAST(id AS BIGINT) >= 1000",
)
register(
    "f9_exclude_value",
    rows(lambda: F.col("id") != "15", "id"),
    "SELECT photo_seq, id FROM derived WHERE id <> '15'",
)


def _counts_predicate(spark, d):
    from resight.plans.label_history import history_detailed, melon_photos

    f, m, u = F.col("n_femalej") > 0, F.col("n_malem") > 0, F.col("n_unk") > 0
    return history_detailed(melon_photos(driver.listing(spark, d))).filter((f & m) | (u & m) | (u & f)).select(
        "id", "year", "n_femalej", "n_malem", "n_unk"
    )


register(
    "f10_compound_label_predicate",
    _counts_predicate,
    """SELECT * FROM (SELECT id, year, count(*) FILTER (WHERE sex = 'FemaleJ') AS n_femalej, count(*) FILTER (WHERE sex = 'MaleM') AS n_malem,
    count(*) FILTER (WHERE sex = 'UNK') AS n_unk FROM melon GROUP BY id, year)
    WHERE n_femalej > 0 AND n_malem > 0 OR n_unk > 0 AND n_malem > 0 OR n_unk > 0 AND n_femalej > 0""",
)
register(
    "f11_complete_cases",
    lambda spark, d: b.derive(driver.listing(spark, d)).select("photo_seq", "id", "date", "qrate", "sex").dropna(),
    """SELECT photo_seq, id, date, qrate, sex FROM derived WHERE id IS NOT NULL AND date IS NOT NULL AND qrate IS NOT NULL AND sex IS NOT NULL""",
)
register(
    "f12_map_extent",
    lambda spark, d: annual.in_extent(b.derive(driver.listing(spark, d)), -59.0, -58.2, 43.6, 44.3).select(
        "photo_seq", "latitude", "longitude"
    ),
    """SELECT photo_seq, latitude, longitude FROM derived WHERE longitude BETWEEN -59.0 AND -58.2 AND latitude BETWEEN 43.6 AND 44.3""",
)
register(
    "f13_reject_table",
    lambda spark, d: imports.unparsed_dates(
        driver.mixed_dates(spark, d).withColumnRenamed("date_text", "date_original")
    ),
    "SELECT photo_seq, date_text AS date_original FROM mixed WHERE photo_seq % 4 IN (1, 2)",
)
register(
    "f14_boundary_and_large",
    lambda spark, d: rating_runs.notable(compared(spark, d)).select("kind", "match_key", "lv_q", "pipe_q"),
    """SELECT 'boundary' AS kind, match_key, lv_q, pipe_q FROM rated WHERE (lv_q = 3 AND pipe_q = 2) OR (lv_q = 2 AND pipe_q = 3)
    UNION ALL SELECT 'large', match_key, lv_q, pipe_q FROM rated WHERE abs(lv_q - pipe_q) >= 2""",
)
