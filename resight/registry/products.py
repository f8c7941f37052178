"""Queries for the end-to-end tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from resight.functions import ids, keywords as kw, ratings, text
from resight.operators import joins
from resight.plans import annual, base as b, catalogues, finalize, imports, keyword_conflicts as kc
from resight.plans import label_history as lh, label_qa as qa, metadata, rating_runs, renames, stats
from resight.registry import grouped as gq
from resight.registry.core import register
from resight.registry.grouped import base, derived, final, flagged, melon, pair
from resight.registry.scalars import AUTO, LINK, compared, manual
from resight.sources import driver

NAMES = gq.NAMES

register(
    "d1_non_numeric_ids",
    lambda spark, d: b.non_numeric_ids(derived(spark, d)),
    "SELECT id_original, count(*) AS n_photos FROM derived WHERE id IS NULL GROUP BY id_original",
)
_SAMPLES = """SELECT id_original, string_agg(keyword, ' | ' ORDER BY pos) AS sample_keywords FROM (
    SELECT id_original, keyword, min(photo_seq) AS pos, row_number() OVER (PARTITION BY id_original ORDER BY min(photo_seq)) AS r
    FROM derived WHERE {where} GROUP BY id_original, keyword) WHERE r <= {k} GROUP BY id_original"""
register(
    "d2_photos_without_side",
    lambda spark, d: b.photos_without_side(derived(spark, d)),
    f"""SELECT id, t.id_original, n_photos, first_date, last_date, sample_keywords FROM (
      SELECT id, id_original, count(*) AS n_photos, min(date) AS first_date, max(date) AS last_date FROM derived WHERE side = 'UNK' GROUP BY id, id_original) t
    JOIN ({_SAMPLES.format(where="side = 'UNK'", k=3)}) s ON t.id_original = s.id_original""",
)
_LOST = "side <> 'UNK' AND location = '??'"
register(
    "d3_photos_without_location",
    lambda spark, d: b.photos_without_location(derived(spark, d)),
    f"""SELECT id, t.id_original, n_photos, has_lat, has_long, sample_lat, sample_long, first_date, last_date, sample_keywords FROM (
      SELECT id, id_original, count(*) AS n_photos, count(latitude) AS has_lat, count(longitude) AS has_long,
        first(latitude ORDER BY photo_seq) FILTER (WHERE latitude IS NOT NULL) AS sample_lat,
        first(longitude ORDER BY photo_seq) FILTER (WHERE longitude IS NOT NULL) AS sample_long,
        min(date) AS first_date, max(date) AS last_date FROM derived WHERE {_LOST} GROUP BY id, id_original) t
    JOIN ({_SAMPLES.format(where=_LOST, k=2)}) s ON t.id_original = s.id_original""",
)
register(
    "d4_biopsied_without_genetic_label",
    lambda spark, d: b.biopsied_without_genetic_label(base(spark, d)),
    """SELECT id, sex, melon_sex, count(*) AS n_photos, first(keyword ORDER BY photo_seq) AS sample_keyword FROM base
    WHERE biopsy IS NOT NULL AND id NOT IN (SELECT id FROM base WHERE genetic_sex IS NOT NULL) GROUP BY id, sex, melon_sex""",
)
BASE_COLUMNS = """photo_seq, file_name, id_original, id, date_original, date, keyword, side, qrate, reliable, biopsy, latitude,
    longitude, sex, melon_sex, year, film, location, genetic_sex"""
register("d5_base_clean_listing", lambda spark, d: b.clean_base(driver.listing(spark, d)), f"SELECT {BASE_COLUMNS} FROM base")
register("d6_label_conflicts", gq._conflicts, gq.CONFLICTS)
register(
    "d6_conflict_photos",
    lambda spark, d: qa.conflict_photos(base(spark, d)),
    """SELECT id, date, year, sex, melon_sex, biopsy, keyword, qrate, reliable FROM base
    WHERE id IN (SELECT id FROM base GROUP BY id HAVING count(DISTINCT sex) > 1)""",
)
register("d7_label_timeline", lambda spark, d: qa.label_timeline(base(spark, d)), gq.LABEL_TIMELINE)
register(
    "d7_label_history",
    lambda spark, d: qa.label_history(base(spark, d)).withColumn(
        "years_before_sex_known", F.round("years_before_sex_known", 6)
    ),
    """SELECT *, CASE WHEN first_sighting <> first_sex_determination THEN round(date_diff('day', first_sighting, first_sex_determination) / 365.25, 6) END AS years_before_sex_known
    FROM (SELECT id, CASE WHEN count(*) = count(date) THEN min(date) END AS first_sighting, CASE WHEN count(*) = count(date) THEN max(date) END AS last_sighting,
      count(*) AS total_photos, count(sex) AS photos_with_sex, count(*) - count(sex) AS photos_without_sex,
      CASE WHEN count(sex) = count(date) FILTER (WHERE sex IS NOT NULL) THEN min(date) FILTER (WHERE sex IS NOT NULL) END AS first_sex_determination,
      first(sex ORDER BY date NULLS LAST, photo_seq) FILTER (WHERE sex IS NOT NULL) AS sex_determined FROM base GROUP BY id)""",
)
register(
    "d7_never_labelled",
    lambda spark, d: qa.never_labelled(base(spark, d)).select("id", "first_sighting", "last_sighting", "total_photos"),
    gq.NEVER,
)
register(
    "d8_label_vs_morphology",
    lambda spark, d: qa.label_vs_morphology(base(spark, d)),
    """SELECT CASE WHEN sex = melon_sex THEN 'Match' ELSE 'Mismatch' END AS sex_match, count(*) AS n_records FROM base
    WHERE sex IS NOT NULL AND melon_sex <> 'UNK' GROUP BY 1""",
)
_NOMELON = "sex IN ('FemaleJ', 'MaleM') AND melon_sex = 'UNK'"
register(
    "d9_labelled_without_morphology",
    lambda spark, d: qa.labelled_without_morphology(base(spark, d)),
    f"""SELECT id, sex, count(*) AS n_photos, count(biopsy) > 0 AS has_biopsy, min(date) AS first_date, max(date) AS last_date FROM base
    WHERE {_NOMELON} GROUP BY id, sex""",
)
register(
    "d9_biopsy_check",
    lambda spark, d: qa.biopsy_check(base(spark, d)),
    f"""SELECT id, count(biopsy) > 0 AS has_biopsy, count(biopsy) AS n_biopsy_photos, count(*) AS n_total_photos,
    first(sex ORDER BY photo_seq) FILTER (WHERE sex IS NOT NULL) AS sex, bool_or(melon_sex <> 'UNK') AS has_melon_sex FROM base
    WHERE id IN (SELECT id FROM base WHERE {_NOMELON}) GROUP BY id""",
)
register(
    "d9_evidence_overlap",
    lambda spark, d: qa.evidence_overlap(base(spark, d)),
    f"""SELECT id, CASE WHEN bi AND nm THEN 'biopsied_and_no_melon' WHEN nm THEN 'no_melon_not_biopsied' ELSE 'biopsied_with_melon' END AS overlap
    FROM (SELECT id, count(biopsy) > 0 AS bi, count(*) FILTER (WHERE {_NOMELON}) > 0 AS nm FROM base GROUP BY id) WHERE bi OR nm""",
)


def _problems(spark, d):
    # The derived biopsies all carry a label word, so the check is run on a copy without half of them.
    rows = base(spark, d).withColumn("biopsy", F.when(F.col("photo_seq") % 2 == 0, F.col("biopsy")))
    return qa.problem_ids(rows)


register(
    "d9_problem_ids",
    _problems,
    f"""SELECT id, first(sex ORDER BY photo_seq) FILTER (WHERE sex IN ('FemaleJ', 'MaleM')) AS sex, count(*) AS n_photos,
    first(keyword ORDER BY photo_seq) AS keywords_sample FROM base
    WHERE id IN (SELECT id FROM base WHERE {_NOMELON}) AND id NOT IN (SELECT id FROM base WHERE biopsy IS NOT NULL AND photo_seq % 2 = 0) GROUP BY id""",
)
register("d10_biopsy_first_year", lambda spark, d: qa.biopsy_first_year(base(spark, d)), gq.BIOPSY_FIRST)


def _genetic_conflicts(spark, d):
    # Every seventh morphology label is turned round, so that there are conflicts to find.
    turned = F.when(F.col("melon_sex") == kw.FEMALE, kw.MALE).when(F.col("melon_sex") == kw.MALE, kw.FEMALE)
    melon_sex = F.when(F.col("photo_seq") % 7 == 0, F.coalesce(turned, "melon_sex")).otherwise(F.col("melon_sex"))
    return qa.genetic_vs_morphology(base(spark, d).withColumn("melon_sex", melon_sex))


register(
    "d11_genetic_vs_morphology",
    _genetic_conflicts,
    """SELECT id, date, sex, melon_sex, biopsy, keyword FROM (SELECT * REPLACE (CASE WHEN photo_seq % 7 <> 0 THEN melon_sex
      WHEN melon_sex = 'FemaleJ' THEN 'MaleM' WHEN melon_sex = 'MaleM' THEN 'FemaleJ' ELSE melon_sex END AS melon_sex) FROM base)
    WHERE biopsy IS NOT NULL AND melon_sex <> 'UNK' AND sex <> melon_sex""",
)
register(
    "d12_final_listing",
    lambda spark, d: gq.finalized(spark, d).select(
        "photo_seq", "id", "id_side", "date", "side", "biopsy", "sex", "sex_genetic", "animal_yrs", "qrate", "location"
    ),
    "SELECT photo_seq, id, id_side, date, side, biopsy, sex, sex_genetic, animal_yrs, qrate, location FROM final",
)
PRIMARY = """SELECT CAST(id AS BIGINT) AS id_numeric, id_side, first(melon_sex ORDER BY date NULLS LAST, photo_seq) AS melon_sex,
    first(sex_genetic ORDER BY date NULLS LAST, photo_seq) AS sex_genetic,
    CASE WHEN count(*) = count(date) THEN year(min(date)) END AS year1, CASE WHEN count(*) = count(date) THEN year(max(date)) END AS yearlast,
    CASE WHEN count(*) = count(date) THEN year(max(date)) - year(min(date)) + 1 END AS animal_yrs, count(*) AS n_photos FROM final GROUP BY id, id_side"""
register("d13_primary_ids", lambda spark, d: finalize.primary_ids(final(spark, d)), PRIMARY)
register(
    "d14_catalogue_years",
    lambda spark, d: finalize.catalogue_years(base(spark, d)),
    "SELECT DISTINCT year FROM base WHERE qrate > 2",
)
register(
    "d15_social_photos",
    lambda spark, d: finalize.social_photos(final(spark, d)),
    "SELECT qrate, date, date_original, location, latitude, longitude, side, reliable, sex, id FROM final",
)
register(
    "d15_simple_photos",
    lambda spark, d: finalize.simple_photos(final(spark, d)),
    "SELECT id_side, qrate, date, location, reliable, sex, id FROM final",
)
SUPPLEMENT = """SELECT id, CASE sex WHEN 'MaleM' THEN 'M' WHEN 'FemaleJ' THEN 'F' ELSE 'UNK' END AS sex,
    count(*) FILTER (WHERE reliable = 'Yes' AND year IS NOT NULL) > 0 AS reliable FROM final GROUP BY id, sex"""
register(
    "d16_social_supplement",
    lambda spark, d: finalize.social_supplement(final(spark, d)),
    SUPPLEMENT,
)
register(
    "d16_supplement_by_side",
    lambda spark, d: finalize.supplement_by_side(final(spark, d)),
    """SELECT id, side, sex, CASE WHEN reliable = 'Yes' THEN year END AS year_reliable, count(*) AS n FROM final GROUP BY 1, 2, 3, 4""",
)
register(
    "d16_supplement_counts",
    lambda spark, d: finalize.supplement_counts(final(spark, d)),
    "SELECT id, side, sex, count(*) AS n FROM final GROUP BY 1, 2, 3",
)
MASTER = """SELECT CAST(id AS BIGINT) AS id, id_side, sex, sex_genetic, y1 AS year1, y2 AS yearlast, y2 - y1 AS animal_yrs, count(*) AS n FROM (
      SELECT DISTINCT id, id_side, sex, sex_genetic, qrate, reliable, keyword,
        CASE WHEN count(*) OVER w = count(date) OVER w THEN year(min(date) OVER w) END AS y1,
        CASE WHEN count(*) OVER w = count(date) OVER w THEN year(max(date) OVER w) END AS y2
      FROM final WINDOW w AS (PARTITION BY id, side)) GROUP BY 1, 2, 3, 4, 5, 6, 7"""
register("d17_master_ids", lambda spark, d: finalize.master_ids(final(spark, d)), MASTER)
register(
    "d18_biopsied_ids",
    lambda spark, d: finalize.biopsied_ids(final(spark, d)),
    "SELECT id, biopsy, sex_genetic, count(*) AS n FROM final WHERE biopsy = 'YES' GROUP BY 1, 2, 3",
)
register(
    "d18_unlabelled_ids",
    lambda spark, d: finalize.unlabelled_ids(final(spark, d)),
    "SELECT id, sex, biopsy, count(*) AS n FROM final WHERE sex = 'UNK' GROUP BY 1, 2, 3",
)
register(
    "d18_ids_by_label_year",
    lambda spark, d: finalize.ids_by_label_year(final(spark, d)),
    "SELECT id, sex, year, count(*) AS n FROM final GROUP BY 1, 2, 3",
)
register(
    "d19_photos_per_id_side",
    lambda spark, d: annual.photos_per_id_side(base(spark, d)),
    "SELECT id, side, count(*) AS id_n FROM base GROUP BY 1, 2",
)
register(
    "d19_ids_per_side",
    lambda spark, d: annual.ids_per_side(base(spark, d)),
    "SELECT side, count(DISTINCT id) AS id_n FROM base GROUP BY side",
)
register(
    "d19_new_and_old",
    lambda spark, d: annual.new_and_old(base(spark, d), 500),
    """SELECT count(DISTINCT id) AS n_ids, count(DISTINCT id) FILTER (WHERE CAST(id AS BIGINT) >= 500) AS n_new,
    count(DISTINCT id) FILTER (WHERE CAST(id AS BIGINT) < 500) AS n_old FROM base""",
)
register(
    "d19_ids_per_day",
    lambda spark, d: annual.ids_per_day(base(spark, d)),
    "SELECT date, count(DISTINCT id) AS n FROM base WHERE qrate > 2 GROUP BY date",
)
register(
    "d19_days_per_id",
    lambda spark, d: annual.days_per_id(base(spark, d)),
    "SELECT id, count(*) AS n_days FROM (SELECT DISTINCT id, date FROM base) GROUP BY id",
)
register(
    "d19_reliability_in_year",
    lambda spark, d: annual.reliability_in_year(base(spark, d), 1996),
    "SELECT reliable, id, count(*) AS count FROM base WHERE year = 1996 GROUP BY 1, 2",
)
register(
    "d19_location_in_year",
    lambda spark, d: annual.location_in_year(base(spark, d), 1997),
    "SELECT location, count(*) AS count FROM base WHERE year = 1997 GROUP BY 1",
)
register(
    "d20_encounters_per_day",
    lambda spark, d: annual.encounters_per_day(driver.sightings(spark, d), 50),
    """SELECT id, date, n_encounters, CAST(id AS BIGINT) AS id_numeric, CASE WHEN CAST(id AS BIGINT) >= 50 THEN 'new' ELSE 'old' END AS id_flag,
    CASE WHEN CAST(id AS BIGINT) >= 50 THEN '<span style=''color:firebrick;''>' || id || '</span>' ELSE id END AS id_label FROM per_day""",
)
SUMMARY = """id, n_photos_total, n_melon_photos, n_dorsal_photos, n_other_photos, n_photos_with_sex, n_femalej, n_malem, n_unk,
    primary_sex, first_year, last_year, melon_age, yrs_since_melon_age, first_femalej_year, first_malem_year, most_recent_sex_year,
    current_sex, possible_maturation, keywords_present, inter_keyword_conflict, all_keywords_identical, melon_sex_values, sum_sex_values"""
register(
    "d21_label_summary",
    lambda spark, d: lh.id_summary(melon(spark, d), 2025),
    f"SELECT {SUMMARY} FROM summary",
)
register("d22_source_comparison", lambda spark, d: lh.source_comparison(melon(spark, d)), gq.COMPARED)
register(
    "d22_source_subsets",
    lambda spark, d: lh.source_comparison(melon(spark, d)).filter("inter_keyword_conflict or all_keywords_identical").select(
        "id", "inter_keyword_conflict", "all_keywords_identical", "melon_sex_values", "sum_sex_values"
    ),
    """SELECT id, inter_keyword_conflict, all_keywords_identical, melon_sex_values, sum_sex_values FROM compared
    WHERE inter_keyword_conflict OR all_keywords_identical""",
)
register("d23_timeline_wide", lambda spark, d: lh.timeline_wide(melon(spark, d)), gq.TIMELINE)
register(
    "d23_timeline",
    lambda spark, d: lh.timeline(melon(spark, d)).select("id", F.explode_outer("labels").alias("year", "label"), "year_na"),
    """SELECT i.id, y.year, y.label, n.year_na FROM (SELECT DISTINCT id FROM melon WHERE sex IS NOT NULL) i
    LEFT JOIN (SELECT id, year, string_agg(DISTINCT sex, ' & ' ORDER BY sex) AS label FROM melon WHERE sex IS NOT NULL AND year IS NOT NULL GROUP BY id, year) y
      ON y.id IS NOT DISTINCT FROM i.id
    LEFT JOIN (SELECT id, string_agg(DISTINCT sex, ' & ' ORDER BY sex) AS year_na FROM melon WHERE sex IS NOT NULL AND year IS NULL GROUP BY id) n
      ON n.id IS NOT DISTINCT FROM i.id""",
)
register("d23_history_detailed", lambda spark, d: lh.history_detailed(melon(spark, d)), gq.HISTORY)
register("d24_conflict_patterns", lambda spark, d: lh.conflict_patterns(melon(spark, d)), gq.PATTERNS)
register(
    "d24_conflict_details",
    lambda spark, d: lh.conflict_details(melon(spark, d)),
    """SELECT id, year, photo_type, sex, keyword FROM melon WHERE sex IS NOT NULL
    AND id IN (SELECT id FROM melon GROUP BY id HAVING count(DISTINCT sex) > 1)""",
)
_REVIEW = "id, primary_sex, current_sex, first_year, last_year, first_femalej_year, first_malem_year, n_femalej, n_malem"
register(
    "d25_review_tables",
    lambda spark, d: lh.review_tables(lh.id_summary(melon(spark, d), 2025)),
    f"""SELECT 'conflict' AS review, {_REVIEW} FROM summary WHERE current_sex = 'CONFLICT'
    UNION ALL SELECT 'unk_from_known', {_REVIEW} FROM summary WHERE current_sex = 'UNK_from_known'
    UNION ALL SELECT 'maturation', {_REVIEW} FROM summary WHERE possible_maturation""",
)
register(
    "d26_photo_keyword_conflicts",
    lambda spark, d: kc.photo_conflicts(flagged(spark, d)),
    """SELECT file_name, id, year, current_sex, old_keyword_sex, summary_sex, keyword FROM flagged
    WHERE CAST(has_melon_f AS INT) + CAST(has_melon_m AS INT) + CAST(has_melon_unk AS INT) > 1
    OR (has_melon_f AND (has_m2 OR has_m3 OR has_malem)) OR (has_melon_m AND (has_f2 OR has_f3 OR has_femalej))""",
)
register("d27_id_keyword_conflicts", lambda spark, d: kc.id_conflicts(flagged(spark, d)), gq.ID_KEYWORD_CONFLICTS)
register("d27_keyword_timeline", lambda spark, d: kc.conflict_timeline(flagged(spark, d)), gq.KEYWORD_TIMELINE)
register(
    "d28_label_mismatch",
    lambda spark, d: catalogues.label_mismatch(*pair(spark, d)),
    """SELECT a.id, sex_annual, sex_primary FROM
    (SELECT id, coalesce(first(sex ORDER BY photo_seq) FILTER (WHERE sex <> 'UNK'), 'UNK') AS sex_annual FROM catalogue WHERE photo_seq % 3 <> 0 AND id IS NOT NULL GROUP BY id) a
    JOIN (SELECT id, CASE WHEN bool_or(sex = 'MaleM') THEN 'MaleM' WHEN bool_or(sex = 'FemaleJ') THEN 'FemaleJ' ELSE 'UNK' END AS sex_primary
      FROM catalogue WHERE photo_seq % 3 <> 1 AND id IS NOT NULL GROUP BY id) p ON a.id = p.id WHERE sex_annual <> sex_primary""",
)
register(
    "d29_label_counts",
    lambda spark, d: catalogues.label_counts(catalogues.format_keywords(driver.tagged_listing(spark, d))),
    gq.SEVERAL,
)
register(
    "d29_several_labels",
    lambda spark, d: catalogues.several_labels(catalogues.format_keywords(driver.tagged_listing(spark, d))),
    f"SELECT id, sex, n FROM (SELECT *, count(*) OVER (PARTITION BY id) AS c FROM ({gq.SEVERAL})) WHERE c > 1",
)
_DORSAL = """SELECT *, coalesce(last_value(raw IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING),
      first_value(raw IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 'UNK') AS label,
      max(biopsy) OVER (PARTITION BY id) AS any_biopsy
    FROM (SELECT *, CASE WHEN regexp_matches(keyword, '\\bFemaleJ\\b|\\bbiopsy-Female\\b') THEN 'FemaleJ' WHEN regexp_matches(keyword, '\\bMale\\b') THEN 'MaleM' END AS raw
      FROM catalogue WHERE id IS NOT NULL) WINDOW w AS (PARTITION BY id ORDER BY photo_seq)"""
register(
    "d30_primary_labels",
    lambda spark, d: catalogues.primary_labels(
        catalogues.clean_dorsal(driver.tagged_listing(spark, d)), {"31R": "5003", "62R": "620"}
    ),
    f"SELECT DISTINCT CASE id WHEN '31R' THEN '5003' WHEN '62R' THEN '620' ELSE id END AS id, label AS sex_primary FROM ({_DORSAL})",
)
register(
    "d30_dorsal_listing",
    lambda spark, d: catalogues.clean_dorsal(driver.tagged_listing(spark, d)).select(
        "photo_seq", "id", "side", "biopsy", "sex", "sex_genetic", "id_side", "film", "location"
    ),
    f"""SELECT c.photo_seq, c.id, c.side, any_biopsy AS biopsy, label AS sex,
    CASE WHEN label = 'FemaleJ' AND any_biopsy = 'YES' THEN 'Female' WHEN label = 'MaleM' AND any_biopsy = 'YES' THEN 'Male' ELSE 'UNK' END AS sex_genetic,
    c.id || '-' || upper(c.side) AS id_side, film, location FROM ({_DORSAL}) c JOIN derived d ON c.photo_seq = d.photo_seq""",
)


def _biopsy_pair(spark, d):
    return pair(spark, d, "biopsy_tags")


_EVIDENCE = """id, count(biopsy) > 0 AS has_biopsy, min(date) AS earliest_date, max(date) AS latest_date,
    first(biopsy_sex ORDER BY {order}) FILTER (WHERE biopsy_sex <> 'UNK') AS sex, count(*) AS n_sightings"""
_BOTH = """(SELECT *, 1 AS n, 'catalogue' AS source FROM catalogue WHERE photo_seq % 3 <> 0
    UNION ALL SELECT *, 2, 'dorsal' FROM catalogue WHERE photo_seq % 3 <> 1)"""
register(
    "d31_dataset_summary",
    lambda spark, d: catalogues.dataset_summary(catalogues.clean_catalogue(driver.tagged_listing(spark, d), "biopsy_tags")),
    f"SELECT {_EVIDENCE.format(order='photo_seq')} FROM catalogue WHERE id IS NOT NULL GROUP BY id",
)
register(
    "d31_id_overlap",
    lambda spark, d: catalogues.id_overlap(*_biopsy_pair(spark, d), NAMES),
    f"""SELECT id, CASE WHEN min(n) < max(n) THEN 'both' ELSE 'only ' || min(source) END AS found_in FROM {_BOTH} WHERE id IS NOT NULL GROUP BY id""",
)
register(
    "d31_biopsy_agreement",
    lambda spark, d: catalogues.biopsy_agreement(*_biopsy_pair(spark, d)),
    f"""SELECT count(*) FILTER (WHERE b1 AND b2) AS in_both, count(*) FILTER (WHERE b1 AND NOT b2) AS only_first,
    count(*) FILTER (WHERE NOT b1 AND b2) AS only_second, count(*) FILTER (WHERE NOT b1 AND NOT b2) AS in_none FROM (
      SELECT id, count(biopsy) FILTER (WHERE n = 1) > 0 AS b1, count(biopsy) FILTER (WHERE n = 2) > 0 AS b2 FROM {_BOTH}
      WHERE id IS NOT NULL GROUP BY id HAVING count(DISTINCT n) = 2)""",
)
register(
    "d31_consolidated",
    lambda spark, d: catalogues.consolidated(*_biopsy_pair(spark, d), NAMES),
    f"""SELECT {_EVIDENCE.format(order='n, photo_seq')}, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM {_BOTH} WHERE id IS NOT NULL GROUP BY id""",
)
register("d31_biopsies_by_year", lambda spark, d: catalogues.biopsies_by_year(*_biopsy_pair(spark, d), NAMES), gq.BY_YEAR)


def _found(spark, d):
    return catalogues.evidence_for_year(driver.master_sheet(spark, d), 1995)


_FOUND = """SELECT nullif(title, 'UNK') AS id, dt AS date, year(dt) AS year, keyword_export AS keywords, true AS has_biopsy,
    nullif(regexp_extract(keyword_export, '\\b[Bb]iopsy\\b[^,;.]*'), '') AS biopsy_text
    FROM (SELECT l.*, CASE WHEN l.photo_seq % 4 = 2 THEN coalesce(CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE), CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE))
      ELSE true_date END AS dt FROM listing l JOIN mixed m ON l.photo_seq = m.photo_seq)
    WHERE year(dt) = 1995 AND contains(keyword_export, 'biopsy')"""
register("d32_evidence_for_year", _found, _FOUND)
register(
    "d32_evidence_by_month",
    lambda spark, d: catalogues.evidence_by_month(_found(spark, d)),
    f"""SELECT month(date) AS month_no, strftime(date, '%b') AS month, count(*) AS count,
    count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS unique_ids FROM ({_FOUND}) GROUP BY 1, 2""",
)
register(
    "d32_missing_evidence",
    lambda spark, d: catalogues.missing_evidence(_found(spark, d), pair(spark, d)[0], 1995),
    f"""SELECT DISTINCT id FROM ({_FOUND}) WHERE id IS NOT NULL AND id NOT IN (
      SELECT id FROM catalogue WHERE photo_seq % 3 <> 0 AND id IS NOT NULL AND biopsy = 'YES' AND year = 1995)""",
)
CONSTANTS = {
    "encounter_genus": "Hyperoodon",
    "encounter_specific_epithet": "ampullatus",
    "encounter_location_id": "Gully",
    "encounter_submitter_id": "team",
}
ENCOUNTERS = """SELECT replace(file_name, '.JPG', '.jpg') AS encounter_media_asset0, 'Hyperoodon' AS encounter_genus,
    'ampullatus' AS encounter_specific_epithet, 'Gully' AS encounter_location_id, 'team' AS encounter_submitter_id,
    latitude AS encounter_decimal_latitude, longitude AS encounter_decimal_longitude, year AS encounter_year,
    month(date) AS encounter_month, day(date) AS encounter_day FROM derived"""
register(
    "d33_import_encounters",
    lambda spark, d: imports.to_encounters(driver.listing(spark, d), CONSTANTS),
    ENCOUNTERS,
)


def _encounters(spark, d):
    """Task documents as parsed rows, without a round trip through files."""
    from resight.sources.readers import ENCOUNTER_SCHEMA

    docs = driver.encounter_documents(spark, d).select(F.from_json("value", ENCOUNTER_SCHEMA).alias("doc"))
    return docs.select(F.explode("doc.task.encounters").alias("e")).select(
        "e.date", "e.id", "e.occurrenceId", "e.numberMediaAssets",
        F.col("e.submitter.displayName").alias("submitter_display_name"),
    )


LINKS = f"""SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(event_id AS VARCHAR) AS id, 'occ-' || user_id AS occurrence_id,
    event_id % 7 AS number_media_assets, '{LINK}' || event_id AS encounter_url,
    '=HYPERLINK("{LINK}' || event_id || '","{LINK}' || event_id || '")' AS encounter_link, 'team ' || event_type AS submitter_display_name FROM events"""
register("d34_encounter_links", lambda spark, d: imports.encounter_links(_encounters(spark, d), LINK), LINKS)
register(
    "d35_renamed_export",
    lambda spark, d: imports.renamed_export(
        driver.listing(spark, d), {"file_name": "encounter_media_asset0", "title": "name0_value"}
    ),
    """SELECT photo_seq, file_name AS encounter_media_asset0, title AS name0_value, date_original, keyword_export, rating, latitude, longitude FROM listing""",
)
register(
    "d36_rating_results",
    lambda spark, d: rating_runs.parse_ratings(driver.auto_responses(spark, d)),
    f"SELECT {AUTO} FROM auto",
)
register(
    "d36_run_summary",
    lambda spark, d: rating_runs.run_summary(rating_runs.parse_ratings(driver.auto_responses(spark, d))),
    gq.RUN_SUMMARY,
)


def _folder_copies(rows, also):
    """Rows of two folders that hold photos of the same names."""
    return rows.unionByName(rows.filter(also))


RATED = """match_key, lv_filename_raw, lv_q, year, location, reliable, pipe_filename_raw, pipe_q, output_folder, trailing_edge_clear,
    q_comparable, q_diff, q_agree, q_flag, q_direction, any_flag"""
register("d37_rating_comparison", compared, f"SELECT {RATED} FROM rated")
register(
    "d37_disagreements",
    lambda spark, d: rating_runs.disagreements(compared(spark, d)),
    f"SELECT {RATED} FROM rated WHERE any_flag",
)
register(
    "d37_boundary",
    lambda spark, d: rating_runs.boundary(compared(spark, d)),
    f"SELECT {RATED} FROM rated WHERE (lv_q = 3 AND pipe_q = 2) OR (lv_q = 2 AND pipe_q = 3)",
)
register("d37_agreement", lambda spark, d: rating_runs.agreement(compared(spark, d)), gq.AGREEMENT)
register(
    "d37_magnitudes",
    lambda spark, d: rating_runs.magnitudes(compared(spark, d)),
    "SELECT q_diff, count(*) AS n FROM rated WHERE q_flag GROUP BY q_diff",
)
register(
    "d37_repeated_keys",
    lambda spark, d: rating_runs.repeated_keys(
        _folder_copies(manual(spark, d), F.col("qrate") >= 3),
        _folder_copies(rating_runs.parse_ratings(driver.auto_responses(spark, d)), F.col("melon_present")),
    ),
    """SELECT match_key, n_manual, n_auto FROM (SELECT a.match_key, any_value(CASE WHEN m.qrate >= 3 THEN 2 ELSE 1 END) AS n_manual,
    any_value(CASE WHEN melon_present THEN 2 ELSE 1 END) AS n_auto
    FROM (SELECT *, lower(regexp_replace(filename, '\\.JPG$', '')) AS match_key FROM auto) a JOIN derived m ON a.photo_seq = m.photo_seq GROUP BY a.match_key)
    WHERE n_manual > 1 OR n_auto > 1""",
)
register(
    "d37_unmatched",
    lambda spark, d: rating_runs.unmatched(
        manual(spark, d), rating_runs.parse_ratings(driver.auto_responses(spark, d).filter("photo_seq % 2 = 0"))
    ),
    """SELECT 'manual' AS source, (SELECT count(*) FROM listing WHERE photo_seq % 2 <> 0) AS n_unmatched UNION ALL SELECT 'automated', 0""",
)
_SIDE = """SELECT photo_seq, title, y AS year, min(y) OVER w AS min_year, max(y) OVER w AS max_year,
      y - min(y) OVER w + CASE first_value(age) OVER (PARTITION BY title ORDER BY y NULLS LAST, age) WHEN 'Calf' THEN 0 WHEN 'Juvenile' THEN 1 ELSE 3 END AS minimum_age
    FROM (SELECT photo_seq, title, year(TRY_CAST(substr(date_original, 1, 10) AS DATE)) AS y,
      CASE WHEN contains(keyword_export, 'samCalf') THEN 'Calf' WHEN contains(keyword_export, 'samJuv') THEN 'Juvenile' ELSE 'Adult' END AS age
      FROM tagged WHERE title <> 'UNK' AND contains(keyword_export, 'Left')) WINDOW w AS (PARTITION BY title)"""
register(
    "d38_individual_years",
    lambda spark, d: metadata.individual_years(driver.tagged_listing(spark, d), "left"),
    f"""SELECT title, year, min(min_year) AS min_year, max(max_year) AS max_year, max(max_year) - min(min_year) + 1 AS year_span,
    max(minimum_age) AS minimum_age, count(*) AS n FROM ({_SIDE}) GROUP BY title, year""",
)
register(
    "d38_individual_year_metadata",
    lambda spark, d: metadata.individual_year_metadata(driver.tagged_listing(spark, d), "left", seed=11),
    """SELECT title, side, year, sex, min_year, max_year, max_year - min_year + 1 AS year_span, minimum_age, age_class, yday FROM (
      SELECT title, 'left' AS side, y AS year, sex, min(y) OVER w AS min_year, max(y) OVER w AS max_year,
        y - min(y) OVER w + CASE first_value(age) OVER (PARTITION BY title ORDER BY y NULLS LAST, age) WHEN 'Calf' THEN 0 WHEN 'Juvenile' THEN 1 ELSE 3 END AS minimum_age,
        age AS age_class, yday, row_number() OVER (PARTITION BY title, y ORDER BY md5('11:' || photo_seq), photo_seq) AS r
      FROM (SELECT photo_seq, title, keyword_export, year(day) AS y, dayofyear(day) AS yday,
          CASE WHEN contains(keyword_export, 'Male') THEN 'Male' WHEN contains(keyword_export, 'FemaleJ') THEN 'Female-Juvenile' END AS sex,
          CASE WHEN contains(keyword_export, 'samCalf') THEN 'Calf' WHEN contains(keyword_export, 'samJuv') THEN 'Juvenile' ELSE 'Adult' END AS age
        FROM (SELECT *, TRY_CAST(substr(date_original, 1, 10) AS DATE) AS day FROM tagged)
        WHERE title <> 'UNK' AND contains(keyword_export, 'Left') AND NOT contains(keyword_export, 'Right'))
      WINDOW w AS (PARTITION BY title)) WHERE r = 1""",
)


def _suffix_plan(spark, d):
    listed = driver.listing(spark, d)
    files = listed.select(F.concat(F.lit("/photos/"), "file_name").alias("path"))
    taken = listed.filter(F.col("photo_seq") % 5 == 0).select(
        F.concat(F.lit("/photos/"), text.with_suffix("file_name", "-2")).alias("path")
    )
    return renames.suffix_plan(files.unionByName(taken), "-2")


register(
    "d39_suffix_plan",
    _suffix_plan,
    """SELECT '/photos/' || file_name AS path, file_name AS old_name, replace(file_name, '.JPG', '-2.JPG') AS new_name, photo_seq % 5 = 0 AS skipped FROM listing
    UNION ALL SELECT '/photos/' || replace(file_name, '.JPG', '-2.JPG'), replace(file_name, '.JPG', '-2.JPG'), replace(file_name, '.JPG', '-2-2.JPG'), false
    FROM listing WHERE photo_seq % 5 = 0""",
)


def _match_plan(spark, d):
    listed = driver.listing(spark, d)
    name = F.when(F.col("photo_seq") % 4 == 1, text.with_suffix("file_name", "-3")).otherwise(F.col("file_name"))
    files = listed.filter(F.col("photo_seq") % 3 != 0).select(F.concat(F.lit("/photos/"), name).alias("path"))
    return renames.match_plan(listed.select("file_name"), files)


register(
    "d39_match_plan",
    _match_plan,
    """SELECT file_name AS target_name, CASE WHEN photo_seq % 3 <> 0 THEN CASE WHEN photo_seq % 4 = 1 THEN replace(file_name, '.JPG', '-3.JPG') ELSE file_name END END AS current_name,
    photo_seq % 3 <> 0 AS found_in_dir, photo_seq % 3 <> 0 AND photo_seq % 4 = 1 AS to_rename FROM listing""",
)
register(
    "d40_id_days_by_year",
    lambda spark, d: stats.id_days_by_year(base(spark, d)),
    """SELECT year, film, nullif(count(*) FILTER (WHERE side = 'Left'), 0) AS left, nullif(count(*) FILTER (WHERE side = 'Right'), 0) AS right
    FROM (SELECT DISTINCT date, year, location, id, side, film FROM base) GROUP BY year, film""",
)
register(
    "d40_reliability_shares",
    lambda spark, d: stats.share_within(base(spark, d), "year", "reliable", ["Yes", "No"]).select(
        "year", F.round("yes", 6).alias("yes"), F.round("no", 6).alias("no")
    ),
    """SELECT year, round(nullif(count(*) FILTER (WHERE reliable = 'Yes'), 0) / count(*), 6) AS yes,
    round(nullif(count(*) FILTER (WHERE reliable = 'No'), 0) / count(*), 6) AS no FROM base GROUP BY year""",
)
register(
    "d40_ids_by_label",
    lambda spark, d: stats.ids_by_label(final(spark, d)),
    "SELECT side, sex, count(DISTINCT id) AS count FROM final GROUP BY side, sex",
)
register(
    "d40_ids_at_site",
    lambda spark, d: stats.ids_at(base(spark, d), "Haldimand", "Right"),
    "SELECT id, side, count(*) AS count FROM base WHERE location = 'Haldimand' AND qrate >= 3 AND side = 'Right' GROUP BY id, side",
)
register("d40_seen_everywhere", lambda spark, d: stats.seen_everywhere(base(spark, d), "Left"), gq.EVERYWHERE)
_PLACES = """nullif(count(*) FILTER (WHERE location = 'Gully'), 0) AS gully, nullif(count(*) FILTER (WHERE location = 'Haldimand'), 0) AS haldimand,
    nullif(count(*) FILTER (WHERE location = 'Shortland'), 0) AS shortland,
    nullif(count(*) FILTER (WHERE location NOT IN ('Gully', 'Haldimand', 'Shortland')), 0) AS elsewhere"""
register(
    "d40_reliable_ids_at_site",
    lambda spark, d: stats.reliable_ids_at(base(spark, d), "Left", "Gully"),
    f"SELECT * FROM (SELECT id, {_PLACES} FROM base WHERE side = 'Left' AND reliable = 'Yes' GROUP BY id) WHERE gully IS NOT NULL",
)
register(
    "d40_good_ids_by_site",
    lambda spark, d: stats.good_ids_by_site(final(spark, d), "Left", ["FemaleJ", "MaleM", "UNK"]),
    """SELECT side, location, nullif(count(DISTINCT id) FILTER (WHERE sex = 'FemaleJ'), 0) AS femalej, nullif(count(DISTINCT id) FILTER (WHERE sex = 'MaleM'), 0) AS malem,
    nullif(count(DISTINCT id) FILTER (WHERE sex = 'UNK'), 0) AS unk FROM final WHERE qrate IN (3, 4) AND side = 'Left' AND reliable = 'Yes' GROUP BY side, location""",
)
register(
    "d40_days_per_year",
    lambda spark, d: stats.individual_days_per_year(base(spark, d)),
    "SELECT year(date) AS year, count(*) AS count FROM (SELECT DISTINCT date, location, id, side, film FROM base) GROUP BY 1",
)
register(
    "d40_photos_per_day_and_place",
    lambda spark, d: stats.photos_per_day_and_place(base(spark, d)),
    "SELECT date, location, side, film, count(*) AS count FROM base GROUP BY ALL",
)
register(
    "d40_photos_by_year",
    lambda spark, d: stats.photos_by_year(base(spark, d)),
    """SELECT year, film, nullif(count(*) FILTER (WHERE side = 'Left'), 0) AS left, nullif(count(*) FILTER (WHERE side = 'Right'), 0) AS right
    FROM base GROUP BY year, film""",
)


def _reliable_by_label(rows, labels):
    out = stats.reliability_by_label(rows, labels)
    return out.select("reliable", *[F.round(v.lower(), 6).alias(v.lower()) for v in labels])


def _shares(labels):
    """A combination that doesn't occur has no share."""
    columns = ", ".join(
        f"round(nullif(count(*) FILTER (WHERE sex = '{v}'), 0) / sum(count(*) FILTER (WHERE sex = '{v}')) OVER (), 6) AS {v.lower()}" for v in labels
    )
    return f"SELECT reliable, {columns} FROM final WHERE sex IN ({', '.join(repr(v) for v in labels)}) GROUP BY reliable"


for _name, _labels in (("d40_reliability_by_label", ["FemaleJ", "MaleM", "UNK"]), ("d40_reliability_by_known_label", ["FemaleJ", "MaleM"])):
    register(_name, lambda spark, d, labels=_labels: _reliable_by_label(final(spark, d), labels), _shares(_labels))
register(
    "d21_label_totals",
    lambda spark, d: lh.label_totals(lh.id_summary(melon(spark, d), 2025)),
    """SELECT count(*) AS n_ids, count(*) FILTER (n_photos_with_sex > 0) AS n_labelled, """
    + ", ".join(f"count(*) FILTER (primary_sex = '{v}') AS vote_{v.lower()}" for v in ("FemaleJ", "MaleM", "UNK", "CONFLICT"))
    + ", "
    + ", ".join(f"count(*) FILTER (current_sex = '{v}') AS current_{v.lower()}" for v in ("FemaleJ", "MaleM", "UNK", "UNK_from_known", "CONFLICT"))
    + """, count(*) FILTER (possible_maturation) AS n_possible_maturation, count(*) FILTER (inter_keyword_conflict) AS n_source_conflicts,
    count(*) FILTER (all_keywords_identical) AS n_identical_sources, min(first_year) AS first_year, max(last_year) AS last_year FROM summary""",
)
_CAMERA = "CASE WHEN photo_seq % 14 = 5 THEN 'DSC_' || photo_seq % 1000 || '.JPG' ELSE file_name END"
register(
    "f13_year_rejects",
    lambda spark, d: lh.without_year(lh.melon_photos(driver.camera_names(spark, d))),
    f"SELECT photo_seq, {_CAMERA} AS file_name, title AS id FROM listing WHERE photo_seq % 14 = 5 AND NOT contains(lower(keyword_export), 'dorsal')",
)
register(
    "f13_year_coverage",
    lambda spark, d: lh.year_coverage(lh.melon_photos(driver.camera_names(spark, d))),
    """SELECT count(*) AS n_photos, count(*) FILTER (photo_seq % 14 <> 5) AS n_with_year, min(CAST(substr(file_name, 5, 4) AS INT)) FILTER (photo_seq % 14 <> 5) AS first_year,
    max(CAST(substr(file_name, 5, 4) AS INT)) FILTER (photo_seq % 14 <> 5) AS last_year FROM listing WHERE NOT contains(lower(keyword_export), 'dorsal')""",
)
register("d40_mark_shares", gq._mark_shares, gq.MARK_SHARES)
register(
    "d41_good_photos",
    lambda spark, d: stats.good_photos(base(spark, d)).select("photo_seq", "id", "qrate"),
    "SELECT photo_seq, id, qrate FROM base WHERE qrate IN (3, 4)",
)
register(
    "d41_photos_per_id",
    lambda spark, d: stats.photos_per_id(
        base(spark, d), F.col("side") == "Left", F.col("reliable") == "Yes", F.col("location") == "Gully"
    ),
    "SELECT id, count(*) AS count FROM base WHERE side = 'Left' AND reliable = 'Yes' AND location = 'Gully' GROUP BY id",
)
register(
    "d41_photos_per_day",
    lambda spark, d: stats.photos_per_day(base(spark, d)),
    "SELECT date, count(*) AS count FROM base GROUP BY date",
)
register(
    "d41_species_counts",
    lambda spark, d: stats.species_counts(derived(spark, d)),
    """SELECT CASE WHEN regexp_matches(keyword, 'SW') THEN 'Sperm whale' WHEN regexp_matches(keyword, 'NBW') THEN 'Northern bottlenose' ELSE 'UNK' END AS species,
    id, year, count(*) AS count FROM derived WHERE qrate >= 3 GROUP BY 1, 2, 3""",
)
