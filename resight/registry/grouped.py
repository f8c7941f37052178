"""Queries for joins, aggregates, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from resight.functions import dates, keywords as kw, text
from resight.operators import gates, groups as g, joins, scans
from resight.operators.order import by_date, by_sequence
from resight.operators.skew import attach_group
from resight.plans import annual, base as b, catalogues, finalize, keyword_conflicts as kc, label_history as lh
from resight.plans import label_qa as qa, metadata, rating_runs, stats
from resight.registry.core import register
from resight.registry.scalars import compared
from resight.session import stored
from resight.sources import driver

DATE_ORDER = by_date("date", "photo_seq")
FILE_ORDER = by_sequence("photo_seq")
NAMES = ("catalogue", "dorsal")


def derived(spark, d):
    return b.derive(driver.listing(spark, d))


def base(spark, d):
    """Snapshot of the cleaned listing: the reports and the final tables start from it."""
    return stored(spark, "base", d, lambda: b.clean_base(driver.listing(spark, d)))


def corrections(spark, d):
    """Reviewed corrections: a table of its own, as the reviewer's file would be."""
    return stored(spark, "corrections", d, lambda: finalize.corrections_from_precedence(base(spark, d)))


def finalized(spark, d):
    return finalize.finalize(base(spark, d), corrections(spark, d))


def final(spark, d):
    """Saved final listing: the exports start from it."""
    return stored(spark, "final", d, lambda: finalized(spark, d))


def melon(spark, d):
    return lh.melon_photos(driver.listing(spark, d))


def flagged(spark, d):
    return kc.flagged_photos(driver.listing(spark, d))


def pair(spark, d, rule_set="catalogue_tags"):
    annual_rows, primary_rows = driver.annual_and_primary(spark, d)
    return catalogues.clean_catalogue(annual_rows, rule_set), catalogues.clean_catalogue(primary_rows, rule_set)


# ---- joins --------------------------------------------------------------------------------


def _null_safe(spark, d):
    rows = derived(spark, d)
    counts = rows.groupBy("id", "id_original").agg(g.n_rows("n_photos"))
    dated = rows.filter(F.col("date").isNotNull()).groupBy("id", "id_original").agg(
        F.min("date").alias("first_date")
    )
    return joins.null_safe(counts, dated, ["id", "id_original"])


register(
    "j1_null_safe_left_join",
    _null_safe,
    "SELECT id, id_original, count(*) AS n_photos, min(date) AS first_date FROM derived GROUP BY id, id_original",
)
register(
    "j2_chained_aggregates",
    lambda spark, d: lh.id_summary(melon(spark, d), 2025).select(
        "id", "n_photos_total", "first_year", "most_recent_sex_year", "keywords_present"
    ),
    "SELECT id, n_photos_total, first_year, most_recent_sex_year, keywords_present FROM summary",
)
register(
    "j3_many_to_one",
    lambda spark, d: joins.many_to_one(
        base(spark, d).select("photo_seq", "id", "side"),
        base(spark, d).groupBy("id", "side").agg(F.max("date").alias("last_date")),
        ["id", "side"],
    ),
    "SELECT photo_seq, id, side, max(date) OVER (PARTITION BY id, side) AS last_date FROM base",
)
register(
    "j4_inner_join_on_key",
    lambda spark, d: compared(spark, d).select("match_key", "lv_filename_raw", "pipe_filename_raw", "lv_q", "pipe_q"),
    "SELECT match_key, lv_filename_raw, pipe_filename_raw, lv_q, pipe_q FROM rated",
)
register(
    "j5_semi_join",
    lambda spark, d: joins.ids_present(
        base(spark, d).select("photo_seq", "id"), base(spark, d).filter("biopsy = 'YES'"), "id", ["photo_seq"]
    ),
    "SELECT photo_seq, id FROM base WHERE id IN (SELECT id FROM base WHERE biopsy = 'YES')",
)
register(
    "j6_anti_join",
    lambda spark, d: joins.ids_missing(
        pair(spark, d)[0].filter(F.col("id").isNotNull()).select("id").distinct(), pair(spark, d)[1], "id"
    ),
    """SELECT DISTINCT id FROM catalogue WHERE photo_seq % 3 <> 0 AND id IS NOT NULL
    AND id NOT IN (SELECT id FROM catalogue WHERE photo_seq % 3 <> 1 AND id IS NOT NULL)""",
)
register(
    "j7_aggregate_join_back",
    lambda spark, d: attach_group(
        derived(spark, d).select("photo_seq", "id", "date"),
        ["id"],
        [g.n_rows("n_photos"), F.max("date").alias("last_date")],
        ["photo_seq"],
    ),
    """SELECT photo_seq, id, date, CASE WHEN id IS NOT NULL THEN count(*) OVER (PARTITION BY id) END AS n_photos,
    CASE WHEN id IS NOT NULL THEN max(date) OVER (PARTITION BY id) END AS last_date FROM derived""",
)


def _lookup(spark, d):
    files = driver.listing(spark, d).filter(F.col("photo_seq") % 3 != 0)
    key = text.rename_key("file_name").alias("key")
    return joins.first_match(
        driver.listing(spark, d).select("photo_seq", key), files.select(key, "file_name"), "key", "file_name", "file_name"
    )


_KEYED = r"""SELECT photo_seq, file_name, regexp_replace(regexp_replace(file_name, '\.[^.]*$', ''), '-[0-9]+$', '') AS key FROM listing"""
register(
    "j8_first_match_lookup",
    _lookup,
    f"""SELECT l.photo_seq, l.key, f.file_name, f.file_name IS NOT NULL AS found FROM ({_KEYED}) l
    LEFT JOIN (SELECT key, min(file_name) AS file_name FROM ({_KEYED}) WHERE photo_seq % 3 <> 0 GROUP BY 1) f ON l.key = f.key""",
)


def _natural(spark, d):
    photos = base(spark, d).select("photo_seq", "id", "side", "qrate")
    spans = base(spark, d).groupBy("id", "side").agg(F.min("year").alias("year1"))
    return joins.many_to_one(photos, spans, joins.shared_columns(photos, spans), check=False)


register(
    "j9_shared_key_join",
    _natural,
    "SELECT photo_seq, id, side, qrate, min(year) OVER (PARTITION BY id, side) AS year1 FROM base",
)

# ---- aggregates ---------------------------------------------------------------------------

register(
    "a1_count_with_null_key",
    lambda spark, d: derived(spark, d).groupBy("id", "side").agg(g.n_rows("n")),
    "SELECT id, side, count(*) AS n FROM derived GROUP BY id, side",
)
register(
    "a2_distinct_with_null",
    lambda spark, d: derived(spark, d).groupBy("side").agg(
        g.distinct_with_null("id").alias("n_ids"), F.count_distinct("id").alias("n_known_ids")
    ),
    """SELECT side, count(DISTINCT id) + max(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS n_ids,
    count(DISTINCT id) AS n_known_ids FROM derived GROUP BY side""",
)
register(
    "a3_conditional_counts",
    lambda spark, d: derived(spark, d).groupBy("location").agg(
        F.count_if(F.col("sex") == "FemaleJ").alias("n_femalej"), F.count_if(F.col("sex") == "MaleM").alias("n_malem"),
        F.count("latitude").alias("has_lat"), F.count_if(F.col("sex").isNull()).alias("no_sex"),
    ),
    """SELECT location, count(*) FILTER (WHERE sex = 'FemaleJ') AS n_femalej, count(*) FILTER (WHERE sex = 'MaleM') AS n_malem,
    count(latitude) AS has_lat, count(*) FILTER (WHERE sex IS NULL) AS no_sex FROM derived GROUP BY location""",
)
register(
    "a4_min_max_strict_and_lenient",
    lambda spark, d: base(spark, d).groupBy("id").agg(
        g.strict_min("date").alias("strict_first"), g.strict_max("date").alias("strict_last"),
        F.min("date").alias("first"), F.max("date").alias("last"),
    ),
    """SELECT id, CASE WHEN count(*) = count(date) THEN min(date) END AS strict_first,
    CASE WHEN count(*) = count(date) THEN max(date) END AS strict_last, min(date) AS first, max(date) AS last FROM base GROUP BY id""",
)
register(
    "a5_span_in_years",
    lambda spark, d: base(spark, d).groupBy("id").agg(
        dates.year_span(F.min("year"), F.max("year")).alias("span_inclusive"),
        dates.year_span(F.min("year"), F.max("year"), False).alias("span_exclusive"),
        (F.lit(2025) - F.max("year")).alias("years_since_last"),
        F.round(dates.years_between(F.min("date"), F.max("date")), 6).alias("years_exact"),
    ),
    """SELECT id, max(year) - min(year) + 1 AS span_inclusive, max(year) - min(year) AS span_exclusive,
    2025 - max(year) AS years_since_last, round(date_diff('day', min(date), max(date)) / 365.25, 6) AS years_exact FROM base GROUP BY id""",
)
register(
    "a6_first_non_null",
    lambda spark, d: base(spark, d).groupBy("id").agg(
        g.first_value("sex", DATE_ORDER).alias("first_sex"),
        F.coalesce(g.first_value("biopsy", FILE_ORDER), F.lit("NO")).alias("biopsy"),
    ),
    """SELECT id, first(sex ORDER BY date NULLS LAST, photo_seq) FILTER (WHERE sex IS NOT NULL) AS first_sex,
    coalesce(max(biopsy), 'NO') AS biopsy FROM base GROUP BY id""",
)
SAMPLES = """SELECT id, string_agg(keyword, ' | ' ORDER BY pos) AS samples FROM (
    SELECT id, keyword, min(photo_seq) AS pos, row_number() OVER (PARTITION BY id ORDER BY min(photo_seq)) AS r
    FROM {rows} GROUP BY id, keyword) WHERE r <= 3 GROUP BY id"""
register(
    "a7_first_distinct_texts",
    lambda spark, d: g.first_distinct_text(base(spark, d), ["id"], "keyword", FILE_ORDER, 3, "samples"),
    SAMPLES.format(rows="base"),
)
register(
    "a8_distinct_labels_joined",
    lambda spark, d: base(spark, d).groupBy("id").agg(g.sorted_labels("sex").alias("labels")),
    "SELECT id, coalesce(string_agg(DISTINCT sex, ' & ' ORDER BY sex), '') AS labels FROM base GROUP BY id",
)
register(
    "a9_any_and_all",
    lambda spark, d: base(spark, d).groupBy("id").agg(
        g.any_of(F.col("biopsy").isNotNull()).alias("any_biopsy"), F.bool_and(F.col("date").isNull()).alias("all_undated")
    ),
    "SELECT id, count(biopsy) > 0 AS any_biopsy, count(date) = 0 AS all_undated FROM base GROUP BY id",
)
register(
    "a10_count_of_groups",
    lambda spark, d: annual.days_per_id(base(spark, d)),
    "SELECT id, count(*) AS n_days FROM (SELECT DISTINCT id, date FROM base) GROUP BY id",
)
register(
    "a11_distinct_rows",
    lambda spark, d: base(spark, d).select("id", "side", "reliable").distinct(),
    "SELECT DISTINCT id, side, reliable FROM base",
)
register(
    "a12_frequency_table",
    lambda spark, d: b.frequency(derived(spark, d), "sex"),
    "SELECT sex, count(*) AS n FROM derived GROUP BY sex",
)
register(
    "a13_table_summary",
    lambda spark, d: b.summary(base(spark, d)),
    """SELECT count(*) AS n_records, count(DISTINCT id) AS n_ids, min(date) AS first_date, max(date) AS last_date,
    min(year) AS first_year, max(year) AS last_year FROM base""",
)
register(
    "a14_share_within_group",
    lambda spark, d: stats.share_within(base(spark, d), "location", "reliable", ["Yes", "No"]).select(
        "location", F.round("yes", 6).alias("yes"), F.round("no", 6).alias("no")
    ),
    """SELECT location, round(nullif(count(*) FILTER (WHERE reliable = 'Yes'), 0) / count(*), 6) AS yes,
    round(nullif(count(*) FILTER (WHERE reliable = 'No'), 0) / count(*), 6) AS no FROM base GROUP BY location""",
)
register(
    "a14_share_across",
    lambda spark, d: stats.share_across(final(spark, d), "sex", ["FemaleJ", "MaleM", "UNK"], "reliable").select(
        "reliable", *[F.round(c, 6).alias(c) for c in ("femalej", "malem", "unk")]
    ),
    """SELECT reliable, """
    + ", ".join(
        f"round(nullif(count(*) FILTER (WHERE sex = '{s}'), 0) / (SELECT count(*) FROM final WHERE sex = '{s}'), 6) AS {s.lower()}"
        for s in ("FemaleJ", "MaleM", "UNK")
    )
    + " FROM final GROUP BY reliable",
)
register(
    "a15_pivot_counts",
    lambda spark, d: stats.pivot_counts(base(spark, d), ["year", "film"], "side", ["Left", "Right"]),
    """SELECT year, film, nullif(count(*) FILTER (WHERE side = 'Left'), 0) AS left, nullif(count(*) FILTER (WHERE side = 'Right'), 0) AS right
    FROM base GROUP BY year, film""",
)
EVERYWHERE = """SELECT id, side, count(*) FILTER (WHERE location = 'Gully') AS gully, count(*) FILTER (WHERE location = 'Haldimand') AS haldimand,
    count(*) FILTER (WHERE location = 'Shortland') AS shortland, nullif(count(*) FILTER (WHERE location NOT IN ('Gully', 'Haldimand', 'Shortland')), 0) AS elsewhere FROM (SELECT DISTINCT date, location, id, side FROM base WHERE side = 'Left')
    GROUP BY id, side HAVING count(DISTINCT location) FILTER (WHERE location <> '??') = 3"""
register("a16_seen_everywhere", lambda spark, d: stats.seen_everywhere(base(spark, d), "Left"), EVERYWHERE)
TIMELINE_YEARS = range(1995, 2002)  # of the test data; the queries take theirs from the rows, so another year would show
TIMELINE = (
    "SELECT id, "
    + ", ".join(f"max(a) FILTER (WHERE year = {y}) AS year_{y}" for y in TIMELINE_YEARS)
    + """, max(a) FILTER (WHERE year IS NULL) AS year_na FROM (SELECT id, year, string_agg(DISTINCT sex, ' & ' ORDER BY sex) AS a
    FROM melon WHERE sex IS NOT NULL GROUP BY id, year) GROUP BY id"""
)
register("a17_year_timeline", lambda spark, d: lh.timeline_wide(melon(spark, d)), TIMELINE)
register(
    "a18_vote_label",
    lambda spark, d: lh.id_summary(melon(spark, d), 2025).select("id", "n_femalej", "n_malem", "primary_sex"),
    "SELECT id, n_femalej, n_malem, primary_sex FROM summary",
)
register(
    "a19_current_label",
    lambda spark, d: lh.id_summary(melon(spark, d), 2025).select("id", "most_recent_sex_year", "current_sex"),
    "SELECT id, most_recent_sex_year, current_sex FROM summary",
)
register(
    "a20_label_transition",
    lambda spark, d: lh.id_summary(melon(spark, d), 2025).select(
        "id", "first_femalej_year", "first_malem_year", "possible_maturation"
    ),
    "SELECT id, first_femalej_year, first_malem_year, possible_maturation FROM summary",
)
HISTORY = """SELECT id, year, n_melon_photos, n_with_sex, n_femalej, n_malem, n_unk,
    CASE WHEN n_femalej > 0 AND n_malem = 0 THEN 'FemaleJ' WHEN n_malem > 0 AND n_femalej = 0 THEN 'MaleM'
      WHEN n_femalej > 0 AND n_malem > 0 THEN 'CONFLICT' WHEN n_unk > 0 THEN 'UNK' ELSE 'No Sex' END AS sex_annual
    FROM (SELECT id, year, count(*) AS n_melon_photos, count(sex) AS n_with_sex, count(*) FILTER (WHERE sex = 'FemaleJ') AS n_femalej,
      count(*) FILTER (WHERE sex = 'MaleM') AS n_malem, count(*) FILTER (WHERE sex = 'UNK') AS n_unk FROM melon GROUP BY id, year)"""
CONFLICT_YEARS = """SELECT id, year, n_femalej, n_malem, n_unk,
    CASE WHEN n_femalej > 0 AND n_malem > 0 THEN 'CONFLICT' WHEN n_unk > 0 AND n_malem + n_femalej > 0 THEN 'UNK_from_known'
      WHEN n_femalej > 0 THEN 'FemaleJ' WHEN n_malem > 0 THEN 'MaleM' ELSE 'UNK' END AS primary_sex_annual
    FROM (SELECT id, year, count(*) FILTER (WHERE sex = 'FemaleJ') AS n_femalej, count(*) FILTER (WHERE sex = 'MaleM') AS n_malem,
      count(*) FILTER (WHERE sex = 'UNK') AS n_unk FROM melon WHERE sex IS NOT NULL AND year IS NOT NULL
      AND id IN (SELECT id FROM summary WHERE (n_femalej > 0 AND n_malem > 0) OR (n_unk > 0 AND n_malem > 0) OR (n_unk > 0 AND n_femalej > 0))
      GROUP BY id, year)"""
register("a21_label_per_year", lambda spark, d: lh.history_detailed(melon(spark, d)), HISTORY)
register("a21_conflict_per_year", lambda spark, d: lh.conflict_years(melon(spark, d)), CONFLICT_YEARS)
PATTERNS = f"""SELECT id, min(year) AS first_year, max(year) AS last_year,
    coalesce(string_agg(year, ', ' ORDER BY year) FILTER (WHERE primary_sex_annual = 'FemaleJ'), '') AS years_as_femalej,
    coalesce(string_agg(year, ', ' ORDER BY year) FILTER (WHERE primary_sex_annual = 'MaleM'), '') AS years_as_malem,
    coalesce(string_agg(year, ', ' ORDER BY year) FILTER (WHERE primary_sex_annual = 'UNK'), '') AS years_as_unk,
    coalesce(string_agg(year, ', ' ORDER BY year) FILTER (WHERE primary_sex_annual = 'CONFLICT'), '') AS years_with_conflict,
    min(year) FILTER (WHERE primary_sex_annual = 'FemaleJ') AS first_femalej_year,
    min(year) FILTER (WHERE primary_sex_annual = 'MaleM') AS first_malem_year,
    coalesce(min(year) FILTER (WHERE primary_sex_annual = 'FemaleJ') < min(year) FILTER (WHERE primary_sex_annual = 'MaleM'), false) AS possible_maturation
    FROM ({CONFLICT_YEARS}) GROUP BY id"""
register(
    "a22_year_lists",
    lambda spark, d: lh.conflict_patterns(melon(spark, d)).select(
        "id", "years_as_femalej", "years_as_malem", "years_as_unk", "years_with_conflict"
    ),
    f"SELECT id, years_as_femalej, years_as_malem, years_as_unk, years_with_conflict FROM ({PATTERNS})",
)
COMPARED = """SELECT id, n_melon_tagged, n_sum_tagged, keywords_present, inter_keyword_conflict, all_keywords_identical,
    melon_sex_values, sum_sex_values FROM compared"""
register("a23_two_source_comparison", lambda spark, d: lh.source_comparison(melon(spark, d)), COMPARED)
CONFLICTS = """SELECT c.*, round(date_diff('day', first_date, last_date) / 365.25, 6) AS date_range_years FROM (
    SELECT id, count(DISTINCT sex) AS n_sex_categories, count(sex) AS n_photos_total,
      count(*) FILTER (WHERE sex = 'FemaleJ') AS n_femalej, count(*) FILTER (WHERE sex = 'MaleM') AS n_malem,
      CASE WHEN count(biopsy) FILTER (WHERE sex IS NOT NULL) > 0 THEN 'YES' ELSE 'NO' END AS biopsied,
      min(date) FILTER (WHERE sex = 'FemaleJ') AS first_femalej_date, max(date) FILTER (WHERE sex = 'FemaleJ') AS last_femalej_date,
      min(date) FILTER (WHERE sex = 'MaleM') AS first_malem_date, max(date) FILTER (WHERE sex = 'MaleM') AS last_malem_date,
      min(date) AS first_date, max(date) AS last_date,
      (SELECT string_agg(sex, ' & ' ORDER BY s) FROM (SELECT sex, min(photo_seq) AS s FROM base i WHERE i.id = o.id AND sex IS NOT NULL GROUP BY sex)) AS sex_categories
    FROM base o GROUP BY id HAVING count(DISTINCT sex) > 1) c"""


def _conflicts(spark, d):
    return qa.label_conflicts(base(spark, d)).withColumn("date_range_years", F.round("date_range_years", 6))


register("a24_label_conflicts", _conflicts, CONFLICTS)
KC_COUNTS = """count(*) AS n_photos, count(*) FILTER (WHERE has_melon_f) AS n_melon_f, count(*) FILTER (WHERE has_melon_m) AS n_melon_m,
    count(*) FILTER (WHERE has_melon_unk) AS n_melon_unk, count(*) FILTER (WHERE has_sum_unk) AS n_sum_unk,
    count(*) FILTER (WHERE female_words) AS n_female_keywords, count(*) FILTER (WHERE male_words) AS n_male_keywords"""
KC_RULE = """(n_melon_f > 0 AND n_male_keywords > 0) OR (n_melon_m > 0 AND n_female_keywords > 0) OR (n_melon_f > 0 AND n_melon_m > 0)
    OR (n_melon_f > 0 AND n_melon_unk > 0) OR (n_melon_m > 0 AND n_melon_unk > 0) OR (n_melon_f > 0 AND n_sum_unk > 0) OR (n_melon_m > 0 AND n_sum_unk > 0)"""
ID_KEYWORD_CONFLICTS = f"SELECT *, true AS has_conflict FROM (SELECT id, {KC_COUNTS} FROM flagged GROUP BY id) WHERE {KC_RULE}"
KEYWORD_TIMELINE = f"""SELECT id, year, n_photos, n_melon_f, n_melon_m, n_melon_unk, n_female_keywords AS n_fj, n_male_keywords AS n_mm,
    n_sum_unk AS n_unk, ({KC_RULE}) AS year_has_conflict FROM (SELECT id, year, {KC_COUNTS} FROM flagged WHERE year IS NOT NULL GROUP BY id, year)
    WHERE id IN (SELECT id FROM ({ID_KEYWORD_CONFLICTS}))"""
register("a25_keyword_conflicts", lambda spark, d: kc.id_conflicts(flagged(spark, d)), ID_KEYWORD_CONFLICTS)
LABEL_TIMELINE = """SELECT id, sex, CASE WHEN count(*) = count(date) THEN min(date) END AS first_sex_date,
    CASE WHEN count(*) = count(year) THEN min(year) END AS first_sex_year, count(*) AS n_photos_with_sex FROM base WHERE sex IS NOT NULL GROUP BY id, sex"""
register("a26_label_timeline", lambda spark, d: qa.label_timeline(base(spark, d)), LABEL_TIMELINE)
BIOPSY_FIRST = """SELECT id, CASE WHEN count(*) = count(date) THEN min(date) END AS first_biopsy_date,
    CASE WHEN count(*) = count(year) THEN min(year) END AS first_biopsy_year, count(*) AS n_biopsy_photos,
    first(sex ORDER BY photo_seq) FILTER (WHERE sex IS NOT NULL) AS sex FROM base WHERE biopsy IS NOT NULL GROUP BY id"""
BY_YEAR = """SELECT year, source, count(DISTINCT id) AS biopsy_count FROM (
    SELECT *, 'catalogue' AS source FROM catalogue WHERE photo_seq % 3 <> 0 UNION ALL SELECT *, 'dorsal' FROM catalogue WHERE photo_seq % 3 <> 1)
    WHERE id IS NOT NULL AND biopsy = 'YES' GROUP BY year, source"""
register(
    "a27_biopsy_timeline",
    lambda spark, d: catalogues.biopsies_by_year(*pair(spark, d, "biopsy_tags"), NAMES),
    BY_YEAR,
)
register(
    "a28_both_sides",
    lambda spark, d: annual.both_sides(base(spark, d)),
    "SELECT id, count(DISTINCT side) AS n_sides FROM base GROUP BY id HAVING count(DISTINCT side) = 2",
)
register(
    "a29_new_and_old",
    lambda spark, d: annual.new_and_old(base(spark, d), 1000),
    """SELECT count(DISTINCT id) AS n_ids, count(DISTINCT id) FILTER (WHERE CAST(id AS BIGINT) >= 1000) AS n_new,
    count(DISTINCT id) FILTER (WHERE CAST(id AS BIGINT) < 1000) AS n_old FROM base""",
)


def _mark_shares(spark, d):
    shares = stats.mark_shares(base(spark, d))
    return shares.select(*[F.round(c, 6).alias(c) for c in shares.columns])


MARK_SHARES = "SELECT " + ", ".join(
    f"""round(count(*) FILTER (WHERE contains(keyword, '{w}')) / count(*), 6) AS {m}_photo_share,
    round(count(DISTINCT id) FILTER (WHERE contains(keyword, '{w}')) / count(DISTINCT id), 6) AS {m}_id_share,
    round(count(DISTINCT id || side) FILTER (WHERE contains(keyword, '{w}')) / count(DISTINCT id || side), 6) AS {m}_id_side_share"""
    for m, w in kw.SINGLE_MARKS.items()
) + " FROM base"
register("a30_mark_shares", _mark_shares, MARK_SHARES)
AGREEMENT = """SELECT *, round(100.0 * agree / q_total, 1) AS agree_pct, round(100.0 * disagree / q_total, 1) AS disagree_pct FROM (
    SELECT count(*) AS q_total, count(*) FILTER (WHERE q_agree) AS agree, count(*) FILTER (WHERE q_flag) AS disagree,
    count(*) FILTER (WHERE q_direction = 'pipeline_higher') AS pipeline_higher, count(*) FILTER (WHERE q_direction = 'pipeline_lower') AS pipeline_lower,
    count(*) FILTER (WHERE lv_q = 3 AND pipe_q = 2) AS manual3_auto2, count(*) FILTER (WHERE lv_q = 2 AND pipe_q = 3) AS manual2_auto3
    FROM rated WHERE q_comparable)"""
register("a31_agreement_summary", lambda spark, d: rating_runs.agreement(compared(spark, d)), AGREEMENT)
RUN_SUMMARY = """SELECT count(*) AS total, """ + ", ".join(
    f"count(*) FILTER (WHERE output_folder = '{f}') AS {f.lower()}"
    for f in ("Q4_excellent", "Q3_good", "Q2_poor", "Q1_reject", "review_melon_only", "review_unclear", "reject_no_whale")
) + """, count(*) FILTER (WHERE contains(output_folder, 'error')) AS errors, count(*) FILTER (WHERE "borderline_Q3") AS borderline,
    count(*) FILTER (WHERE NOT trailing_edge_clear) AS trailing_edge_unclear,
    count(*) FILTER (WHERE output_folder = 'Q3_good' AND NOT trailing_edge_clear) AS trailing_edge_review,
    count(*) FILTER (WHERE multiple_whales) AS multiple, count(*) FILTER (WHERE melon_present) AS melons,
    count(*) FILTER (WHERE crop_recommended) AS crops FROM auto"""
register(
    "a32_rating_run_summary",
    lambda spark, d: rating_runs.run_summary(rating_runs.parse_ratings(driver.auto_responses(spark, d))),
    RUN_SUMMARY,
)
register(
    "a33_encounter_range",
    lambda spark, d: annual.encounter_range(annual.encounters_per_day(driver.sightings(spark, d), 50)),
    "SELECT min(n_encounters) AS fewest, max(n_encounters) AS most FROM per_day",
)

# ---- windows ------------------------------------------------------------------------------


def _filled(direction, value="sex"):
    def run(spark, d):
        rows = derived(spark, d).select("photo_seq", "id", "date", value)
        return scans.fill_group(rows, "id", value, DATE_ORDER, direction, "filled").select("photo_seq", "id", "filled")

    return run


_W = "PARTITION BY id ORDER BY date NULLS LAST, photo_seq"
_DOWN = f"last_value({{v}} IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING)"
_UP = f"first_value({{v}} IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _fill_sql(expression, value="sex"):
    return f"SELECT photo_seq, id, CASE WHEN id IS NULL THEN {value} ELSE {expression.format(v=value)} END AS filled FROM derived"


register("w1_fill_down", _filled("down"), _fill_sql(_DOWN))
register("w1_fill_down_biopsy", _filled("down", "biopsy"), _fill_sql(_DOWN, "biopsy"))
register("w2_fill_down_up", _filled("downup"), _fill_sql(f"coalesce({_DOWN}, {_UP})"))
register("w2_fill_up_down", _filled("updown"), _fill_sql(f"coalesce({_UP}, {_DOWN})"))
register(
    "w3_gap_minutes",
    lambda spark, d: scans.gap_to_previous(driver.sightings(spark, d), "id", "datetime", "event_id").select(
        "event_id", "id", F.round(F.col("gap_minutes") * 60_000_000).cast("bigint").alias("gap_micros")
    ),
    "SELECT event_id, id, CAST(round(gap_minutes * 60000000) AS BIGINT) AS gap_micros FROM sighted",
)
register(
    "w4_sessionize",
    lambda spark, d: scans.sessionize(driver.sightings(spark, d), "id", "datetime", "event_id").select(
        "event_id", "id", "encounter_id"
    ),
    "SELECT event_id, id, encounter_id FROM encounters",
)
register(
    "w5_first_row",
    lambda spark, d: g.first_row(base(spark, d), ["id", "side"], DATE_ORDER, ["photo_seq", "date", "melon_sex"]),
    f"""SELECT id, side, photo_seq, date, melon_sex FROM (SELECT *, row_number() OVER (PARTITION BY id, side ORDER BY date NULLS LAST, photo_seq) AS r FROM base) WHERE r = 1""",
)
register(
    "w6_group_bounds",
    lambda spark, d: g.group_bounds(
        derived(spark, d).select("photo_seq", "id", "year"), ["id"], "year", ["photo_seq"]
    ),
    """SELECT photo_seq, id, year, CASE WHEN id IS NOT NULL THEN min(year) OVER w END AS min_year, CASE WHEN id IS NOT NULL THEN max(year) OVER w END AS max_year,
    CASE WHEN id IS NOT NULL THEN max(year) OVER w - min(year) OVER w + 1 END AS year_span FROM derived WINDOW w AS (PARTITION BY id)""",
)
SEVERAL = """SELECT id, sex, count(*) AS n FROM (SELECT nullif(title, 'UNK') AS id,
    CASE WHEN regexp_matches(keyword_export, '\\bSex_F\\b') THEN 'FJ' WHEN regexp_matches(keyword_export, '\\bSex_M\\b') THEN 'MM' ELSE 'UNK' END AS sex FROM tagged)
    WHERE id IS NOT NULL GROUP BY id, sex"""
register(
    "w7_repeated_groups",
    lambda spark, d: catalogues.several_labels(catalogues.format_keywords(driver.tagged_listing(spark, d))),
    f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY id) AS c FROM ({SEVERAL})) WHERE c > 1".replace("SELECT * FROM", "SELECT id, sex, n FROM", 1),
)
register(
    "w8_precedence_label",
    lambda spark, d: g.precedence_label(
        derived(spark, d).select("photo_seq", "id", "sex"), "id", "sex", ["photo_seq"]
    ),
    """SELECT photo_seq, id, CASE WHEN id IS NULL THEN sex WHEN bool_or(sex = 'MaleM') OVER w THEN 'MaleM' WHEN bool_or(sex = 'FemaleJ') OVER w THEN 'FemaleJ'
    ELSE 'UNK' END AS sex FROM derived WINDOW w AS (PARTITION BY id)""",
)
register(
    "w9_first_known_label",
    lambda spark, d: g.first_known_label(
        derived(spark, d).select("photo_seq", "id", "sex"), "id", "sex", FILE_ORDER, ["photo_seq"]
    ),
    """SELECT photo_seq, id, CASE WHEN id IS NULL THEN sex ELSE coalesce(first_value(nullif(sex, 'UNK') IGNORE NULLS) OVER
    (PARTITION BY id ORDER BY photo_seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'UNK') END AS sex FROM derived""",
)
register(
    "w10_sample_one",
    lambda spark, d: g.sample_one(
        base(spark, d).filter(F.col("year").isNotNull()), ["id", "year"], "photo_seq", ["photo_seq", "side", "sex"], 7
    ),
    """SELECT id, year, photo_seq, side, sex FROM (SELECT *, row_number() OVER (PARTITION BY id, year ORDER BY md5('7:' || photo_seq), photo_seq) AS r
    FROM base WHERE year IS NOT NULL) WHERE r = 1""",
)
register(
    "w11_first_year_class",
    lambda spark, d: g.first_year_class(
        metadata.side_photos(driver.tagged_listing(spark, d), "left").select("photo_seq", "title", "year", "age_class"),
        "title", "year", "age_class", ["photo_seq"],
    ).select("photo_seq", "title", "first_year_class"),
    """SELECT photo_seq, title, first_value(CASE WHEN y IS NOT NULL THEN age END) OVER (PARTITION BY title ORDER BY y NULLS LAST, age) AS first_year_class
    FROM (SELECT photo_seq, title, year(TRY_CAST(substr(date_original, 1, 10) AS DATE)) AS y,
      CASE WHEN contains(keyword_export, 'samCalf') THEN 'Calf' WHEN contains(keyword_export, 'samJuv') THEN 'Juvenile' ELSE 'Adult' END AS age
      FROM tagged WHERE title <> 'UNK' AND contains(keyword_export, 'Left'))""",
)
register(
    "w12_first_reliable_year",
    lambda spark, d: g.first_reliable_year(base(spark, d), ["id"], "year", F.col("reliable") == "Yes"),
    "SELECT id, min(year) FILTER (WHERE reliable = 'Yes') AS year_reliable FROM base GROUP BY id",
)

# ---- order and sets -----------------------------------------------------------------------

register(
    "o1_sort_by_count",
    lambda spark, d: b.non_numeric_ids(derived(spark, d)).orderBy(F.desc("n_photos"), "id_original"),
    "SELECT id_original, count(*) AS n_photos FROM derived WHERE id IS NULL GROUP BY id_original ORDER BY n_photos DESC, id_original",
)
register(
    "o2_sort_ids_as_numbers",
    lambda spark, d: finalize.primary_ids(final(spark, d)).select("id_numeric", "id_side", "n_photos").orderBy("id_numeric", "id_side"),
    "SELECT CAST(id AS BIGINT) AS id_numeric, id_side, count(*) AS n_photos FROM final GROUP BY id, id_side ORDER BY 1, 2",
)
NEVER = """SELECT * FROM (SELECT id, CASE WHEN count(*) = count(date) THEN min(date) END AS first_sighting,
    CASE WHEN count(*) = count(date) THEN max(date) END AS last_sighting, count(*) AS total_photos FROM base GROUP BY id HAVING count(sex) = 0)"""
register(
    "o3_top_k_report",
    lambda spark, d: qa.top_never_labelled(base(spark, d), 10),
    NEVER + " ORDER BY total_photos DESC, id LIMIT 10",
)
register(
    "o4_ordered_pivot_columns",
    lambda spark, d: lh.timeline_wide(melon(spark, d)),
    TIMELINE,
)
register(
    "u1_union_by_name",
    lambda spark, d: catalogues.tagged_union(
        pair(spark, d)[0].select("photo_seq", "id", "sex", "year"), pair(spark, d)[1].select("photo_seq", "id", "biopsy"), NAMES
    ).drop("source_no"),
    """SELECT photo_seq, id, sex, year, CAST(NULL AS VARCHAR) AS biopsy, 'catalogue' AS source FROM catalogue WHERE photo_seq % 3 <> 0 AND id IS NOT NULL
    UNION ALL SELECT photo_seq, id, NULL, NULL, biopsy, 'dorsal' FROM catalogue WHERE photo_seq % 3 <> 1 AND id IS NOT NULL""",
)
register(
    "u2_id_difference",
    lambda spark, d: joins.id_difference(*pair(spark, d), "id"),
    "SELECT id FROM catalogue WHERE photo_seq % 3 <> 0 EXCEPT SELECT id FROM catalogue WHERE photo_seq % 3 <> 1",
)
register(
    "u3_id_intersection",
    lambda spark, d: joins.id_intersection(*pair(spark, d), "id"),
    "SELECT id FROM catalogue WHERE photo_seq % 3 <> 0 INTERSECT SELECT id FROM catalogue WHERE photo_seq % 3 <> 1",
)
register(
    "u4_unique_values",
    lambda spark, d: base(spark, d).filter("biopsy = 'YES'").select("id").distinct(),
    "SELECT DISTINCT id FROM base WHERE biopsy = 'YES'",
)

# ---- gates --------------------------------------------------------------------------------

register(
    "q1_label_conflict_gate",
    lambda spark, d: gates.label_conflicts(base(spark, d), "id", "sex"),
    "SELECT id, count(DISTINCT sex) AS n_labels FROM base GROUP BY id HAVING count(DISTINCT sex) > 1",
)
register(
    "q1_known_label_conflicts",
    lambda spark, d: gates.label_conflicts(base(spark, d), "id", "sex", ignore_unknown=True),
    "SELECT id, count(DISTINCT sex) AS n_labels FROM base WHERE sex <> 'UNK' GROUP BY id HAVING count(DISTINCT sex) > 1",
)
register(
    "q2_single_value_gate",
    lambda spark, d: gates.multi_valued(base(spark, d), ["id", "year"], "location"),
    """SELECT id, year, count(DISTINCT location) AS n_values FROM base GROUP BY id, year HAVING count(DISTINCT location) > 1""",
)
register(
    "q3_unique_key_gate",
    lambda spark, d: gates.duplicate_keys(base(spark, d), ["id", "side", "date"]),
    "SELECT id, side, date, count(*) AS n_rows FROM base GROUP BY id, side, date HAVING count(*) > 1",
)


def _required(spark, d):
    return gates.require_columns(driver.listing(spark, d), ["file_name", "rating"], "listing").select("file_name", "rating")


register("q4_required_columns", _required, "SELECT file_name, rating FROM listing")
