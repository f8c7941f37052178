"""Shared oracle table expressions, written in plain SQL apart from the Spark code."""

from resight.registry.core import cte

cte(
    "listing",
    """
SELECT k AS photo_seq,
  'IMG_' || strftime(d, '%Y%m%d') || '_' || k || '.JPG' AS file_name,
  CASE WHEN c % 29 = 0 THEN 'UNK' WHEN c % 31 = 0 THEN c || 'R'
       WHEN c % 37 = 0 THEN '0' || c ELSE CAST(c AS VARCHAR) END AS title,
  CASE WHEN k % 97 = 0 THEN '' ELSE strftime(d, '%Y-%m-%d') || ' 08:00:00' END AS date_original,
  concat_ws(', ',
    CASE WHEN p IN ('1', '2') THEN 'Left' WHEN p IN ('3', '4') THEN 'Right' END,
    CASE WHEN c % 3 = 0 AND s = 'F' THEN 'Melon_F' WHEN c % 3 = 1 AND s = 'F' THEN 'Melon_M'
         WHEN c % 6 = 2 AND s = 'F' THEN 'Melon_F' WHEN c % 6 = 2 AND s = 'O' THEN 'Melon_M'
         WHEN c % 6 = 2 THEN 'Melon_UNK' END,
    CASE WHEN k % 4 = 0 THEN CASE WHEN a < 3 THEN 'Sum_F' WHEN a = 3 THEN 'Sum_M' ELSE 'Sum_UNK' END END,
    CASE WHEN k % 17 = 0 THEN 'F2' END,
    CASE WHEN k % 19 = 0 THEN 'M3' END,
    CASE WHEN k % 41 = 0 THEN CASE WHEN c % 3 = 0 THEN 'biopsy-Female' WHEN c % 3 = 1 THEN 'biopsy-Male' ELSE 'biopsy' END END,
    CASE WHEN k % 5 = 0 THEN 'Indent' END,
    CASE WHEN k % 7 = 0 THEN 'Notch' END,
    CASE WHEN k % 9 = 0 THEN 'scar' END,
    CASE WHEN k % 10 = 0 THEN 'Patch' END,
    CASE WHEN k % 11 = 0 THEN 'Gully' END,
    CASE WHEN k % 13 = 0 THEN 'dorsal' END,
    CASE WHEN k % 6 = 0 THEN 'Digital' END,
    CASE WHEN c % 8 = 0 AND y <= 1996 THEN 'samCalf' WHEN c % 8 = 1 AND y <= 1997 THEN 'samJuv' END,
    CASE WHEN c % 7 = 0 THEN 'SW' ELSE 'NBW' END) AS keyword_export,
  repeat('* ', CAST(k % 5 AS INTEGER)) AS rating,
  CASE WHEN k % 53 = 0 THEN '' ELSE CAST(CAST(4350 + k % 100 AS DOUBLE) / 100 AS VARCHAR) END AS latitude,
  CASE WHEN k % 53 = 0 THEN '' ELSE CAST(CAST(-5920 + k % 150 AS DOUBLE) / 100 AS VARCHAR) END AS longitude
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderdate AS d,
        year(o_orderdate) AS y, substr(o_orderpriority, 1, 1) AS p,
        (o_custkey + year(o_orderdate) + CASE WHEN o_orderkey % 12 = 8 THEN 3 ELSE 0 END) % 5 AS a FROM orders)
""",
)

cte(
    "tagged",
    """
SELECT photo_seq, file_name, title, date_original,
  replace(replace(replace(replace(replace(keyword_export, 'Melon_F', 'Sex_F'), 'Melon_M', 'Sex_M'),
    'F2', 'FJ'), 'M3', 'MM'), 'Sum_F', 'FemaleJ') AS keyword_export, rating, latitude, longitude
FROM listing
""",
)

cte(
    "mixed",
    """
SELECT o_orderkey AS photo_seq, CAST(o_orderdate AS DATE) AS true_date,
  CASE o_orderkey % 4
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
    WHEN 2 THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
    ELSE month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) || ' 1:05:22 PM' END AS date_text
FROM orders
""",
)

cte(
    "derived",
    """
SELECT *,
  year(date) AS year,
  CASE WHEN keyword LIKE '%Digital%' OR year(date) >= 2015 THEN 'Digital' ELSE 'Film' END AS film,
  CASE WHEN longitude <= -58.7 OR keyword LIKE '%Gully%' THEN 'Gully' WHEN longitude < -58.1 THEN 'Shortland'
       WHEN longitude >= -58.1 THEN 'Haldimand' ELSE '??' END AS location,
  CASE WHEN sex = 'FemaleJ' AND biopsy = 'YES' THEN 'Female' WHEN sex = 'MaleM' AND biopsy = 'YES' THEN 'Male' END AS genetic_sex
FROM (
  SELECT photo_seq, file_name, title AS id_original,
    CASE WHEN regexp_full_match(title, '[0-9]+') THEN CAST(CAST(title AS BIGINT) AS VARCHAR) END AS id,
    date_original, TRY_CAST(substr(date_original, 1, 10) AS DATE) AS date, keyword_export AS keyword,
    CASE WHEN keyword_export LIKE '%Left%' OR keyword_export LIKE '%left%' THEN 'Left'
         WHEN keyword_export LIKE '%Right%' OR keyword_export LIKE '%right%' THEN 'Right' ELSE 'UNK' END AS side,
    CASE length(rating) - length(replace(rating, '*', '')) WHEN 4 THEN 4 WHEN 3 THEN 3 WHEN 2 THEN 2 WHEN 1 THEN 1 END AS qrate,
    CASE WHEN keyword_export LIKE '%Indent%' OR keyword_export LIKE '%Notch%' THEN 'Yes' ELSE 'No' END AS reliable,
    CASE WHEN keyword_export LIKE '%biopsy%' THEN 'YES' END AS biopsy,
    TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
    CASE WHEN contains(keyword_export, 'Melon_F,') OR contains(keyword_export, 'biopsy-Female') THEN 'FemaleJ'
         WHEN contains(keyword_export, 'Melon_M,') OR contains(keyword_export, 'biopsy-Male') THEN 'MaleM'
         WHEN contains(keyword_export, 'Melon_UNK') THEN 'UNK' END AS sex,
    CASE WHEN contains(keyword_export, 'Melon_F,') THEN 'FemaleJ' WHEN contains(keyword_export, 'Melon_M,') THEN 'MaleM' ELSE 'UNK' END AS melon_sex
  FROM listing)
""",
)

cte("base", "SELECT * FROM derived WHERE side <> 'UNK' AND id IS NOT NULL")

cte(
    "final",
    """
SELECT * REPLACE (coalesce(best, 'UNK') AS sex, any_biopsy AS biopsy),
  coalesce(CASE WHEN best = 'FemaleJ' AND any_biopsy = 'YES' THEN 'Female'
                WHEN best = 'MaleM' AND any_biopsy = 'YES' THEN 'Male' END, 'UNK') AS sex_genetic,
  id || '-' || upper(side) AS id_side
FROM (
  SELECT *,
    CASE WHEN bool_or(sex = 'MaleM') OVER (PARTITION BY id) THEN 'MaleM'
         WHEN bool_or(sex = 'FemaleJ') OVER (PARTITION BY id) THEN 'FemaleJ'
         WHEN bool_or(sex = 'UNK') OVER (PARTITION BY id) THEN 'UNK' END AS best,
    max(biopsy) OVER (PARTITION BY id) AS any_biopsy,
    CASE WHEN count(*) OVER s = count(date) OVER s THEN year(max(date) OVER s) - year(min(date) OVER s) + 1 END AS animal_yrs
  FROM base WINDOW s AS (PARTITION BY id, side))
""",
)

cte(
    "melon",
    """
SELECT *, sex AS sex_from_sum FROM (
  SELECT photo_seq, file_name, title AS id, CAST(substr(file_name, 5, 4) AS INTEGER) AS year, keyword_export AS keyword,
    'Melon' AS photo_type,
    CASE WHEN contains(keyword_export, 'Sum_F') THEN 'FemaleJ' WHEN contains(keyword_export, 'Sum_M') THEN 'MaleM'
         WHEN contains(keyword_export, 'Sum_UNK') THEN 'UNK' END AS sex,
    CASE WHEN contains(keyword_export, 'Melon_F') THEN 'FemaleJ' WHEN contains(keyword_export, 'Melon_M') THEN 'MaleM'
         WHEN contains(keyword_export, 'Melon_UNK') THEN 'UNK' END AS sex_from_melon
  FROM listing WHERE NOT contains(lower(keyword_export), 'dorsal'))
""",
)

cte(
    "compared",
    """
SELECT *, n_melon_tagged > 0 AND n_sum_tagged > 0 AND melon_sex_values = sum_sex_values AS all_keywords_identical
FROM (
  SELECT id, count(sex_from_melon) AS n_melon_tagged, count(sex_from_sum) AS n_sum_tagged,
    concat_ws(', ', CASE WHEN count(sex_from_melon) > 0 THEN 'Melon' END, CASE WHEN count(sex_from_sum) > 0 THEN 'Sum' END) AS keywords_present,
    (bool_or(sex_from_melon = 'FemaleJ') IS TRUE OR bool_or(sex_from_sum = 'FemaleJ') IS TRUE)
      AND (bool_or(sex_from_melon = 'MaleM') IS TRUE OR bool_or(sex_from_sum = 'MaleM') IS TRUE) AS inter_keyword_conflict,
    coalesce(string_agg(DISTINCT sex_from_melon, ' & ' ORDER BY sex_from_melon), '') AS melon_sex_values,
    coalesce(string_agg(DISTINCT sex_from_sum, ' & ' ORDER BY sex_from_sum), '') AS sum_sex_values
  FROM melon WHERE sex_from_melon IS NOT NULL OR sex_from_sum IS NOT NULL GROUP BY id)
""",
)

cte(
    "recent",
    """
SELECT id, max(year) AS most_recent_sex_year,
  min(year) FILTER (WHERE sex = 'FemaleJ') AS first_femalej_year,
  min(year) FILTER (WHERE sex = 'MaleM') AS first_malem_year,
  CASE count(DISTINCT sex) FILTER (WHERE year = last_y) WHEN 1 THEN min(sex) FILTER (WHERE year = last_y)
    ELSE CASE WHEN count(DISTINCT sex) FILTER (WHERE year = last_y AND sex <> 'UNK') = 1 THEN 'UNK_from_known' ELSE 'CONFLICT' END END AS current_sex
FROM (SELECT *, max(year) OVER (PARTITION BY id) AS last_y FROM melon WHERE sex IS NOT NULL) GROUP BY id
""",
)

cte(
    "summary",
    """
SELECT t.*, r.first_femalej_year, r.first_malem_year, r.most_recent_sex_year, r.current_sex,
  CASE WHEN r.id IS NOT NULL THEN coalesce(r.first_femalej_year < r.first_malem_year, false) END AS possible_maturation,
  c.keywords_present, c.inter_keyword_conflict, c.all_keywords_identical, c.melon_sex_values, c.sum_sex_values
FROM (
  SELECT id, count(*) AS n_photos_total, count(*) AS n_melon_photos, 0 AS n_dorsal_photos, 0 AS n_other_photos,
    count(sex) AS n_photos_with_sex, count(*) FILTER (WHERE sex = 'FemaleJ') AS n_femalej,
    count(*) FILTER (WHERE sex = 'MaleM') AS n_malem, count(*) FILTER (WHERE sex = 'UNK') AS n_unk,
    CASE WHEN count(*) FILTER (WHERE sex = 'FemaleJ') > count(*) FILTER (WHERE sex = 'MaleM') THEN 'FemaleJ'
         WHEN count(*) FILTER (WHERE sex = 'MaleM') > count(*) FILTER (WHERE sex = 'FemaleJ') THEN 'MaleM'
         WHEN count(*) FILTER (WHERE sex = 'FemaleJ') > 0 THEN 'CONFLICT' ELSE 'UNK' END AS primary_sex,
    min(year) AS first_year, max(year) AS last_year, max(year) - min(year) + 1 AS melon_age, 2025 - max(year) AS yrs_since_melon_age
  FROM melon GROUP BY id) t
LEFT JOIN recent r ON t.id = r.id LEFT JOIN compared c ON t.id = c.id
""",
)

cte(
    "flagged",
    """
SELECT *,
  CASE WHEN has_melon_f THEN 'Melon_F' WHEN has_melon_m THEN 'Melon_M' WHEN has_melon_unk THEN 'Melon_UNK' ELSE 'None' END AS current_sex,
  CASE WHEN has_f2 OR has_f3 OR has_femalej THEN 'Female' WHEN has_m2 OR has_m3 OR has_malem THEN 'Male' ELSE 'None' END AS old_keyword_sex,
  CASE WHEN has_sum_f THEN 'Sum_F' WHEN has_sum_m THEN 'Sum_M' WHEN has_sum_unk THEN 'Sum_UNK' ELSE 'None' END AS summary_sex,
  has_f2 OR has_f3 OR has_femalej OR has_sum_f AS female_words,
  has_m2 OR has_m3 OR has_malem OR has_sum_m AS male_words
FROM (
  SELECT photo_seq, file_name, title AS id, keyword_export AS keyword, CAST(substr(file_name, 5, 4) AS INTEGER) AS year,
    contains(keyword_export, 'Melon_F') AS has_melon_f, contains(keyword_export, 'Melon_M') AS has_melon_m,
    contains(keyword_export, 'Melon_UNK') AS has_melon_unk, contains(keyword_export, 'F2') AS has_f2,
    contains(keyword_export, 'F3') AS has_f3, contains(keyword_export, 'FemaleJ') AS has_femalej,
    contains(keyword_export, 'M2') AS has_m2, contains(keyword_export, 'M3') AS has_m3,
    contains(keyword_export, 'MaleM') AS has_malem, contains(keyword_export, 'Sum_F') AS has_sum_f,
    contains(keyword_export, 'Sum_M') AS has_sum_m, contains(keyword_export, 'Sum_UNK') AS has_sum_unk
  FROM listing)
""",
)

cte(
    "catalogue",
    """
SELECT photo_seq, file_name,
  CASE WHEN contains(lower(title), 'unk') OR contains(lower(title), 'see crops') THEN NULL ELSE title END AS id,
  TRY_CAST(substr(date_original, 1, 10) AS DATE) AS date, year(TRY_CAST(substr(date_original, 1, 10) AS DATE)) AS year,
  CASE WHEN contains(lower(keyword_export), 'left') THEN 'Left' WHEN contains(lower(keyword_export), 'right') THEN 'Right' ELSE 'UNK' END AS side,
  CASE WHEN contains(lower(keyword_export), 'biopsy') THEN 'YES' END AS biopsy,
  CASE WHEN regexp_matches(keyword_export, '\\bFemale-Juvenile\\b|\\bSex_F\\b|\\bFJ\\b') THEN 'FemaleJ'
       WHEN regexp_matches(keyword_export, '\\bSex_M\\b|\\bMM\\b') THEN 'MaleM' ELSE 'UNK' END AS sex,
  CASE WHEN regexp_matches(keyword_export, '\\bFemaleJ\\b') THEN 'FemaleJ'
       WHEN regexp_matches(keyword_export, '\\bMale\\b') THEN 'MaleM' ELSE 'UNK' END AS biopsy_sex,
  keyword_export AS keyword
FROM tagged
WHERE contains(lower(keyword_export), 'left') OR contains(lower(keyword_export), 'right')
""",
)

cte(
    "sighted",
    """
SELECT event_id, CAST(user_id AS VARCHAR) AS id, ts AS datetime,
  date_diff('microsecond', lag(ts) OVER w, ts) / CAST(60000000 AS DOUBLE) AS gap_minutes
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""",
)

cte(
    "encounters",
    """
SELECT *, count(*) FILTER (WHERE gap_minutes IS NULL OR gap_minutes > 30)
    OVER (PARTITION BY id ORDER BY datetime, event_id ROWS UNBOUNDED PRECEDING) AS encounter_id
FROM sighted
""",
)

cte(
    "per_day",
    """
SELECT id, CAST(datetime AS DATE) AS date, count(DISTINCT encounter_id) AS n_encounters
FROM encounters GROUP BY ALL
""",
)

cte(
    "auto",
    """
SELECT photo_seq, file_name AS filename, '/photos/' || file_name AS filepath_full,
  CASE WHEN date_original <> '' THEN substr(date_original, 1, 10) END AS exif_date,
  photo_seq % 89 = 0 AS bad,
  CASE WHEN photo_seq % 89 <> 0 THEN photo_seq % 31 <> 0 END AS cetacean_present,
  CASE WHEN photo_seq % 89 <> 0 THEN 'clear' END AS species_confidence,
  CASE WHEN photo_seq % 89 <> 0 THEN CASE WHEN photo_seq % 3 = 0 THEN 'dorsal_fin; melon' ELSE 'dorsal_fin' END END AS body_parts,
  CASE WHEN photo_seq % 89 <> 0 THEN photo_seq % 12 = 0 END AS multiple_whales,
  CAST(NULL AS BOOLEAN) AS non_cetacean_present, CAST(NULL AS VARCHAR) AS non_cetacean_note,
  CASE WHEN photo_seq % 89 <> 0 AND photo_seq % 23 <> 0 THEN (photo_seq % 8) // 2 + 1 END AS dorsal_q_rating,
  CASE WHEN photo_seq % 89 <> 0 THEN photo_seq % 14 = 0 END AS "borderline_Q3",
  CAST(NULL AS BOOLEAN) AS exposure_recoverable,
  CASE WHEN photo_seq % 89 <> 0 AND photo_seq % 18 <> 0 THEN photo_seq % 8 = 0 END AS trailing_edge_clear,
  CASE WHEN photo_seq % 89 <> 0 THEN photo_seq % 3 = 0 END AS melon_present,
  CASE WHEN photo_seq % 89 <> 0 THEN photo_seq % 22 = 0 END AS crop_recommended,
  CASE WHEN photo_seq % 89 = 0 THEN 'error_api_failure' WHEN photo_seq % 92 = 0 THEN 'error_no_folder'
       WHEN photo_seq % 23 = 0 THEN 'review_melon_only'
       ELSE CASE (photo_seq % 8) // 2 WHEN 3 THEN 'Q4_excellent' WHEN 2 THEN 'Q3_good' WHEN 1 THEN 'Q2_poor' ELSE 'Q1_reject' END END AS output_folder,
  CASE WHEN photo_seq % 89 = 0 THEN 'API call failed or response could not be parsed' ELSE 'note ' || photo_seq END AS rationale
FROM listing
""",
)

cte(
    "rated",
    """
SELECT *, lv_q IS NOT NULL AND pipe_q IS NOT NULL AS q_comparable, abs(lv_q - pipe_q) AS q_diff,
  lv_q = pipe_q AS q_agree, coalesce(lv_q <> pipe_q, false) AS q_flag,
  CASE WHEN lv_q = pipe_q THEN 'agree' WHEN pipe_q > lv_q THEN 'pipeline_higher' WHEN pipe_q < lv_q THEN 'pipeline_lower' END AS q_direction,
  coalesce(lv_q <> pipe_q, false) AS any_flag
FROM (
  SELECT lower(regexp_replace(a.filename, '\\.JPG$', '')) AS match_key,
    CASE WHEN m.photo_seq % 4 = 0 THEN upper(m.file_name) ELSE lower(m.file_name) END AS lv_filename_raw, m.qrate AS lv_q,
    m.year, m.location, m.reliable, a.filename AS pipe_filename_raw, a.dorsal_q_rating AS pipe_q,
    a.output_folder, a.trailing_edge_clear
  FROM auto a JOIN derived m ON a.photo_seq = m.photo_seq)
""",
)
