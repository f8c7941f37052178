"""Queries that write the derived inputs to the shared scratch folder and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from resight.functions.text import base_name
from resight.plans import exports, imports, rating_runs
from resight.registry import products as pr
from resight.registry.core import register
from resight.registry.grouped import base, final
from resight.registry.scalars import compared
from resight.session import scratch_dir
from resight.sources import driver, incremental, readers, sheets, writers

LISTING = ["photo_seq", *[readers.snake(c) for c in readers.LISTING_COLUMNS]]


def fresh(spark, name):
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


NULLED = """SELECT CAST(photo_seq AS VARCHAR) AS photo_seq, nullif(file_name, '') AS file_name, nullif(title, '') AS title,
    nullif(date_original, '') AS date_original, nullif(keyword_export, '') AS keyword_export, nullif(rtrim(rating), '') AS rating,
    nullif(latitude, '') AS latitude, nullif(longitude, '') AS longitude FROM listing"""


def _published(spark, d):
    rating = F.rtrim("rating").alias("rating")
    return driver.listing(spark, d).select(
        F.col("photo_seq").cast("string").alias("photo_seq"), "file_name", "title", "date_original", "keyword_export",
        rating, "latitude", "longitude",
    )


def _listing_csv(spark, d):
    path = writers.write_csv(
        _published(spark, d).toDF("photo_seq", *readers.LISTING_COLUMNS), fresh(spark, "listing"), "list_view", "v1"
    )
    return readers.read_listing(spark, path, ["photo_seq", *readers.LISTING_COLUMNS])


register("s1_listing_scan", _listing_csv, NULLED)


def _folders(spark, d):
    """Listing cut into three nested folders; the last lacks longitudes."""
    root = fresh(spark, "imports")
    rows = _published(spark, d)
    part = F.col("photo_seq").cast("bigint") % 3
    full = ["File name", "Latitude", "Longitude", "Date Original"]
    columns = ["file_name", "latitude", "longitude", "date_original"]
    for i in range(2):
        rows.filter(part == i).select(*columns).toDF(*full).write.option("header", True).option("nullValue", "NA").csv(
            f"{root}/full/year/part{i}"
        )
    short = [c for c in columns if c != "longitude"]
    rows.filter(part == 2).select(*short).toDF("File.name", "Latitude", "Date Original").write.option("header", True).option(
        "nullValue", "NA"
    ).csv(f"{root}/short/part2")
    sheets = {tuple(full): f"{root}/full", ("File.name", "Latitude", "Date Original"): f"{root}/short"}
    return readers.read_import_sheets(spark, sheets, imports.REQUIRED)


register(
    "s2_nested_folder_scan",
    lambda spark, d: _folders(spark, d).select("file_name", "latitude", "longitude", "date_original", F.col("source_file").isNotNull().alias("has_source")),
    """SELECT file_name, nullif(latitude, '') AS latitude, CASE WHEN photo_seq % 3 <> 2 THEN nullif(longitude, '') END AS longitude,
    nullif(date_original, '') AS date_original, true AS has_source FROM listing""",
)

def _write_lines(df, path, names, mode="error"):
    """CSV of plain values without any quoting, so that a comma in a value makes a field of its own."""
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("NA")) for c in df.columns])
    df.select(line.alias(",".join(names))).write.mode(mode).option("header", True).option("sep", "\x01").csv(path)


BROKEN = b"\x1f\x8b\x08\x00 not a compressed sheet"


def _sheets(spark, d):
    """As :func:`_folders`, with a field too many in every 97th line of the second folder, and a file that cannot be
    read."""
    root = fresh(spark, "sheets")
    rows = _published(spark, d).withColumn("n", F.col("photo_seq").cast("bigint"))
    surplus = F.when(F.col("n") % 97 == 0, F.concat(F.coalesce("date_original", F.lit("")), F.lit(",more"))).otherwise(F.col("date_original"))
    out = rows.withColumn("date_original", F.when(F.col("n") % 3 == 1, surplus).otherwise(F.col("date_original")))
    full = ["File name", "Latitude", "Longitude", "Date Original"]
    for i, names in enumerate((full, full, ["Latitude", "File.name", "Date.Original"])):
        columns = [readers.snake(c) for c in names]
        _write_lines(out.filter(F.col("n") % 3 == i).select(*columns), f"{root}/year/part{i}", names)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/broken/part3.csv.gz")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(BROKEN))
    stream.close()
    return sheets.read_sheets(spark, root, imports.REQUIRED)


def _per_folder(spark, d):
    found = sheets.file_status(_sheets(spark, d)).withColumn("folder", F.regexp_extract("source_file", "(part[0-9])[^a-z]", 1))
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_bad", "n_unnamed")]
    return found.groupBy("folder", "state").agg(*sums)


register(
    "q5_file_status",
    _per_folder,
    """SELECT 'part' || photo_seq % 3 AS folder, 'read' AS state, count(*) AS n_rows, count(*) FILTER (photo_seq % 3 = 1 AND photo_seq % 97 = 0) AS n_bad,
    count(*) FILTER (coalesce(file_name, '') = '') AS n_unnamed FROM listing GROUP BY 1 UNION ALL SELECT 'part3', 'unreadable', 0, 0, 0""",
)
register(
    "s2_sheets_by_header",
    lambda spark, d: _sheets(spark, d).rows.select(*imports.REQUIRED, F.col("bad_record").isNotNull().alias("bad")),
    """SELECT nullif(file_name, '') AS file_name, nullif(latitude, '') AS latitude, CASE WHEN photo_seq % 3 <> 2 THEN nullif(longitude, '') END AS longitude,
    nullif(date_original, '') AS date_original, photo_seq % 3 = 1 AND photo_seq % 97 = 0 AS bad FROM listing""",
)
register(
    "d33_bad_lines",
    lambda spark, d: sheets.bad_records(_sheets(spark, d)).select("bad_record"),
    """SELECT concat_ws(',', coalesce(file_name, 'NA'), coalesce(latitude, 'NA'), coalesce(longitude, 'NA'), coalesce(date_original, '') || ',more') AS bad_record
    FROM listing WHERE photo_seq % 3 = 1 AND photo_seq % 97 = 0""",
)


def _per_file(spark, d):
    """Encounters of each sheet written to a folder of its own, and read back with the sheet they come from."""
    rows = imports.to_encounters(_sheets(spark, d).rows, {"encounter_genus": "Hyperoodon"})
    per_file, _ = writers.write_per_source(rows, fresh(spark, "encounters"))
    schema = (
        "encounter_media_asset0 string, encounter_genus string, encounter_decimal_latitude double, "
        "encounter_decimal_longitude double, encounter_year int, encounter_month int, encounter_day int, source string"
    )
    back = spark.read.csv(per_file, schema=schema, header=True)
    return back.withColumn("source", F.regexp_extract("source", "(part[0-9])[^a-z]", 1))


register(
    "d33_per_file",
    _per_file,
    """SELECT replace(file_name, '.JPG', '.jpg') AS encounter_media_asset0, 'Hyperoodon' AS encounter_genus, latitude AS encounter_decimal_latitude,
    CASE WHEN photo_seq % 3 <> 2 THEN longitude END AS encounter_decimal_longitude, year AS encounter_year, month(date) AS encounter_month,
    day(date) AS encounter_day, 'part' || photo_seq % 3 AS source FROM derived""",
)


def _broken_lines(spark, d):
    """Listing with line breaks in every fifth title and a field too many in every 97th record."""
    rows = _published(spark, d).withColumn("n", F.col("photo_seq").cast("bigint"))
    columns = ["photo_seq", *readers.LISTING_COLUMNS]
    title = F.when(F.col("n") % 5 == 0, F.concat(F.coalesce("title", F.lit("")), F.lit('\nsays "second, line"'))).otherwise(F.col("title"))
    good = rows.filter("n % 97 <> 0").withColumn("title", title).drop("n").toDF(*columns)
    path = writers.write_csv(good, fresh(spark, "listing"), "list_view", "v1")
    longitude = F.concat(F.coalesce("longitude", F.lit("")), F.lit(",more"))
    fields = {c: F.lit("x") for c in map(readers.snake, readers.LISTING_COLUMNS)} | {"title": F.lit("t"), "longitude": longitude}
    bad = rows.filter("n % 97 = 0").select("photo_seq", *[v.alias(c) for c, v in fields.items()])
    _write_lines(bad, path, columns, "append")
    return readers.read_listing(spark, path, columns, multi_line=True, bad_records=True)


register(
    "s1_bad_records",
    lambda spark, d: _broken_lines(spark, d).select("photo_seq", "title", "longitude", F.col("bad_record").isNotNull().alias("bad")),
    """SELECT CAST(photo_seq AS VARCHAR) AS photo_seq, CASE WHEN photo_seq % 97 = 0 THEN 't' WHEN photo_seq % 5 = 0
    THEN coalesce(title, '') || chr(10) || 'says "second, line"' ELSE nullif(title, '') END AS title, nullif(longitude, '') AS longitude,
    photo_seq % 97 = 0 AS bad FROM listing""",
)


def _typed(spark, d):
    parsed = rating_runs.parse_ratings(driver.auto_responses(spark, d)).select(
        "filename", "exif_date", "cetacean_present", "dorsal_q_rating", "output_folder"
    )
    path = writers.write_csv(parsed, fresh(spark, "ratings"), "results", "v1")
    return readers.read_typed_csv(
        spark, path, "filename string, exif_date date, cetacean_present boolean, dorsal_q_rating int, output_folder string"
    )


register(
    "s3_typed_scan",
    _typed,
    "SELECT filename, CAST(exif_date AS DATE) AS exif_date, cetacean_present, dorsal_q_rating, output_folder FROM auto",
)


def _json(spark, d):
    path = fresh(spark, "encounters")
    driver.encounter_documents(spark, d).write.text(path)
    return readers.read_encounter_json(spark, path)


register(
    "s4_nested_json_scan",
    lambda spark, d: _json(spark, d).withColumnsRenamed(
        {"occurrenceId": "occurrence_id", "numberMediaAssets": "number_media_assets"}
    ),
    """SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(event_id AS VARCHAR) AS id, 'occ-' || user_id AS occurrence_id,
    event_id % 7 AS number_media_assets, 'team ' || event_type AS submitter_display_name FROM events""",
)


def _snapshot(spark, d):
    path = fresh(spark, "snapshot")
    writers.write_snapshot(base(spark, d), path, ["year"])
    return writers.read_snapshot(spark, path).select("photo_seq", "id", "date", "side", "sex", "year")


register(
    "s5_snapshot_by_year",
    _snapshot,
    "SELECT photo_seq, id, date, side, sex, year FROM base",
)


def _export(spark, d):
    path = writers.write_csv(
        base(spark, d).select("id", "date", "side", "sex", "qrate"), fresh(spark, "exports"), "simple", "2025_01"
    )
    return readers.read_typed_csv(spark, path, "id string, date date, side string, sex string, qrate int")


register("s6_csv_export", _export, "SELECT id, date, side, sex, qrate FROM base")


def _export_order(spark, d):
    """The rating comparison written in its export order, and read back with row numbers."""
    columns = ["match_key", "lv_q", "pipe_q", "q_diff", "any_flag", "pipe_filename_raw"]
    rows = compared(spark, d).select(*columns)
    path = writers.write_ordered(rows, fresh(spark, "comparison"), "comparison", "v1", rating_runs.export_order())
    schema = "match_key string, lv_q int, pipe_q int, q_diff int, any_flag boolean, pipe_filename_raw string"
    return writers.read_ordered(spark, path, schema).drop("pipe_filename_raw")


register(
    "d37_export_order",
    _export_order,
    """SELECT row_number() OVER (ORDER BY any_flag DESC NULLS LAST, q_diff DESC NULLS LAST, match_key, pipe_filename_raw) AS row_no,
    match_key, lv_q, pipe_q, q_diff, any_flag FROM rated""",
)
register(
    "o1_ordered_export",
    lambda spark, d: writers.read_ordered(
        spark,
        writers.write_ordered(
            base(spark, d).select("id", "date", "photo_seq"), fresh(spark, "ordered"), "by_id", "v1",
            [F.col("id").asc_nulls_last(), F.col("date").asc_nulls_last(), F.col("photo_seq")],
        ),
        "id string, date date, photo_seq bigint",
    ),
    "SELECT row_number() OVER (ORDER BY id NULLS LAST, date NULLS LAST, photo_seq) AS row_no, id, date, photo_seq FROM base",
)


def _exports(spark, d):
    """Every export written, read back and counted."""
    paths = exports.write_exports(final(spark, d), "2025_01", fresh(spark, "analysis"))
    parts = [
        spark.read.csv(path, header=True).agg(F.lit(name).alias("export"), F.count(F.lit(1)).alias("n_rows"))
        for name, path in paths.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


register(
    "g5_write_exports",
    _exports,
    """SELECT 'id_sex_primary_yrs' AS export, count(DISTINCT id_side) AS n_rows FROM final
    UNION ALL SELECT 'id_sex_master', count(DISTINCT id_side) FROM final UNION ALL SELECT 'social_photos', count(*) FROM final
    UNION ALL SELECT 'social_supplement', count(DISTINCT id) FROM final UNION ALL SELECT 'simple_photos', count(*) FROM final""",
)


def _export_contents(spark, d):
    """Every column of every export read back: values that are there, and different ones."""
    paths = exports.write_exports(final(spark, d), "2025_01", fresh(spark, "analysis"))
    out = None
    for name, path in paths.items():
        rows = spark.read.csv(path, header=True, nullValue="NA")
        named = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in rows.columns])).alias("c")
        part = rows.select(F.lit(name).alias("export"), named).groupBy("export", F.col("c.name").alias("column")).agg(
            F.count("c.value").alias("n_values"), F.count_distinct("c.value").alias("n_different"), F.min("c.value").alias("least")
        )
        out = part if out is None else out.unionByName(part)
    return out


def _content_sql(name, table, columns):
    """Columns of an export (published name: SQL) counted as :func:`_export_contents` does."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS export, '{c}' AS "column", count(v) AS n_values, count(DISTINCT v) AS n_different, min(v) AS least
        FROM (SELECT CAST({sql} AS VARCHAR) AS v FROM {table})"""
        for c, sql in columns.items()
    )


_YES = "CASE WHEN reliable THEN 'true' ELSE 'false' END"
register(
    "g5_export_contents",
    _export_contents,
    " UNION ALL ".join(
        [
            _content_sql("id_sex_primary_yrs", f"({pr.PRIMARY})", dict(zip(exports.PRIMARY, ["id_numeric", "id_side", "melon_sex", "sex_genetic", "year1", "yearlast", "animal_yrs", "n_photos"], strict=True))),
            _content_sql("id_sex_master", f"({pr.MASTER})", dict(zip(exports.MASTER, ["id", "id_side", "sex", "sex_genetic", "year1", "yearlast", "animal_yrs", "n"], strict=True))),
            _content_sql("social_photos", "final", dict(zip(exports.SOCIAL, ["qrate", "date", "date_original", "location", "latitude", "longitude", "side", "reliable", "sex", "id"], strict=True))),
            _content_sql("social_supplement", f"({pr.SUPPLEMENT})", dict(zip(exports.SUPPLEMENT, ["id", "sex", _YES], strict=True))),
            _content_sql("simple_photos", "final", dict(zip(exports.SIMPLE, ["id_side", "qrate", "date", "location", "reliable", "sex", "id"], strict=True))),
        ]
    ),
)


def _renamed(spark, d):
    rows = imports.renamed_export(_published(spark, d), {"file_name": "encounter_media_asset0", "title": "name0_value"})
    path = writers.write_csv(rows.select("photo_seq", "encounter_media_asset0", "name0_value", "rating"), fresh(spark, "renamed"), "export", "v1")
    return spark.read.csv(path, header=True, nullValue="NA", ignoreTrailingWhiteSpace=True)


register(
    "d35_renamed_export_file",
    _renamed,
    """SELECT CAST(photo_seq AS VARCHAR) AS photo_seq, file_name AS encounter_media_asset0, title AS name0_value, rtrim(rating) AS rating FROM listing""",
)


def _id_list(spark, d):
    path = fresh(spark, "ids")
    writers.write_ids(base(spark, d).select("id").distinct(), "id", path)
    return spark.read.text(path).select(F.col("value").alias("id"))


register("s7_id_list", _id_list, "SELECT DISTINCT id FROM base")


def _per_source(spark, d):
    rows = base(spark, d).select(
        "photo_seq", "side", F.concat(F.lit("/in/"), F.col("location"), F.lit(".csv")).alias("source_file")
    )
    per_file, compiled = writers.write_per_source(rows, fresh(spark, "per-source"))
    split = spark.read.csv(per_file, schema="photo_seq bigint, side string, source string", header=True)
    whole = spark.read.csv(compiled, schema="photo_seq bigint, side string", header=True)
    return split.groupBy("source", "side").agg(F.count(F.lit(1)).alias("n")).unionByName(
        whole.groupBy("side").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("compiled"))
    )


register(
    "s8_per_source_and_compiled",
    _per_source,
    """SELECT 'in__' || location AS source, side, count(*) AS n FROM base GROUP BY 1, 2 UNION ALL SELECT 'compiled', side, count(*) FROM base GROUP BY side""",
)


def _refreshed(spark, d):
    """Outputs of three sheets, then of the second written anew with other positions and of a fourth that is added."""
    root, folder = fresh(spark, "sources"), fresh(spark, "outputs")
    names = ["File name", "Latitude", "Date Original"]
    rows = _published(spark, d).withColumn("n", F.col("photo_seq").cast("bigint"))

    def write(part, latitude):
        some = rows.filter(F.col("n") % 4 == part).withColumn("latitude", latitude)
        _write_lines(some.select(*map(readers.snake, names)), f"{root}/part{part}", names, "overwrite")

    def read(after):
        found = sheets.read_sheets(spark, root, imports.REQUIRED, modified_after=after).rows
        return imports.to_encounters(found, {}).select("encounter_media_asset0", "encounter_decimal_latitude", "source_file")

    for part in range(3):
        write(part, F.col("latitude"))
    incremental.refresh(spark, root, folder, read, sheets.SHEETS)
    write(1, F.lit("1.5"))
    write(3, F.col("latitude"))
    return folder, incremental.refresh(spark, root, folder, read, sheets.SHEETS)


register(
    "s8_incremental_outputs",
    lambda spark, d: incremental.current(spark, _refreshed(spark, d)[0]).drop("source_file"),
    """SELECT encounter_media_asset0, CASE WHEN photo_seq % 4 = 1 THEN 1.5 ELSE latitude END AS encounter_decimal_latitude FROM
    (SELECT replace(file_name, '.JPG', '.jpg') AS encounter_media_asset0, latitude, photo_seq FROM derived)""",
)


def _refreshed_files(spark, d):
    """Folders whose files the second run found, and those it read."""
    folder, found = _refreshed(spark, d)
    part = F.regexp_extract("source_file", "(part[0-9])/", 1).alias("part")
    rows = incremental.current(spark, folder).groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))
    return found.select(part, "state").distinct().join(rows, "part")


register(
    "s8_incremental_states",
    _refreshed_files,
    """SELECT part, state, n_rows FROM (SELECT 'part' || photo_seq % 4 AS part, count(*) AS n_rows FROM derived GROUP BY 1)
    JOIN (VALUES ('part0', 'same'), ('part1', 'gone'), ('part1', 'new'), ('part2', 'same'), ('part3', 'new')) AS s(part, state) USING (part)""",
)


def _inventory(spark, d):
    """The files of a snapshot of the listing, by the year in their path."""
    path = fresh(spark, "inventory")
    writers.write_snapshot(base(spark, d), path, ["year"])
    files = readers.file_inventory(spark, path, ["parquet"])
    year = F.regexp_extract("path", "/year=([^/]*)/", 1)
    return files.groupBy(year.alias("year")).agg((F.min("length") > 0).alias("has_bytes"))


register(
    "s9_file_inventory",
    _inventory,
    "SELECT DISTINCT coalesce(CAST(year AS VARCHAR), '__HIVE_DEFAULT_PARTITION__') AS year, true AS has_bytes FROM base",
)
register(
    "d33_compiled_from_folders",
    lambda spark, d: imports.to_encounters(_folders(spark, d), pr.CONSTANTS).drop("source_file"),
    """SELECT encounter_media_asset0, encounter_genus, encounter_specific_epithet, encounter_location_id, encounter_submitter_id,
    encounter_decimal_latitude, CASE WHEN CAST(regexp_extract(encounter_media_asset0, '_([0-9]+)\\.jpg$', 1) AS BIGINT) % 3 <> 2 THEN encounter_decimal_longitude END AS encounter_decimal_longitude,
    encounter_year, encounter_month, encounter_day FROM (""" + pr.ENCOUNTERS + ")",
)
