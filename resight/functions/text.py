"""File names, links and report cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column | str) -> Column:
    return F.regexp_replace(base_name(path), r"\.[A-Za-z0-9]+$", "")


def extension(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(base_name(path), r"\.([A-Za-z0-9]+)$", 1))


def match_key(path: Column | str) -> Column:
    """Base name without extension, trimmed, lower case."""
    return F.lower(F.trim(stem(path)))


def path_name(path: Column | str) -> Column:
    """A path without scheme and extension as one name: folders are joined by two underscores."""
    bare = F.regexp_replace(F.regexp_replace(_col(path), r"^[A-Za-z0-9]+:", ""), r"^/+|\.[^./]*$", "")
    return F.regexp_replace(bare, "/+", "__")


def rename_key(path: Column | str) -> Column:
    """Stem without a trailing '-<number>'."""
    return F.regexp_replace(stem(F.trim(_col(path))), r"-[0-9]+$", "")


def lower_jpg(name: Column | str) -> Column:
    return F.regexp_replace(name, r"\.JPG$", ".jpg")


def with_suffix(name: Column | str, suffix: str) -> Column:
    """Put a suffix before the extension; a name without extension is only extended."""
    dotted = F.regexp_extract(base_name(name), r"(\.[A-Za-z0-9]+)$", 1)
    return F.concat(stem(name), F.lit(suffix), dotted)


def link(base_url: str, id_col: Column | str) -> Column:
    return F.concat(F.lit(base_url), _col(id_col))


def hyperlink_formula(url: Column | str) -> Column:
    return F.concat(F.lit('=HYPERLINK("'), _col(url), F.lit('","'), _col(url), F.lit('")'))


def decorated_id(id_col: Column | str, is_new: Column) -> Column:
    """New individuals are wrapped in a coloured span for plot labels."""
    id_col = _col(id_col)
    return F.when(
        is_new, F.concat(F.lit("<span style='color:firebrick;'>"), id_col, F.lit("</span>"))
    ).otherwise(id_col)


def report_cells(df: DataFrame, dash: str = "—") -> DataFrame:
    """Every column as text, null as a dash."""
    return df.select(
        [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(dash)).alias(c) for c in df.columns]
    )
