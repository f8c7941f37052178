"""Text to dates and date-times. Every parse gives null on failure, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_DAY = r"^\s*(\d{4}-\d{1,2}-\d{1,2})"

# Day formats tried in this order; the pattern is anchored at the start, trailing text is ignored.
DAY_FORMATS = [
    (r"^\s*(\d{4}-\d{1,2}-\d{1,2})", "yyyy-M-d"),
    (r"^\s*(\d{1,2}/\d{1,2}/\d{4})", "M/d/yyyy"),
    (r"^\s*(\d{1,2}/\d{1,2}/\d{4})", "d/M/yyyy"),
    (r"^\s*(\d{4}/\d{1,2}/\d{1,2})", "yyyy/M/d"),
    (r"^\s*(\d{1,2}-\d{1,2}-\d{4})", "d-M-yyyy"),
    (r"^\s*(\d{1,2}-\d{1,2}-\d{4})", "M-d-yyyy"),
]
SPREADSHEET_DAY_ZERO = "1899-12-30"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _day(text: Column, pattern: str, fmt: str) -> Column:
    return F.try_to_date(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), fmt)


def listing_date(text: Column | str) -> Column:
    """Day at the start of 'yyyy-M-d ...', whatever follows.

    The plain cast reads nearly every row; only what it refuses goes through the pattern. A cast
    alone would also take a bare year or year and month, hence the test for both dashes.
    """
    text = _col(text)
    dashes = (F.substring(text, 5, 1) == "-") & F.locate("-", text, 6).between(7, 8)
    return F.coalesce(
        F.when(dashes, F.substring(text, 1, 10).try_cast("date")), _day(text, _ISO_DAY, "yyyy-M-d")
    )


def any_date(
    text: Column | str, formats: Sequence[tuple[str, str]] = DAY_FORMATS, serial: bool = True
) -> Column:
    """First format that works; five to seven digits alone are a spreadsheet serial day (a bare year is
    none). What is left is read in the orders of ``free_date``."""
    text = _col(text)
    parsed = [_day(text, pattern, fmt) for pattern, fmt in formats]
    if serial:
        days = F.when(text.rlike(r"^\s*\d{5,7}(\.\d+)?\s*$"), F.trim(text)).try_cast("double")
        days = F.when(days < 2958466, days)  # the last day a spreadsheet knows is 9999-12-31
        parsed.append(F.date_add(F.lit(SPREADSHEET_DAY_ZERO).cast("date"), F.floor(days).cast("int")))
        parsed.append(free_date(text))
    return F.coalesce(*parsed)


# Separated or compact spellings of the same orders; a month may be a name.
_FREE = [
    (r"^\s*(\d{4})[^0-9A-Za-z]+(\d{1,2}|[A-Za-z]{3,9})[^0-9A-Za-z]+(\d{1,2})(?!\d)", (1, 2, 3)),
    (r"^\s*(\d{4})(\d{2})(\d{2})(?!\d)", (1, 2, 3)),
    (r"^\s*(\d{1,2}|[A-Za-z]{3,9})[^0-9A-Za-z]+(\d{1,2})[^0-9A-Za-z]+(\d{4})(?!\d)", (3, 1, 2)),
    (r"^\s*(\d{2})(\d{2})(\d{4})(?!\d)", (3, 1, 2)),
    (r"^\s*(\d{1,2})[^0-9A-Za-z]*(\d{1,2}|[A-Za-z]{3,9})[^0-9A-Za-z]*(\d{4})(?!\d)", (3, 2, 1)),
]


def free_date(text: Column | str) -> Column:
    """Year-month-day, else month-day-year, else day-month-year, whatever separates the parts."""
    text = _col(text)
    out = []
    for pattern, (y, m, d) in _FREE:
        year, month, day = (F.regexp_extract(text, pattern, k) for k in (y, m, d))
        named = F.position(F.lower(F.substring(month, 1, 3)), F.lit("janfebmaraprmayjunjulaugsepoctnovdec"))
        number = F.when(month.rlike("[A-Za-z]"), F.when(named % 3 == 1, F.floor(named / 3 + 1).cast("string"))).otherwise(month)
        out.append(F.try_to_date(F.concat_ws("-", F.nullif(year, F.lit("")), number, day), "yyyy-M-d"))
    return F.coalesce(*out)


def day_month_first(text: Column | str) -> Column:
    """d/m/y, else m/d/y."""
    return any_date(text, [DAY_FORMATS[2], DAY_FORMATS[1]], serial=False)


def strip_hidden(text: Column | str) -> Column:
    """Drop every character that cannot be part of a date-time text."""
    return F.regexp_replace(text, r"[^0-9APM:/\- ]", "")


def datetime(text: Column | str) -> Column:
    """'yyyy-M-d h:m:s' as wall-clock time, null when it does not parse or lacks a part."""
    text = F.trim(_col(text))
    colons = F.length(text) - F.length(F.translate(text, ":", ""))
    return F.when(colons >= 2, text.try_cast("timestamp_ntz"))


def import_datetime(text: Column | str) -> Column:
    """Import sheets: AM/PM texts are month-first or year-first, the others year-first."""
    clean = F.translate(F.trim(strip_hidden(text)), "/", "-")
    spaced = F.regexp_replace(clean, r"\s*(AM|PM)", " $1")

    def first(formats: Sequence[str], value: Column) -> Column:
        return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])

    half_day = first(
        ["M-d-yyyy h:m:s a", "M-d-yyyy h:m a", "yyyy-M-d h:m:s a", "yyyy-M-d h:m a"], spaced
    )
    full_day = first(["yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d"], clean)
    return F.when(clean.rlike("AM|PM"), half_day).otherwise(full_day).cast("timestamp_ntz")


def year_in_text(text: Column | str) -> Column:
    """First run of four digits, as a year."""
    return F.regexp_substr(text, F.lit(r"\d{4}")).try_cast("int")


def year_tag(keyword: Column | str, years: Sequence[int]) -> Column:
    """First of the listed years that occurs in the keyword."""
    return F.regexp_substr(keyword, F.lit("|".join(str(y) for y in years))).try_cast("int")


def exif_day(*tags: Column | str) -> Column:
    """ISO day text of the first tag that is set ('yyyy:MM:dd ...')."""
    return F.translate(F.substring(F.coalesce(*[_col(t) for t in tags]), 1, 10), ":", "-")


def years_between(first: Column, last: Column) -> Column:
    return F.datediff(last, first) / F.lit(365.25)


def year_span(first_year: Column, last_year: Column, inclusive: bool = True) -> Column:
    return last_year - first_year + F.lit(1 if inclusive else 0)


def wall_micros(ts: Column | str) -> Column:
    """Microseconds of the wall-clock time, free of time zones and daylight-saving jumps."""
    ts = _col(ts)
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")
