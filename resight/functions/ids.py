"""Identifier columns: canonical numbers, placeholders, remaps, composite keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from resight.functions.match import has

_PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def canonical_id(text: Column | str) -> Column:
    """Plain number as text without padding ('0560' -> '560'); anything else is null.

    Exponent and hex spellings count as non-numeric. Numbers too long for a decimal are shortened as text.
    """
    text = F.col(text) if isinstance(text, str) else text
    # Whole numbers, nearly all rows, take the cast; the pattern sees only what is left.
    plain = text.try_cast("bigint").cast("string")
    number = F.when(text.rlike(_PLAIN_NUMBER), F.trim(text)).try_cast("decimal(38,10)")
    whole = F.floor(number)
    other = F.when(number == whole, whole.cast("string")).otherwise(
        F.regexp_replace(number.cast("string"), r"0+$", "")
    )
    bare = F.regexp_replace(F.trim(text), r"^\+?(-?)0*(?=\d)", "$1")
    long = F.when(text.rlike(_PLAIN_NUMBER), F.when(bare.contains("."), F.regexp_replace(bare, r"\.?0*$", "")).otherwise(bare))
    return F.coalesce(plain, other, long)


def id_number(text: Column | str) -> Column:
    """Numeric sort key of an identifier, null when it is not a whole number."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.try_cast("bigint"), canonical_id(text).try_cast("bigint"))


def null_placeholder(
    text: Column | str, pattern: str = "unk|see crops", ignore_case: bool = True
) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.when(has(text, pattern, ignore_case), F.lit(None)).otherwise(text)


def remap(text: Column | str, values: Mapping[str, str]) -> Column:
    """Replace listed values, keep the rest. For long lists use a corrections table."""
    text = F.col(text) if isinstance(text, str) else text
    out = F
    for old, new in values.items():
        out = out.when(text == old, F.lit(new))
    return out.otherwise(text)


def remap_containing(text: Column | str, values: Mapping[str, str]) -> Column:
    """Older variant: the whole value is replaced when it contains the listed text."""
    text = F.col(text) if isinstance(text, str) else text
    out = F
    for old, new in values.items():
        out = out.when(has(text, old), F.lit(new))
    return out.otherwise(text)


def id_side(id_col: Column | str, side_col: Column | str) -> Column:
    """'<id>-LEFT' or '<id>-RIGHT'; a null ID gives null, not a key named after null."""
    return F.concat(id_col, F.lit("-"), F.upper(side_col))
