"""Keyword tests. A pattern made only of literal alternatives becomes substring tests
(no regex engine per row); anything else becomes ``rlike``."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_LITERALS = re.compile(r"[\w ,\-]+(\|[\w ,\-]+)*")


def has(text: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """True when the text contains the pattern; null for null text."""
    text = F.col(text) if isinstance(text, str) else text
    if _LITERALS.fullmatch(pattern):
        if ignore_case:
            text, pattern = F.lower(text), pattern.lower()
        parts = [text.contains(p) for p in pattern.split("|")]
        return reduce(lambda a, b: a | b, parts)
    return text.rlike(("(?i)" if ignore_case else "") + pattern)


def flag(text: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """Never-null form of :func:`has`: null text does not match."""
    return F.coalesce(has(text, pattern, ignore_case), F.lit(False))


def first_match(
    text: Column | str,
    rules: Sequence[tuple[str, object]],
    otherwise: object = None,
    ignore_case: bool = False,
) -> Column:
    """Value of the first rule whose pattern is found, else ``otherwise``."""
    out = F
    for pattern, value in rules:
        out = out.when(has(text, pattern, ignore_case), F.lit(value))
    return out.otherwise(F.lit(otherwise))
