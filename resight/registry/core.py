"""Query registry: name -> Spark query, with the oracle SQL beside it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _needed(text: str, found: dict[str, None]) -> None:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(CTES[name], found)
            found[name] = None


def with_ctes(body: str) -> str:
    """Put the shared table expressions a query mentions in front of it."""
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body.strip()
    ordered = [n for n in CTES if n in found]
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + body.strip()


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = with_ctes(sql)
