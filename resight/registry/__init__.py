"""All registered queries. Importing this package fills the registry."""

from resight.registry import ctes  # noqa: F401  (shared oracle tables first)
from resight.registry import scalars, grouped, products, files  # noqa: F401
from resight.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
