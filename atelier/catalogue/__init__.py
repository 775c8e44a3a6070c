"""The operators as queries over the driver's tables, each with its SQL."""

from . import aggregates, joins, matching, places, texts  # noqa: F401  (they register their queries)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
