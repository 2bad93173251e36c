"""All registered queries."""

from chartmill.catalog import basics, deltas, jobs, nested, relations, state  # noqa: F401
from chartmill.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
