"""All queries of this package and their SQL."""

from viewtide.llm import queries  # noqa: F401  (importing registers the queries)
from viewtide.llm.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
