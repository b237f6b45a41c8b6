"""All queries and their SQL."""

from workload import basics, jobs  # noqa: F401  (importing registers the queries)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
