"""Named queries over the test tables, each with the SQL that must give the same rows."""

from workloads import dashboard, funnel, helpers, quality  # noqa: F401  (fills the registry)
from workloads.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
