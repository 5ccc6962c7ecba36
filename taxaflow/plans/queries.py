"""All queries of the library's own operators."""

from taxaflow.plans import composite_queries, geometry_queries, kernel_queries, linkage_queries, record_queries, summary_queries  # noqa: F401  they register their queries
from taxaflow.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
