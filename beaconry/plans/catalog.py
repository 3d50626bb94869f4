"""All registered queries."""

from beaconry.plans import feature_queries, messaging_queries, table_queries  # noqa: F401
from beaconry.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
