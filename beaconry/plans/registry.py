"""Named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beaconry.plans.bindings import Tables, with_views
from beaconry.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with the SQL that must give the same rows."""
    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return fn(Tables(tune(spark), root))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return wrap
