"""Named queries: a Spark plan and, where SQL can say it, the SQL to check it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its check SQL."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            CHECK_SQL[name] = sql.strip()
        return fn

    return wrap
