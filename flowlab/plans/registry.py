"""The catalogue of runnable queries and the SQL their results must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowlab.session import ship_package, use_utc
from flowlab.sources.tables import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)`` under ``name``, with equivalent SQL if any."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            ship_package(spark)
            return fn(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def with_views(*steps: str | tuple[str, str], then: str) -> str:
    """``WITH`` a base view or ``(name, select)`` steps, then a final select."""
    parts = []
    for step in steps:
        name, text = (step, SQL_VIEWS[step]) if isinstance(step, str) else step
        parts.append(f"{name} as (\n{text}\n)")
    return "with " + ",\n".join(parts) + "\n" + then
