"""Registered queries: each pairs a Spark callable with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its equivalent over the same tables."""
    def register(run: Query) -> Query:
        def with_utc(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, folder)

        QUERIES[name] = with_utc
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load() -> None:
    """Import every module that registers queries."""
    from tidemark.queries import documents, operations, rows, scalars, streams, tables, words  # noqa: F401
