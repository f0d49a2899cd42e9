"""The named queries over the standard tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name. ``sql`` reads the same tables, by name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register
