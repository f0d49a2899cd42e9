"""The queries of this subpackage, each with the SQL it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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


#: Rows and bytes that Python tasks get at once, unless the session says otherwise.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def bound_batches(spark: SparkSession) -> None:
    """Keep what Python tasks hold small: rows are whole texts, and Spark's defaults are for numbers.

    A setting made by the session's owner is left as it is.
    """
    known = spark._jsparkSession.conf()
    for name, value in _BATCH.items():
        if not known.contains(name):
            spark.conf.set(name, value)


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a standard table, and no others."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*[F.col(c) for c in columns])
