"""Tables kept as files under one root."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from loadledger.sources.ranges import even_cuts, predicates_at


@dataclass(frozen=True)
class LakeSource:
    """Each table is ``<root>/<table>.parquet``, a file or a folder of files.

    A schema name selects a folder below the root. Reads are lazy, so filters and column lists added
    later reach the file scan.
    """

    spark: SparkSession
    root: str

    def table(
        self, name: str, schema: str | None = None, as_of: datetime | None = None
    ) -> DataFrame:
        if as_of is not None:
            raise ValueError("files keep no past; apply sources.asof.as_of to versioned rows")
        folder = f"{self.root.rstrip('/')}/{schema}" if schema else self.root.rstrip("/")
        return self.spark.read.parquet(f"{folder}/{name}.parquet")

    def in_ranges(self, name: str, column: str, parts: int, schema: str | None = None) -> list[DataFrame]:
        """A table as about ``parts`` reads with equal numbers of rows, by an integer column.

        Each is a filter that reaches the files, so it can be run, retried and sent elsewhere for itself.
        """
        rows = self.table(name, schema)
        return [rows.where(text) for text in predicates_at(column, even_cuts(rows, column, parts))]

    def query(self, sql: str, tables: tuple[str, ...] = ()) -> DataFrame:
        """The caller's own SQL over ``tables``, which are views of a session of this query alone."""
        own = self.spark.newSession()
        for name, value in self._settings():
            own.conf.set(name, value)
        for name in tables:
            LakeSource(own, self.root).table(name).createOrReplaceTempView(name)
        found = own.sql(sql)
        return DataFrame(found._jdf, self.spark)

    def _settings(self) -> list[tuple[str, str]]:
        """What the session says about the meaning of SQL, for the query to have the same."""
        names = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.caseSensitive")
        return [(name, self.spark.conf.get(name)) for name in names]
