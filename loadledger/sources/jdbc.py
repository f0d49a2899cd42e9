"""Tables read from a database over JDBC."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

# Driver classes of the two databases.
ORACLE_DRIVER = "oracle.jdbc.driver.OracleDriver"
SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"

_PLAIN = re.compile(r"[A-Za-z][A-Za-z0-9_$#]*")

#: A window: its column, its start and the first instant after it.
Inside = tuple[str, datetime, datetime]


@dataclass(frozen=True)
class JdbcSource:
    """A database, and how hard to read it.

    ``numPartitions`` alone does not split a JDBC read, Spark also needs a column and bounds. So a
    parallel read goes through :meth:`ranged`, which asks the database for the bounds first. Every
    read names a table and leaves filters to the DataFrame: Spark pushes them, and the column list,
    into the statement in the dialect of the database.
    """

    spark: SparkSession
    url: str
    driver: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000
    partitions: int = 4
    quote: tuple[str, str] = ('"', '"')
    rows_per_partition: int = 5_000_000
    #: How the database marks a timestamp in its SQL, and how much of ours it takes.
    timestamp: str = "TIMESTAMP"
    stamp_length: int = 26

    @classmethod
    def oracle(cls, spark, host, port, service, user, password, **more) -> JdbcSource:
        url = f"jdbc:oracle:thin:@{host}:{port}:{service}"
        return cls(spark, url, ORACLE_DRIVER, {"user": user, "password": password}, **more)

    @classmethod
    def sql_server(cls, spark, host, port, database, user, password, **more) -> JdbcSource:
        url = f"jdbc:sqlserver://{host}:{port};databaseName={database}"
        login = {"user": user, "password": password}
        stamp = {"timestamp": "", "stamp_length": 23}
        return cls(spark, url, SQLSERVER_DRIVER, login, quote=("[", "]"), **{**stamp, **more})

    def options(self, **more: str) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            **self.properties,
            **more,
        }

    def quoted(self, name: str) -> str:
        """One identifier, safe to place in SQL text.

        A plain one stays bare, so that the database folds its case as it does in its own SQL; quoted,
        lower-case names of specs would not be found where names are kept in upper case.
        """
        if _PLAIN.fullmatch(name):
            return name
        left, right = self.quote
        return f"{left}{name.replace(right, right * 2)}{right}"

    def relation(self, name: str, schema: str | None = None, as_of: datetime | None = None) -> str:
        """The text for ``dbtable``. An as-of read is a derived table, as only it may carry the clause."""
        table = ".".join(self.quoted(part) for part in (schema, name) if part)
        if as_of is None:
            return table
        if self.driver != ORACLE_DRIVER:
            raise ValueError("only Oracle can read a table as of an earlier time")
        moment = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
        return f"(SELECT * FROM {table} AS OF TIMESTAMP TIMESTAMP '{moment}') past"

    def table(
        self, name: str, schema: str | None = None, as_of: datetime | None = None
    ) -> DataFrame:
        options = self.options(dbtable=self.relation(name, schema, as_of))
        return self.spark.read.format("jdbc").options(**options).load()

    def query(self, sql: str, tables: tuple[str, ...] = ()) -> DataFrame:
        """The caller's own SQL, run by the database; its tables need no binding here."""
        return self.spark.read.format("jdbc").options(**self.options(query=sql)).load()

    def ranged_options(
        self, relation: str, column: str, low, high, partitions: int | None = None
    ) -> dict[str, str]:
        """Bounds are whole numbers, dates or timestamps."""
        parts = partitions or self.partitions
        if not isinstance(low, date):
            low, high = int(low), int(high)
            parts = max(1, min(parts, high - low + 1))
            high += 1
        return self.options(
            dbtable=relation,
            partitionColumn=column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(parts),
        )

    def bounds_query(self, relation: str, column: str, inside: Inside | None = None) -> str:
        """What is asked before a ranged read: the bounds of the rows it will take, and their number."""
        key = self.quoted(column)
        asked = f"SELECT min({key}) AS low, max({key}) AS high, count(*) AS n FROM {relation}"
        if inside is None:
            return asked
        name, start, end = inside
        moment, stamp = self.quoted(name), "%Y-%m-%d %H:%M:%S.%f"
        low, high = (f"{self.timestamp} '{value.strftime(stamp)[: self.stamp_length]}'" for value in (start, end))
        return f"{asked} WHERE {moment} >= {low} AND {moment} < {high}"

    def parts_for(self, rows: int) -> int:
        """Ranges grow in number with the rows, never below what the source was given."""
        return max(self.partitions, -(-rows // self.rows_per_partition))

    def ranged(
        self,
        name: str,
        column: str,
        schema: str | None = None,
        as_of: datetime | None = None,
        inside: Inside | None = None,
    ) -> DataFrame:
        """One big table in parallel ranges of a number or date column, with no row left out.

        The bounds only place the cuts: Spark leaves the outer ranges open and adds NULL to the first.
        ``inside`` names a window (column, start, end) that the caller will cut out: the cuts then go
        by the keys inside it, and not all of a day's new keys fall into the last range.
        """
        relation = self.relation(name, schema, as_of)
        low, high, rows = self.query(self.bounds_query(relation, column, inside)).first()
        if low is None:
            return self.table(name, schema, as_of)
        options = self.ranged_options(relation, column, low, high, self.parts_for(int(rows)))
        return self.spark.read.format("jdbc").options(**options).load()
