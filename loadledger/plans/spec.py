"""What to extract: one value per table, and how it becomes a read."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.functions.columns import parse_day
from loadledger.functions.windows import day_bounds, rows_between
from loadledger.operators.quality import is_blank, judged
from loadledger.sinks.ledger import SPEC_SCHEMA


@dataclass(frozen=True)
class TableSpec:
    """One table of one source, and which part of it a run should take.

    Without ``extraction_date`` the window is yesterday. ``split_on`` names an integer column for a
    parallel read of a big database table. Clear ``bootstrap`` when windows are filled in one by one
    and the first of them must not take the whole table. ``limit_seconds`` stands before the extractor's own.
    """

    source_name: str
    table_name: str
    schema_name: str | None = None
    incremental_column: str | None = None
    extraction_date: date | None = None
    is_full_extract: bool = False
    custom_query: str | None = None
    query_tables: tuple[str, ...] = ()
    run_id: str | None = None
    as_of: datetime | None = None
    window_hours: int = 24
    split_on: str | None = None
    bootstrap: bool = True
    limit_seconds: float | None = None

    @property
    def key(self) -> str:
        parts = (self.source_name, self.schema_name, self.table_name)
        return ".".join(part for part in parts if part)

    @property
    def day(self) -> date:
        return self.extraction_date or date.today() - timedelta(days=1)

    @property
    def window(self) -> tuple[datetime, datetime]:
        return day_bounds(self.day, self.window_hours)

    @property
    def is_windowed(self) -> bool:
        chosen = self.incremental_column and not self.custom_query
        return bool(chosen) and not self.is_full_extract

    def dated(self) -> TableSpec:
        """The same spec with its day fixed, so a run that passes midnight keeps its window."""
        return replace(self, extraction_date=self.day)

    def row(self) -> tuple:
        values = asdict(self)
        return tuple(values[name] for name in SPEC_SCHEMA.names)


def read_spec(source, spec: TableSpec, bootstrap: bool = False) -> DataFrame:
    """The rows a run should take, as a lazy read.

    A windowed spec that never succeeded before takes the whole table (``bootstrap``).
    """
    if spec.custom_query:
        return source.query(spec.custom_query, spec.query_tables)
    past = {"as_of": spec.as_of} if spec.as_of else {}
    if spec.split_on and hasattr(source, "ranged"):
        inside = (spec.incremental_column, *spec.window) if spec.is_windowed and not bootstrap else None
        rows = source.ranged(spec.table_name, spec.split_on, spec.schema_name, inside=inside, **past)
    else:
        rows = source.table(spec.table_name, spec.schema_name, **past)
    if spec.is_windowed and not bootstrap:
        return rows_between(rows, spec.incremental_column, *spec.window)
    return rows


def first_runs(specs: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Specs whose table never succeeded, for whatever window."""
    return specs.join(succeeded, "table_key", "left_anti")


SPEC_RULES = {
    "source_name is blank: name the source that the table is read from": "source_name",
    "table_name is blank: name the table to read": "table_name",
}


def spec_rules() -> dict:
    """Conditions under which a row of a spec table is unusable."""
    rules = {message: is_blank(F.col(name)) for message, name in SPEC_RULES.items()}
    full = F.coalesce("is_full_extract", F.lit(False)) | ~is_blank(F.col("custom_query"))
    unbounded = "incremental_column is blank, and the spec asks neither for the full table nor a query"
    rules[unbounded] = ~full & is_blank(F.col("incremental_column"))
    return rules


def load_specs(spark: SparkSession, path: str) -> tuple[list[TableSpec], DataFrame]:
    """Specs from a JSON array file: the usable ones, and the others with what is wrong with them."""
    kinds = (
        "source_name STRING, table_name STRING, schema_name STRING, incremental_column STRING, "
        "extraction_date STRING, is_full_extract BOOLEAN, custom_query STRING, run_id STRING"
    )
    listed = spark.read.schema(kinds).option("multiLine", True).json(path)
    parsed = parse_day(F.col("extraction_date"))
    rules = spec_rules()
    rules["extraction_date is not a date"] = F.col("extraction_date").isNotNull() & parsed.isNull()
    checked = judged(listed, rules)
    rows = checked.where("is_valid").withColumn("extraction_date", parsed).drop("violations", "is_valid").collect()
    return [
        TableSpec(**{k: v for k, v in row.asDict().items() if v is not None}) for row in rows
    ], checked.where("NOT is_valid").drop("is_valid")
