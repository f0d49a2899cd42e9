"""Reading stored runs back, with what their paths say about them."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadledger.functions.columns import parse_day, parse_iso, table_key
from loadledger.functions.common import common_schema, conforming
from loadledger.functions.windows import window_end, window_start


#: Stands between a run's id and its attempt in the name of a folder.
ATTEMPT = "~"


def read_runs(
    spark: SparkSession, root: str, schema: StructType | None = None, runs: DataFrame | None = None
) -> DataFrame:
    """Every row of every run below ``root``, with source, table, business date and run id.

    They are taken from the path, which functions.columns.run_path lays out as
    source/table/yyyyMM/dd/run.parquet/file. Give ``schema`` where it is known; else it is put
    together from those of all files, so that a column some runs lack is there. Where types or the
    case of names changed from run to run, give ``runs`` (``output_path``, ``schema_json``), such as
    transitions of the ledger: those below ``root`` are read, a scan for each schema, with common types.
    Every attempt that was stored is read; :meth:`Ledger.read` takes only those that count.
    """
    if runs is None:
        reader = spark.read.option("recursiveFileLookup", True)
        return _placed((reader.schema(schema) if schema else reader.option("mergeSchema", True)).parquet(root), None)
    known = runs.where(F.col("output_path").startswith(root.rstrip("/") + "/") & F.col("schema_json").isNotNull())
    rows = known.groupBy("schema_json").agg(F.collect_set("output_path").alias("found"), F.min("output_path").alias("first"))
    stored = [(StructType.fromJson(json.loads(row.schema_json)), sorted(row.found)) for row in rows.orderBy("first").collect()]
    if not stored:
        raise LookupError(f"no stored run below {root}")
    wanted = common_schema([kind for kind, _ in stored])
    scans = [_placed(spark.read.schema(kind).parquet(*found), wanted) for kind, found in stored]
    return reduce(DataFrame.unionByName, scans)


def _placed(rows: DataFrame, wanted: StructType | None) -> DataFrame:
    """Rows of stored runs, in a common schema if one is given, with what their paths say."""
    parts = F.split("_metadata.file_path", "/")

    def part(from_end: int) -> Column:
        return F.get(parts, F.size(parts) - from_end)

    month = part(4)
    day = F.concat_ws("-", F.substring(month, 1, 4), F.substring(month, 5, 2), part(3))
    return rows.select(
        *(conforming(rows, wanted) if wanted else ["*"]),
        part(6).alias("run_source"),
        part(5).alias("run_table"),
        day.try_cast("date").alias("business_date"),
        F.substring_index(F.substring_index(part(2), ".parquet", 1), ATTEMPT, 1).alias("run_id"),
    )


def read_sidecars(
    spark: SparkSession, root: str, pattern: str = "*_metadata.json", one_per_file: bool = True
) -> DataFrame:
    """JSON run descriptions kept beside their data, as ledger rows ready for ``Ledger.append``.

    Descriptions that do not say they are complete are left out. Files with one description per line
    can be split between tasks; say so by clearing ``one_per_file``.
    """
    shape = (
        "output_path STRING, record_count BIGINT, start_time STRING, end_time STRING, "
        "duration_seconds DOUBLE, file_size_bytes BIGINT, checksum STRING, "
        "extraction_complete BOOLEAN, table_config STRUCT<source_name STRING, table_name STRING, "
        "schema_name STRING, incremental_column STRING, extraction_date STRING, "
        "is_full_extract BOOLEAN, custom_query STRING, run_id STRING>"
    )
    found = (
        spark.read.schema(shape)
        .option("multiLine", one_per_file)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(root)
        .where("extraction_complete")
    )
    spec = F.col("table_config")
    day = _day(spec["extraction_date"])
    ended = parse_iso(F.col("end_time"))
    return found.select(
        _micros(ended).alias("seq"),
        table_key(spec["source_name"], spec["schema_name"], spec["table_name"]).alias("table_key"),
        F.to_date(day).alias("business_date"),
        window_start(day).alias("window_start"),
        window_end(day).alias("window_end"),
        ended.alias("event_ts"),
        F.lit("completed").alias("status"),
        spec["run_id"].alias("run_id"),
        "record_count",
        # What such files give as a size is that of a directory entry: not known.
        F.lit(None).cast("bigint").alias("file_size_bytes"),
        F.when(F.col("record_count") > 0, F.col("output_path")).alias("output_path"),
        "duration_seconds",
    )


def _day(text: Column) -> Column:
    """A date, with or without a time."""
    return F.coalesce(parse_iso(text), parse_day(text).cast("timestamp_ntz"))


def _micros(moment: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment)


def read_state_files(spark: SparkSession, root: str, pattern: str = "pipeline_*.json") -> DataFrame:
    """JSON state files of earlier runs, one per run with all its tables, as ledger rows."""
    shape = (
        "pipeline STRUCT<run_id STRING, extraction_date STRING>, "
        "extractions MAP<STRING, STRUCT<status STRING, run_id STRING, extraction_date STRING, "
        "start_time STRING, end_time STRING, record_count BIGINT, file_size_bytes BIGINT, "
        "output_path STRING, error_message STRING>>, metadata STRUCT<saved_at STRING>"
    )
    files = (
        spark.read.schema(shape)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(root)
    )
    states = files.select("pipeline", "metadata", F.explode("extractions").alias("table_key", "s"))
    day = _day(F.coalesce("s.extraction_date", "pipeline.extraction_date"))
    known = F.coalesce("s.end_time", "s.start_time", "metadata.saved_at")
    moment = parse_iso(known)
    return states.select(
        _micros(moment).alias("seq"),
        "table_key",
        F.to_date(day).alias("business_date"),
        window_start(day).alias("window_start"),
        window_end(day).alias("window_end"),
        moment.alias("event_ts"),
        "s.status",
        F.coalesce("s.run_id", "pipeline.run_id").alias("run_id"),
        "s.record_count",
        F.lit(None).cast("bigint").alias("file_size_bytes"),
        "s.output_path",
        "s.error_message",
    )


def list_files(spark: SparkSession, root: str | list[str], pattern: str = "*") -> DataFrame:
    """One row per file below ``root``: path, length and content.

    Content is only read when a later step asks for it; sizes come from the listing.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
