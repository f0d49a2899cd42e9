"""Column builders for keys, paths, run ids, durations and text dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status words of ledger rows.
STATUSES = ("pending", "running", "completed", "failed", "skipped", "retrying")
FINISHED = ("completed", "failed", "skipped")
STARTED = ("running", "retrying")
# The status words of whole runs, and those of a run log.
RUN_STATUSES = ("idle", "running", "completed", "failed", "paused", "cancelled")
RUN_ENDED = ("completed", "failed", "cancelled")
# Path beginnings that already name a storage system.
STORAGE_PREFIXES = ("s3://", "abfss://", "adl://", "gs://", "/dbfs/")


def table_key(source: Column, schema: Column, table: Column) -> Column:
    """``source.schema.table``, or ``source.table`` when the schema is NULL or empty."""
    return F.concat_ws(".", source, F.nullif(schema, F.lit("")), table)


def run_path(root: str, source: Column, table: Column, day: Column, run_id: Column) -> Column:
    """Where one run of one table for one business date is stored."""
    return F.concat_ws(
        "/",
        F.lit(root.rstrip("/")),
        source,
        table,
        F.date_format(day, "yyyyMM"),
        F.date_format(day, "dd"),
        F.concat(run_id, F.lit(".parquet")),
    )


def run_id_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end`` with microseconds kept; NULL when either is missing."""
    return micros_between(start, end) / F.lit(1e6)


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def is_finished(status: Column) -> Column:
    return status.isin(*FINISHED)


def is_running(status: Column) -> Column:
    """A retry in progress is running too."""
    return status.isin(*STARTED)


def is_run_over(status: Column) -> Column:
    """A paused run is not over: it may be taken up again."""
    return status.isin(*RUN_ENDED)


def iso_text(ts: Column) -> Column:
    """Date, time and all microseconds, in UTC; the session's zone has no part in it."""
    text = ts.cast("timestamp_ntz").cast("string")
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), micros, F.lit("Z"))


_ISO = r"^\s*(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6}\d*)?)?)(Z|[+-]\d{2}:?\d{2})?\s*$"


def parse_iso(text: Column) -> Column:
    """ISO date and time to an instant without a zone, in UTC; other text gives NULL.

    Text without an offset is taken as it stands. One with an offset, or Z, is shifted to UTC by it.
    Neither the session's zone nor the clock has a part in it.
    """
    local = F.concat_ws(" ", F.regexp_extract(text, _ISO, 1), F.regexp_extract(text, _ISO, 2))
    offset = F.regexp_extract(text, _ISO, 3)
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    signed = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
    shift = F.make_interval(mins=F.coalesce(signed, F.lit(0)))
    return F.when(text.rlike(_ISO), local.try_cast("timestamp_ntz") - shift)


def parse_day(text: Column) -> Column:
    """Year-month-day text to a date; other layouts and impossible dates give NULL.

    A cast tells impossible dates by a value, where a date pattern would raise and catch an error for
    every bad row. The pattern here only keeps out what a cast takes besides.
    """
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def storage_path(path: Column, mount: str = "/dbfs") -> Column:
    """Leave paths that name a storage system alone; hang all others below ``mount``."""
    named = F.lit(False)
    for prefix in STORAGE_PREFIXES:
        named = named | path.startswith(prefix)
    return F.when(named, path).otherwise(
        F.concat(F.lit(f"{mount.rstrip('/')}/"), F.regexp_replace(path, "^/", ""))
    )
