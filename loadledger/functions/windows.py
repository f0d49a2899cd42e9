"""Extraction windows: half-open ranges that start at midnight."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_start(ts: Column) -> Column:
    """Midnight of the day ``ts`` falls in, without a time zone."""
    return F.to_date(ts).cast("timestamp_ntz")


def window_end(ts: Column, hours: int | Column = 24) -> Column:
    """First instant after the window that starts on the day of ``ts``."""
    length = F.lit(hours) if isinstance(hours, int) else hours
    return window_start(ts) + F.make_interval(hours=length)


def in_window(ts: Column, start: Column, end: Column) -> Column:
    return (ts >= start) & (ts < end)


def same_day(a: Column, b: Column) -> Column:
    """Whether two instants share a window; an unknown instant counts as current."""
    return F.coalesce(F.to_date(a) == F.to_date(b), F.lit(True))


def day_bounds(day: date, hours: int = 24) -> tuple[datetime, datetime]:
    """The window of one business date as plain values, for predicates and ledger rows."""
    start = datetime.combine(day, time.min)
    return start, start + timedelta(hours=hours)


def instant(value: datetime) -> Column:
    """A literal without a time zone; the session's zone never shifts it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def rows_between(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with ``start <= column < end``; NULL never qualifies.

    The literals take the column's own type, so no cast lands on the column and the comparison
    reaches the Parquet row groups or the database.
    """
    # Resolved as Spark resolves names, so the case of letters does not matter.
    kind = df.select(column).schema[0].dataType
    midnights = start.time() == time.min and end.time() == time.min
    if isinstance(kind, T.DateType) and midnights:
        low, high = F.lit(start.date()), F.lit(end.date())
    elif isinstance(kind, T.TimestampType):
        low, high = (instant(v).cast("timestamp") for v in (start, end))
    else:
        low, high = instant(start), instant(end)
    return df.where(in_window(F.col(column), low, high))
