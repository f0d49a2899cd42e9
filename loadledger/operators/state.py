"""Ledger state as functions from DataFrames to DataFrames; nothing is changed in place."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.functions.columns import is_finished, is_running

ORDER = ("event_ts", "seq")


def fold(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    carried: Sequence[str] = ("record_count",),
    last: Sequence[str] = (),
    attempt: str | None = None,
) -> DataFrame:
    """Replay transitions to one state per key.

    Gives the last status, when the last start and the last end happened, and how often the key was
    started again: in all, or, where transitions number their ``attempt``, since it last succeeded or
    was sent back to the start, which both put 0. ``carried`` columns come from the last end, ``last`` columns from the last
    transition of any kind; text that is slow to parse is better carried and parsed afterwards. The
    first column of ``order`` is a timestamp, the others break its ties.

    It is one aggregate with map-side combining, so a long history of one key does not pile up in a
    task.
    """
    ts, moment = F.col(order[0]), F.struct(*order)
    status = F.col("status")
    ended = status.isin("completed", "failed")
    at_end = F.when(ended, moment)
    started_at = F.when(is_running(status), ts)
    starts = F.max_by(attempt, moment) if attempt else F.count_if(is_running(status))
    return log.groupBy(*keys).agg(
        F.max_by("status", moment).alias("status"),
        F.max(ts).alias("last_ts"),
        F.min(started_at).alias("first_start_ts"),
        F.max(started_at).alias("start_ts"),
        F.max(F.when(ended, ts)).alias("end_ts"),
        F.greatest(starts - 1, F.lit(0)).alias("retry_count"),
        *[F.max_by(name, at_end).alias(name) for name in carried],
        *[F.max_by(name, moment).alias(name) for name in last],
    )


def due_every_day(
    keys: DataFrame, first: str, last: date | Column, name: str = "business_date"
) -> DataFrame:
    """One requested row per key and day, from the key's own first day to ``last``."""
    until = last if isinstance(last, Column) else F.lit(last)
    days = F.sequence(F.col(first), until, F.make_interval(days=F.lit(1)))
    return keys.where(F.col(first) <= until).select(
        *[c for c in keys.columns if c not in (first, "last_day")], F.explode(days).alias(name)
    )


def pending(requested: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested rows with no finished successful state."""
    return requested.join(_settled(state, keys), list(keys), "left_anti")


def already_done(requested: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return requested.join(_settled(state, keys), list(keys), "left_semi")


def _settled(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.where(F.col("status").isin("completed", "skipped")).select(*keys)


def lookup(requested: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested rows with their state; NULL where the ledger knows nothing."""
    return requested.join(state, list(keys), "left")


def resume(state: DataFrame, requested: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Carry an interrupted attempt over: known states stay, new requests join as pending.

    A row that still says running belongs to an attempt that died, so it becomes pending.
    """
    status = F.col("status")
    reopened = state.select(
        *keys, F.when(is_running(status), F.lit("pending")).otherwise(status).alias("status")
    )
    new = requested.select(*keys).join(state, list(keys), "left_anti")
    return reopened.unionByName(new.withColumn("status", F.lit("pending")))


def todo(requested: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both work lists: with failed rows to retry, and without them (``include_failed``)."""
    known = requested.join(state.select(*keys, "status"), list(keys), "left")
    status = F.coalesce("status", F.lit("pending"))
    lists = F.when(status == "failed", F.array(F.lit(True))).otherwise(
        F.array(F.lit(True), F.lit(False))
    )
    return known.where(~status.isin("completed", "skipped")).select(
        *keys, F.explode(lists).alias("include_failed")
    )


def decide(
    rows: DataFrame,
    *,
    status: Column,
    forced: Column,
    verdict: Column,
    current: Column,
    retries: Column,
    max_retries: int = 3,
) -> DataFrame:
    """Add ``needed``, ``reason`` and ``next_status`` to requested rows joined with their state.

    ``verdict`` is the integrity verdict of the stored output and ``current`` says whether the state
    belongs to the requested window. Looking does not change anything: a caller that wants
    ``next_status`` recorded appends it to the ledger.
    """
    branches = [
        (status.isNull(), True, "unknown_key", F.lit("pending")),
        (forced, True, "forced", F.lit("pending")),
        (status == "skipped", False, "skipped", F.lit("skipped")),
        (~is_finished(status), True, "not_finished", F.lit("pending")),
        ((status == "failed") & (retries < max_retries), True, "retryable_failure", F.lit("pending")),
        (status == "failed", False, "retries_exhausted", F.lit("skipped")),
        (verdict.isin("missing", "no_data"), True, "output_missing", F.lit("pending")),
        (verdict != "valid", True, "output_corrupt", F.lit("pending")),
        (~current, True, "window_outdated", F.lit("pending")),
    ]

    def chain(position: int, otherwise: Column) -> Column:
        picked = F
        for branch in branches:
            value = branch[position]
            picked = picked.when(branch[0], value if isinstance(value, Column) else F.lit(value))
        return picked.otherwise(otherwise)

    return rows.withColumns(
        {
            "needed": chain(1, F.lit(False)),
            "reason": chain(2, F.lit("up_to_date")),
            "next_status": chain(3, status),
        }
    )


def after_failure(status: Column, retries: Column, max_retries: int = 3) -> Column:
    """A failed row is tried again while it has retries left, and skipped after that."""
    return (
        F.when((status == "failed") & (retries < max_retries), F.lit("pending"))
        .when(status == "failed", F.lit("skipped"))
        .otherwise(status)
    )


def force(state: DataFrame, chosen: Column) -> DataFrame:
    """Send chosen rows back to the start, with everything known about past attempts cleared."""
    fresh: dict[str, Column] = {"status": F.lit("pending"), "retry_count": F.lit(0)}
    for name in ("error_message", "start_ts", "end_ts"):
        if name in state.columns:
            fresh[name] = F.lit(None)
    kinds = {field.name: field.dataType for field in state.schema}
    return state.withColumns(
        {
            name: F.when(chosen, value.cast(kinds[name])).otherwise(F.col(name))
            for name, value in fresh.items()
        }
    )


def reset_failed(state: DataFrame, max_retries: int = 3) -> DataFrame:
    """Failed rows with retries left become pending; ``was_reset`` marks them, for counting."""
    reset = (F.col("status") == "failed") & (F.col("retry_count") < max_retries)
    return state.withColumn("was_reset", reset).withColumn(
        "status", F.when(F.col("was_reset"), F.lit("pending")).otherwise(F.col("status"))
    )


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates win over base rows of the same key. ``updates`` holds each key once."""
    return base.join(updates, list(keys), "left_anti").unionByName(updates)


def is_retained(business_date: Column, today: date, days: int = 7) -> Column:
    return business_date >= F.date_sub(F.lit(today), days)
