"""Figures about runs: counts, rates, durations, findings and lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.functions.columns import STATUSES, micros_between, seconds_between
from loadledger.operators.running import number_rows


def status_counts(state: DataFrame) -> DataFrame:
    """Rows per status, with a row for every status even when nothing has it."""
    figures = state.agg(
        *[F.count_if(F.col("status") == status).alias(status) for status in STATUSES]
    )
    return figures.unpivot([], list(STATUSES), "status", "n")


def summary(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Extracts, completed extracts, their records and bytes, with durations in seconds.

    Only completed rows count towards records and durations, and a duration of zero is left out.
    """
    done = F.col("status") == "completed"
    spent = F.nullif(micros_between(F.col("start_ts"), F.col("end_ts")), F.lit(0))
    timed = F.when(done, spent)
    mean = F.sum(timed) / F.count(timed) / F.lit(1e6)
    amounts = {"records": "record_count", "bytes": "file_size_bytes"}
    return state.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(done).alias("n_completed"),
        *[
            F.coalesce(F.sum(F.when(done, F.col(column))), F.lit(0)).alias(name)
            for name, column in amounts.items()
            if column in state.columns
        ],
        F.when(F.count(timed) > 0, mean).otherwise(F.lit(0.0)).alias("avg_s"),
        (F.min(timed) / F.lit(1e6)).alias("min_s"),
        (F.max(timed) / F.lit(1e6)).alias("max_s"),
    )


def progress(state: DataFrame, run: Sequence[str]) -> DataFrame:
    """Outcomes per run and the share that is completed or skipped, in percent."""

    def having(*statuses: str) -> Column:
        return F.count_if(F.col("status").isin(*statuses))

    settled = having("completed", "skipped")
    return state.groupBy(*run).agg(
        F.count(F.lit(1)).alias("total"),
        having("completed").alias("completed"),
        having("failed").alias("failed"),
        having("skipped").alias("skipped"),
        (settled * F.lit(100.0) / F.count(F.lit(1))).alias("completion_rate"),
    )


def outcome(state: DataFrame, run: Sequence[str]) -> DataFrame:
    """SUCCESS when no table failed, FAILED when none worked, PARTIAL in between, and the share that did.

    Tables that neither completed nor failed do not count. Where no table did either, the share is NULL.
    """
    counts = state.groupBy(*run).agg(
        F.count_if(F.col("status") == "completed").alias("ok"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    return counts.withColumn(
        "outcome",
        F.when(F.col("failed") == 0, "SUCCESS").when(F.col("ok") == 0, "FAILED").otherwise("PARTIAL"),
    ).withColumn("success_ratio", F.try_divide(F.col("ok"), F.col("ok") + F.col("failed")))


def run_log(tables: DataFrame, run: Sequence[str]) -> DataFrame:
    """One row per run, from its tables' states such as :meth:`Ledger.by_run` gives.

    A run whose tables are not all at an end is STARTED and has no end yet. Times span its tables.
    """
    status = F.col("status")
    open_ = F.count_if(status.isin("running", "retrying"))
    figures = tables.groupBy(*run).agg(
        F.min("first_start_ts").alias("started_ts"),
        F.max("last_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(status == "completed").alias("succeeded"),
        F.count_if(status == "failed").alias("failed"),
        open_.alias("running"),
        F.coalesce(F.sum(F.when(status == "completed", F.col("record_count"))), F.lit(0)).alias("records"),
        F.coalesce(F.sum("retry_count"), F.lit(0)).cast("bigint").alias("restarts"),
    )
    over = F.col("running") == 0
    return (
        figures.withColumn(
            "run_status",
            F.when(~over, "STARTED")
            .when(F.col("failed") == 0, "SUCCESS")
            .when(F.col("succeeded") == 0, "FAILED")
            .otherwise("PARTIAL"),
        )
        .withColumn("ended_ts", F.when(over, F.col("last_ts")))
        .withColumn("duration_s", micros_between(F.col("started_ts"), F.col("ended_ts")) / F.lit(1e6))
        .withColumn("success_ratio", F.col("succeeded") / F.col("attempted"))
    )


def resume_run(tables: DataFrame, run_id: str | Column) -> DataFrame:
    """What a run taken up again has to do: its tables that are neither completed nor skipped."""
    wanted = F.lit(run_id) if isinstance(run_id, str) else run_id
    return tables.where((F.col("run_id") == wanted) & ~F.col("status").isin("completed", "skipped"))


def table_lists(
    state: DataFrame, run: Sequence[str], table: str = "table_key", chunk: int = 1000
) -> DataFrame:
    """Which tables each run attempted, completed and failed, as sorted comma-separated text.

    A list is broken into numbered parts of ``chunk`` tables. That bounds every cell, and no run is
    gathered in one task however many tables it has.
    """
    status = F.col("status")
    memberships = F.array_compact(
        F.array(
            F.when(status != "pending", F.lit("attempted")),
            F.when(status == "completed", F.lit("succeeded")),
            F.when(status == "failed", F.lit("failed")),
        )
    )
    members = state.select(*run, table, F.explode(memberships).alias("list"))
    numbered = number_rows(members, [*run, "list"], [table], "_n")
    part = F.floor((F.col("_n") - 1) / F.lit(chunk)).cast("bigint")
    return numbered.groupBy(*run, "list", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.collect_list(table)), ",").alias("tables"),
    )


# The kinds of findings. What each advises is our own.
ACTIONS = {
    "window_inconsistency": "review the windows of these extracts",
    "failed_extractions": "look into the failures, then reset them for a retry",
    "pending_extractions": "run the rest of the extracts",
}


def findings(state: DataFrame, run: Sequence[str], outside_window: Column) -> DataFrame:
    """One row per run and kind of finding that occurs at all, with its count and advice."""
    counts = state.groupBy(*run).agg(
        F.count_if(outside_window).alias("window_inconsistency"),
        F.count_if(F.col("status") == "failed").alias("failed_extractions"),
        F.count_if(F.col("status") == "pending").alias("pending_extractions"),
    )
    rows = counts.unpivot(list(run), list(ACTIONS), "finding", "n").where("n > 0")
    advice = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    return rows.withColumn("action", advice[F.col("finding")])


def recent_runs(runs: DataFrame, run: str, limit: int = 10) -> DataFrame:
    """The runs of a :func:`run_log` that were active last, newest first, with all their figures."""
    return runs.orderBy(F.desc("last_ts"), run).limit(limit)


def restarts(log: DataFrame, run: str, attempt: str) -> DataFrame:
    """How often each run was attempted, and the attempt to resume, which is the latest."""
    attempts = log.select(run, attempt).distinct()
    return attempts.groupBy(run).agg(
        F.count(F.lit(1)).alias("attempts"),
        (F.count(F.lit(1)) - 1).alias("restart_count"),
        F.max(attempt).alias("resume_date"),
    )


def start_numbers(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Every start of a table with its number; starts after the first are retries."""
    starts = log.where(F.col("status").isin("running", "retrying")).select(key, *order)
    numbered = number_rows(starts, [key], order, "attempt")
    return numbered.withColumn("retry_count", F.col("attempt") - 1)


def all_days(rows: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last in a column, for reporting days on which nothing happened."""
    ends = rows.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))
    days = F.sequence("first", "last", F.make_interval(days=F.lit(1)))
    return ends.where("first IS NOT NULL").select(F.explode(days).alias("business_date"))


def details(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per extract with what matters for its status.

    That is since when; of a success its records, bytes and seconds; of a failure its retries and error.
    """
    status = F.col("status")
    done, failed = status == "completed", status == "failed"
    return state.select(
        *keys,
        "status",
        F.col("last_ts").alias("since"),
        F.when(done, F.col("record_count")).alias("records"),
        F.when(done, F.col("file_size_bytes")).alias("bytes"),
        F.when(done, seconds_between(F.col("start_ts"), F.col("end_ts"))).alias("duration_s"),
        F.when(failed, F.col("retry_count")).alias("retries"),
        F.when(failed, F.col("error_message")).alias("error"),
    )
