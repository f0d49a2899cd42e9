"""Figures about runs, taken from the stand-in ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.registry import query
from loadledger.catalog.tables import (
    ATTEMPT_OF_STATUS,
    LOG_KEY,
    ORDER,
    RUN_KEY,
    WITH_C,
    WITH_F,
    WITH_R,
    WITH_X,
    current,
    folded,
    log,
    named,
    run_of,
    states,
    statuses,
    stored_ledger,
    transitions,
)
from loadledger.operators import progress
from loadledger.operators.state import fold
from loadledger.sinks.runlog import RunLog
from loadledger.work import new_dir


@query(WITH_C + "SELECT table_key, business_date, seq, status FROM c")
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(spark, sf_dir, "seq", "status")


@query(
    WITH_C
    + """
    SELECT s.status, count(c.status) AS n
    FROM (SELECT unnest(['pending', 'running', 'completed', 'failed', 'skipped', 'retrying']) AS status)
      AS s LEFT JOIN c ON c.status = s.status
    GROUP BY s.status
    """
)
def status_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.status_counts(statuses(spark, sf_dir))


@query(
    WITH_F
    + """
    , timed AS (
      SELECT split_part(table_key, '.', 1) AS source, status, record_count, file_size_bytes,
             CASE WHEN status = 'completed'
                  THEN nullif(date_diff('microsecond', start_ts, end_ts), 0) END AS us
      FROM f)
    SELECT source, count(*) AS total,
           count(*) FILTER (status = 'completed') AS n_completed,
           CAST(coalesce(sum(record_count) FILTER (status = 'completed'), 0) AS BIGINT) AS records,
           CAST(coalesce(sum(file_size_bytes) FILTER (status = 'completed'), 0) AS BIGINT) AS bytes,
           coalesce(CAST(sum(us) AS DOUBLE) / count(us) / 1000000.0, 0.0) AS avg_s,
           min(us) / 1000000.0 AS min_s, max(us) / 1000000.0 AS max_s
    FROM timed GROUP BY source
    """
)
def extraction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_source = folded(spark, sf_dir).withColumn("source", F.substring_index("table_key", ".", 1))
    return progress.summary(by_source, ["source"])


@query(
    WITH_C
    + """
    SELECT business_date, count(*) AS total, count(*) FILTER (status = 'completed') AS completed,
           count(*) FILTER (status = 'failed') AS failed,
           count(*) FILTER (status = 'skipped') AS skipped,
           count(*) FILTER (status IN ('completed', 'skipped')) * 100.0::DOUBLE / count(*)
             AS completion_rate
    FROM c GROUP BY business_date
    """
)
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.progress(statuses(spark, sf_dir), ["business_date"])


@query(
    WITH_R
    + """
    SELECT *, CASE WHEN failed = 0 THEN 'SUCCESS' WHEN ok = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS outcome,
           CASE WHEN ok + failed > 0 THEN CAST(ok AS DOUBLE) / (ok + failed) END AS success_ratio
    FROM (SELECT run_id, count(*) FILTER (status = 'completed') AS ok,
                 count(*) FILTER (status = 'failed') AS failed
          FROM r GROUP BY run_id) AS counts
    """
)
def run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of all runs of a stored ledger, whatever later runs did to the same tables."""
    return progress.outcome(stored_ledger(spark, sf_dir).by_run(), ["run_id"])


_RUNS = """
    , runs AS (
      SELECT run_id, min(first_start_ts) AS started_ts, max(last_ts) AS last_ts, count(*) AS attempted,
             count(*) FILTER (status = 'completed') AS succeeded,
             count(*) FILTER (status = 'failed') AS failed,
             count(*) FILTER (status IN ('running', 'retrying')) AS running,
             CAST(coalesce(sum(record_count) FILTER (status = 'completed'), 0) AS BIGINT) AS records,
             CAST(sum(retry_count) AS BIGINT) AS restarts
      FROM r GROUP BY run_id),
    log AS (
      SELECT *, CASE WHEN running > 0 THEN 'STARTED' WHEN failed = 0 THEN 'SUCCESS'
                     WHEN succeeded = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS run_status,
             CASE WHEN running = 0 THEN last_ts END AS ended_ts,
             CASE WHEN running = 0 THEN date_diff('microsecond', started_ts, last_ts) / 1000000.0 END
               AS duration_s,
             CAST(succeeded AS DOUBLE) / attempted AS success_ratio
      FROM runs)
"""


def _run_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the stand-in's tables per run, numbered tables still."""
    rows = log(spark, sf_dir)
    run = F.concat(F.lit("src"), F.col("user_id") % 5, F.date_format("event_ts", "-yyyyMMddHH"))
    attempt = F.create_map(*[F.lit(x) for pair in ATTEMPT_OF_STATUS.items() for x in pair])
    tagged = rows.withColumns({"run_id": run, "attempt": attempt[F.col("status")]})
    return named(fold(tagged, ["run_id", "user_id"], carried=("props",), attempt="attempt"))


@query(WITH_R + _RUNS + "SELECT * FROM log")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.run_log(_run_tables(spark, sf_dir), ["run_id"])


@query(
    WITH_R
    + _RUNS
    + """
    , last AS (SELECT run_id FROM log WHERE run_status <> 'SUCCESS' ORDER BY last_ts DESC, run_id LIMIT 1)
    SELECT run_id, table_key, status FROM r
    WHERE run_id = (SELECT run_id FROM last) AND status NOT IN ('completed', 'skipped')
    """
)
def run_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to do of the last run that is no success."""
    tables = _run_tables(spark, sf_dir)
    troubled = progress.run_log(tables, ["run_id"]).where("run_status <> 'SUCCESS'")
    last = progress.recent_runs(troubled, "run_id", 1).select("run_id").scalar()
    return progress.resume_run(tables, last).select("run_id", "table_key", "status")


@query(
    WITH_C
    + """
    , members AS (
      SELECT business_date, 'attempted' AS list, table_key FROM c WHERE status <> 'pending'
      UNION ALL SELECT business_date, 'succeeded' AS list, table_key FROM c WHERE status = 'completed'
      UNION ALL SELECT business_date, 'failed' AS list, table_key FROM c WHERE status = 'failed'),
    numbered AS (
      SELECT *, (row_number() OVER (PARTITION BY business_date, list ORDER BY table_key) - 1) // 50 AS part
      FROM members)
    SELECT business_date, list, part, count(*) AS n, string_agg(table_key, ',' ORDER BY table_key) AS tables
    FROM numbered GROUP BY 1, 2, 3
    """
)
def run_table_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.table_lists(named(statuses(spark, sf_dir)), ["business_date"], chunk=50)


@query(WITH_C + "SELECT DISTINCT business_date, table_key FROM c WHERE status = 'completed'")
def completed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = statuses(spark, sf_dir).where(F.col("status") == "completed")
    return named(done.select(*LOG_KEY).distinct())


@query(
    WITH_C
    + """
    , counts AS (
      SELECT business_date,
             count(*) FILTER (event_ts - INTERVAL 12 HOUR < business_date AND status = 'running')
               AS early,
             count(*) FILTER (status = 'failed') AS failed,
             count(*) FILTER (status = 'pending') AS pending
      FROM c GROUP BY business_date)
    SELECT business_date, 'window_inconsistency' AS finding, early AS n,
           'review the windows of these extracts' AS action FROM counts WHERE early > 0
    UNION ALL SELECT business_date, 'failed_extractions' AS finding, failed AS n,
           'look into the failures, then reset them for a retry' AS action FROM counts WHERE failed > 0
    UNION ALL SELECT business_date, 'pending_extractions' AS finding, pending AS n,
           'run the rest of the extracts' AS action FROM counts WHERE pending > 0
    """
)
def run_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs are expected from noon on: a table still running from the morning is out of its window."""
    noon = F.col("business_date").cast("timestamp_ntz") + F.make_interval(hours=F.lit(12))
    early = (F.col("last_ts") < noon) & (F.col("status") == "running")
    return progress.findings(states(spark, sf_dir), ["business_date"], early)


@query(
    WITH_X
    + """
    SELECT table_key, seq, attempt, attempt - 1 AS retry_count FROM (
      SELECT table_key, seq,
             row_number() OVER (PARTITION BY table_key ORDER BY event_ts, seq) AS attempt
      FROM x WHERE status IN ('running', 'retrying')) AS starts
    """
)
def retry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = progress.start_numbers(log(spark, sf_dir), "user_id", list(ORDER))
    return named(numbered).select("table_key", "seq", "attempt", "retry_count")


@query(
    WITH_X
    + """
    SELECT table_key, count(DISTINCT business_date) AS attempts,
           count(DISTINCT business_date) - 1 AS restart_count, max(business_date) AS resume_date
    FROM x GROUP BY table_key
    """
)
def restart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(progress.restarts(log(spark, sf_dir), "user_id", "business_date"))


# What each transition of the stand-in says about its whole run.
_RUN_STATUS = {
    "pending": "PAUSED", "running": "STARTED", "retrying": "STARTED", "completed": "SUCCESS", "failed": "FAILED"
}


@query(
    WITH_X
    + """
    SELECT run_id, business_date, 'hourly' AS name,
           CASE newest WHEN 'pending' THEN 'PAUSED' WHEN 'completed' THEN 'SUCCESS' WHEN 'failed' THEN 'FAILED'
                       ELSE 'STARTED' END AS run_status,
           started_ts, greatest(starts - 1, 0) AS restarts, records,
           CASE WHEN newest IN ('completed', 'failed') THEN last_ts END AS ended_ts
    FROM (SELECT run_id, business_date, arg_max(status, struct_pack(ts := event_ts, id := seq)) AS newest,
                 min(event_ts) AS started_ts, max(event_ts) AS last_ts,
                 count(*) FILTER (status IN ('running', 'retrying')) AS starts,
                 arg_max(record_count, struct_pack(ts := event_ts, id := seq)) AS records
          FROM x GROUP BY run_id, business_date) AS folded
    """
)
def run_log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs as a stored log of their starts, pauses and ends says they stand."""
    stored = RunLog(spark, new_dir(spark, "runlog"))
    word = F.create_map(*[F.lit(x) for pair in _RUN_STATUS.items() for x in pair])
    entries = transitions(spark, sf_dir)
    stored.append(
        entries.select(
            "seq",
            "event_ts",
            "business_date",
            run_of(F.col("event_ts"), F.col("table_key")).alias("run_id"),
            F.lit("hourly").alias("name"),
            word[F.col("status")].alias("run_status"),
            F.col("record_count").alias("records"),
        ).hint("rebalance", "business_date")
    )
    return stored.runs().drop("attempted", "succeeded", "failed")


@query(WITH_R + _RUNS + "SELECT * FROM log ORDER BY last_ts DESC, run_id LIMIT 10")
def recent_runs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.recent_runs(progress.run_log(_run_tables(spark, sf_dir), ["run_id"]), "run_id", 10)


@query(
    WITH_X
    + """
    , done AS (
      SELECT *, row_number() OVER (
        PARTITION BY table_key, business_date ORDER BY event_ts DESC, seq DESC) AS newest
      FROM x WHERE status = 'completed')
    SELECT table_key, business_date, seq, record_count,
           concat('s3://lake/', split_part(table_key, '.', 1), '/', split_part(table_key, '.', 2),
                  strftime(event_ts, '/%Y%m/%d/%Y%m%d_%H%M%S.parquet')) AS output_path
    FROM done WHERE newest = 1
    """
)
def complete_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every date, where a stored ledger has the newest successful run of each table."""
    dataset = stored_ledger(spark, sf_dir).complete_dataset()
    return dataset.select(*RUN_KEY, "seq", "record_count", "output_path")


@query(
    WITH_X
    + """
    , done AS (
      SELECT *, row_number() OVER (
        PARTITION BY table_key, business_date ORDER BY event_ts DESC, seq DESC) AS newest
      FROM x WHERE status = 'completed' AND event_ts <= TIMESTAMP '2024-01-15 12:00:00')
    SELECT table_key, business_date, seq FROM done WHERE newest = 1
    """
)
def dataset_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete data set as a stored ledger stood at an instant."""
    ledger = stored_ledger(spark, sf_dir)
    return ledger.complete_dataset(moment=datetime(2024, 1, 15, 12)).select(*RUN_KEY, "seq")


@query(
    WITH_F
    + """
    SELECT table_key, business_date, status, last_ts AS since,
           CASE WHEN status = 'completed' THEN record_count END AS records,
           CASE WHEN status = 'completed' THEN file_size_bytes END AS bytes,
           CASE WHEN status = 'completed'
                THEN date_diff('microsecond', start_ts, end_ts) / 1000000.0 END AS duration_s,
           CASE WHEN status = 'failed' THEN retry_count END AS retries,
           CASE WHEN status = 'failed' THEN 'lost ' || record_count END AS error
    FROM f
    """
)
def status_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    states_ = folded(spark, sf_dir)
    message = F.concat(F.lit("lost "), F.col("record_count"))
    return progress.details(states_.withColumn("error_message", message), RUN_KEY)
