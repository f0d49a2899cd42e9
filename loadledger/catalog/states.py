"""State decisions over the stand-in ledger: what is needed, retried, forced, merged, kept."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.registry import query
from loadledger.catalog.tables import (
    LOG_KEY,
    ORDER,
    RUN_KEY,
    WITH_C,
    WITH_CG,
    WITH_F,
    WITH_FG,
    WITH_X,
    folded,
    last_day,
    load,
    log,
    named,
    requested,
    states,
    statuses,
    stored_ledger,
)
from loadledger.functions.windows import same_day
from loadledger.operators import state
from loadledger.operators.latest import latest
from loadledger.operators.quality import verdict
from loadledger.work import new_dir


@query(
    WITH_CG
    + """
    SELECT table_key, business_date FROM g
    EXCEPT SELECT table_key, business_date FROM c WHERE status IN ('completed', 'skipped')
    """
)
def pending_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(state.pending(requested(spark, sf_dir), statuses(spark, sf_dir), LOG_KEY))


@query(
    WITH_CG
    + """
    SELECT table_key, business_date FROM g
    INTERSECT SELECT table_key, business_date FROM c WHERE status IN ('completed', 'skipped')
    """
)
def already_done_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(state.already_done(requested(spark, sf_dir), statuses(spark, sf_dir), LOG_KEY))


@query(
    WITH_CG
    + """
    SELECT g.table_key, g.business_date, c.status FROM g
    LEFT JOIN c ON g.table_key = c.table_key AND g.business_date = c.business_date
    """
)
def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(state.lookup(requested(spark, sf_dir), statuses(spark, sf_dir), LOG_KEY))


@query(
    WITH_CG
    + """
    , known AS (SELECT * FROM c WHERE business_date <= DATE '2024-01-15')
    SELECT table_key, business_date,
           CASE WHEN status IN ('running', 'retrying') THEN 'pending' ELSE status END AS status
    FROM known
    UNION ALL
    SELECT g.table_key, g.business_date, 'pending' AS status FROM g
    WHERE NOT EXISTS (SELECT 1 FROM known
      WHERE known.table_key = g.table_key AND known.business_date = g.business_date)
    """
)
def resume_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger stops half way through the month; all later days are new work."""
    known = statuses(spark, sf_dir).where(
        F.col("business_date") <= F.lit(date(2024, 1, 15))
    )
    return named(state.resume(known, requested(spark, sf_dir), LOG_KEY))


@query(
    WITH_CG
    + """
    , open AS (
      SELECT g.table_key, g.business_date, coalesce(c.status, 'pending') AS status FROM g
      LEFT JOIN c ON g.table_key = c.table_key AND g.business_date = c.business_date)
    SELECT table_key, business_date, true AS include_failed FROM open
    WHERE status NOT IN ('completed', 'skipped')
    UNION ALL
    SELECT table_key, business_date, false AS include_failed FROM open
    WHERE status NOT IN ('completed', 'skipped', 'failed')
    """
)
def todo_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(state.todo(requested(spark, sf_dir), statuses(spark, sf_dir), LOG_KEY))


@query(
    WITH_F
    + """
    SELECT table_key, business_date, status, first_start_ts, start_ts, end_ts, record_count, retry_count
    FROM f
    """
)
def transition_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded(spark, sf_dir).drop("last_ts", "file_size_bytes")


@query(
    WITH_FG
    + """
    , evidence AS (
      SELECT concat('src', user_id % 5, '.tbl', user_id) AS table_key, CAST(ts AS DATE) AS business_date,
             CAST(floor(max(value)) AS BIGINT) AS top FROM events GROUP BY 1, 2),
    known AS (
      SELECT g.table_key, g.business_date, g.table_key LIKE 'src3.%' AS forced, f.status, f.retry_count,
             f.record_count,
             CASE WHEN e.top < 15 THEN NULL WHEN e.top > 45 THEN f.record_count * 2 + 1
                  ELSE f.record_count END AS actual
      FROM g LEFT JOIN f ON g.table_key = f.table_key AND g.business_date = f.business_date
      LEFT JOIN evidence AS e ON g.table_key = e.table_key AND g.business_date = e.business_date),
    judged AS (
      SELECT *, CASE WHEN status IS NULL THEN 'unknown_key' WHEN forced THEN 'forced'
             WHEN status = 'skipped' THEN 'skipped'
             WHEN status NOT IN ('completed', 'failed') THEN 'not_finished'
             WHEN status = 'failed' AND retry_count < 1 THEN 'retryable_failure'
             WHEN status = 'failed' THEN 'retries_exhausted'
             WHEN actual IS NULL THEN 'output_missing'
             WHEN actual <> record_count
               THEN 'output_corrupt'
             ELSE 'up_to_date' END AS reason
      FROM known)
    SELECT table_key, business_date,
           reason NOT IN ('skipped', 'retries_exhausted', 'up_to_date') AS needed, reason,
           CASE reason WHEN 'retries_exhausted' THEN 'skipped' WHEN 'up_to_date' THEN status
                WHEN 'skipped' THEN 'skipped' ELSE 'pending' END AS next_status
    FROM judged
    """
)
def extraction_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every requested table and day; the values of its events say how its stored output looks."""
    values = load(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("business_date"), "value"
    )
    evidence = values.groupBy(*LOG_KEY).agg(F.floor(F.max("value")).alias("top"))
    known = states(spark, sf_dir).join(evidence, list(LOG_KEY))
    rows = named(state.lookup(requested(spark, sf_dir), known, LOG_KEY))
    count = F.col("record_count")
    actual = F.when(F.col("top") < 15, None).when(F.col("top") > 45, count * 2 + 1).otherwise(count)
    judged = state.decide(
        rows,
        status=F.col("status"),
        forced=F.col("table_key").startswith("src3."),
        verdict=verdict(count, actual),
        current=F.lit(True),
        retries=F.col("retry_count"),
        max_retries=1,
    )
    return judged.select(*RUN_KEY, "needed", "reason", "next_status")


@query(
    WITH_X
    + """
    , last AS (
      SELECT table_key, arg_max(status, struct_pack(ts := event_ts, id := seq)) AS status,
             max(event_ts) AS last_ts FROM x GROUP BY table_key)
    SELECT table_key,
           status <> 'failed' AND (status <> 'completed' OR last_ts < end_day) AS needed,
           CASE WHEN status = 'failed' THEN 'retries_exhausted' WHEN status <> 'completed'
                THEN 'not_finished' WHEN last_ts < end_day
                THEN 'window_outdated' ELSE 'up_to_date' END AS reason
    FROM last, (SELECT max(business_date) AS end_day FROM x) AS ends
    """
)
def table_extraction_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state per table against the last day: success for an earlier day is out of date."""
    last = named(state.fold(log(spark, sf_dir), ["user_id"], carried=()))
    judged = state.decide(
        last,
        status=F.col("status"),
        forced=F.lit(False),
        verdict=F.lit("valid"),
        current=same_day(F.col("last_ts"), last_day(spark, sf_dir)),
        retries=F.col("retry_count"),
        max_retries=0,
    )
    return judged.select("table_key", "needed", "reason")


@query(
    WITH_F
    + """
    SELECT table_key, business_date, retry_count AS retries,
           CASE WHEN retry_count < 1 THEN 'pending' ELSE 'skipped' END AS next_status
    FROM f WHERE status = 'failed'
    """
)
def retry_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = folded(spark, sf_dir).where(F.col("status") == "failed")
    following = state.after_failure(F.col("status"), F.col("retry_count"), max_retries=1)
    return failed.select(
        *RUN_KEY, F.col("retry_count").alias("retries"), following.alias("next_status")
    )


@query(
    WITH_X
    + """
    , l AS (
      SELECT table_key, business_date, arg_max(status, struct_pack(ts := event_ts, id := seq)) AS status,
             greatest(arg_max(attempt, struct_pack(ts := event_ts, id := seq)) - 1, 0) AS retry_count
      FROM x GROUP BY 1, 2)
    SELECT table_key, business_date,
           CASE WHEN table_key LIKE 'src0.%' THEN 'pending' ELSE status END AS status,
           CAST(CASE WHEN table_key LIKE 'src0.%' THEN 0 ELSE retry_count END AS INTEGER) AS retry_count
    FROM l
    """
)
def force_reprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of one source are reopened in a stored ledger, and count their attempts anew."""
    ledger = stored_ledger(spark, sf_dir)
    ledger.reopen(ledger.current().where(F.col("table_key").startswith("src0.")))
    return ledger.current().select(*RUN_KEY, "status", "retry_count")


@query(
    WITH_F
    + """
    SELECT table_key, business_date,
           CASE WHEN table_key LIKE 'src0.%' THEN 'pending' ELSE status END AS status,
           CASE WHEN table_key LIKE 'src0.%' THEN 0 ELSE retry_count END AS retry_count,
           CASE WHEN table_key NOT LIKE 'src0.%' THEN end_ts END AS end_ts
    FROM f
    """
)
def force_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    forced = state.force(folded(spark, sf_dir), F.col("table_key").startswith("src0."))
    return forced.select(*RUN_KEY, "status", "retry_count", "end_ts")


@query(
    WITH_F
    + """
    SELECT table_key, business_date,
           CASE WHEN status = 'failed' AND retry_count < 1 THEN 'pending' ELSE status END AS status,
           status = 'failed' AND retry_count < 1 AS was_reset
    FROM f
    """
)
def reset_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    reset = state.reset_failed(folded(spark, sf_dir), max_retries=1)
    return reset.select(*RUN_KEY, "status", "was_reset")


@query(
    WITH_X
    + """
    SELECT table_key, business_date, seq, status FROM (
      SELECT *, row_number() OVER (PARTITION BY table_key, business_date ORDER BY event_ts, seq) AS oldest,
             row_number() OVER (
               PARTITION BY table_key, business_date ORDER BY event_ts DESC, seq DESC) AS newest
      FROM x) AS r
    WHERE CASE WHEN business_date > DATE '2024-01-10' THEN newest ELSE oldest END = 1
    """
)
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First states of all days, of which those after the tenth are renewed by the last ones."""
    rows = log(spark, sf_dir).select(*LOG_KEY, *ORDER, "status")
    moment = F.struct(*ORDER)
    base = rows.groupBy(*LOG_KEY).agg(
        F.min("event_ts").alias("event_ts"), F.min_by("seq", moment).alias("seq"), F.min_by("status", moment).alias("status")
    )
    updates = latest(rows.where(F.col("business_date") > F.lit(date(2024, 1, 10))), LOG_KEY, ORDER)
    return named(state.upsert(base, updates, LOG_KEY).select(*LOG_KEY, "seq", "status"))


@query(
    WITH_X
    + """
    , ends AS (SELECT max(business_date) + 1 AS today FROM x),
    last AS (
      SELECT table_key, max(struct_pack(ts := event_ts, id := seq)) AS top
      FROM x WHERE status = 'completed' GROUP BY table_key)
    SELECT count(*) FILTER (business_date >= today - 7) AS young,
           count(*) FILTER (business_date < today - 7 AND status = 'completed'
                            AND struct_pack(ts := event_ts, id := seq) = top) AS last_successes
    FROM x CROSS JOIN ends LEFT JOIN last ON x.table_key = last.table_key
    """
)
def ledger_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a retained copy of the stored ledger holds: the last week, and older last successes."""
    ledger = stored_ledger(spark, sf_dir)
    today = ledger.dates()[-1] + timedelta(days=1)
    kept = ledger.retain(new_dir(spark, "ledger"), today, days=7).transitions()
    young = state.is_retained(F.col("business_date"), today, days=7)
    return kept.agg(F.count_if(young).alias("young"), F.count_if(~young).alias("last_successes"))


@query(
    WITH_X
    + """
    SELECT table_key, max(struct_pack(ts := event_ts, id := seq)).id AS seq
    FROM x WHERE status = 'completed' GROUP BY table_key
    """
)
def compacted_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last success of each table, from a ledger whose older half is compacted, one old date twice."""
    ledger = stored_ledger(spark, sf_dir)
    days = ledger.dates()
    ledger.append(ledger.transitions([days[0]]).drop("append_id"))
    ledger.compact(days[len(days) // 2])
    return latest(ledger._successes(), ["table_key"], ORDER).select("table_key", "seq")
