"""Windows against instants, taken from the stand-in ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.registry import query
from loadledger.catalog.tables import WITH_X, transitions
from loadledger.functions.columns import is_running
from loadledger.operators import intervals


def _hours(seq: Column, most: int) -> Column:
    return F.make_interval(hours=(1 + seq % most).cast("int"))


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window for each start, from one hour to four days long, now and then a month."""
    rows = transitions(spark, sf_dir).where(F.col("status") == "running")
    length = F.when(F.col("seq") % 50 == 0, F.make_interval(days=F.lit(30))).otherwise(_hours(F.col("seq"), 96))
    return rows.select(
        "table_key",
        F.col("seq").alias("window_seq"),
        F.col("event_ts").alias("window_start"),
        (F.col("event_ts") + length).alias("window_end"),
    )


_W = """
, w AS (
  SELECT table_key, seq AS window_seq, event_ts AS window_start,
         event_ts + CASE WHEN seq % 50 = 0 THEN INTERVAL 30 DAY ELSE to_hours(1 + seq % 96) END AS window_end
  FROM x WHERE status = 'running')
"""


@query(
    WITH_X
    + _W
    + """
    SELECT w.table_key, w.window_seq, count(*) AS n, min(x.event_ts) AS first_ts, max(x.seq) AS last_seq
    FROM w JOIN x ON x.table_key = w.table_key AND x.event_ts >= window_start AND x.event_ts < window_end
    GROUP BY 1, 2
    """
)
def instants_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happened to each table inside each of its windows, which overlap and differ in length."""
    rows = transitions(spark, sf_dir).select("table_key", "seq", "event_ts")
    found = intervals.in_windows(rows, "event_ts", _starts(spark, sf_dir), ["table_key"])
    return found.groupBy("table_key", "window_seq").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ts").alias("first_ts"), F.max("seq").alias("last_seq")
    )


@query(
    WITH_X
    + _W
    + """
    SELECT table_key, seq, event_ts FROM x WHERE NOT EXISTS (
      SELECT 1 FROM w WHERE w.table_key = x.table_key AND x.event_ts >= window_start AND x.event_ts < window_end)
    """
)
def instants_outside_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transitions(spark, sf_dir).select("table_key", "seq", "event_ts")
    return intervals.outside_all(rows, "event_ts", _starts(spark, sf_dir).drop("window_seq"), ["table_key"])


@query(
    WITH_X
    + """
    SELECT e.table_key, e.seq, e.event_ts, e.status, s.seq AS start_seq, s.event_ts AS start_ts
    FROM (SELECT * FROM x WHERE status IN ('completed', 'failed')) AS e
    LEFT JOIN LATERAL (
      SELECT seq, event_ts FROM x WHERE x.table_key = e.table_key AND x.status IN ('running', 'retrying')
        AND x.event_ts <= e.event_ts ORDER BY event_ts DESC, seq DESC LIMIT 1) AS s ON true
    """
)
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start that each end belongs to: the newest of its table at or before it."""
    log = transitions(spark, sf_dir)
    ends = log.where(F.col("status").isin("completed", "failed")).select("table_key", "seq", "event_ts", "status")
    starts = log.where(is_running(F.col("status"))).select(
        "table_key", F.col("seq").alias("start_seq"), F.col("event_ts").alias("start_ts")
    )
    return intervals.asof_join(ends, starts, ["table_key"], "event_ts", "start_ts", ["start_seq"])


_COVERED = """
, c AS (
  SELECT table_key, date_trunc('hour', event_ts) AS s, date_trunc('hour', event_ts) + to_hours(1 + seq % 36) AS e
  FROM x WHERE status = 'completed')
"""


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of one to 36 hours that successes cover."""
    rows = transitions(spark, sf_dir).where(F.col("status") == "completed")
    start = F.date_trunc("hour", "event_ts").cast("timestamp_ntz")
    return rows.select("table_key", start.alias("window_start"), (start + _hours(F.col("seq"), 36)).alias("window_end"))


@query(
    WITH_X
    + _COVERED
    + """
    , marked AS (
      SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY table_key ORDER BY s, e
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM c),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY table_key ORDER BY s, e
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM marked)
    SELECT table_key, min(s) AS window_start, max(e) AS window_end FROM numbered GROUP BY table_key, island
    """
)
def covered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.islands(_covered(spark, sf_dir), ["table_key"])


@query(
    WITH_X
    + _COVERED
    + """
    , wanted AS (
      SELECT table_key, CAST(CAST(min(event_ts) AS DATE) AS TIMESTAMP) AS s,
             CAST(CAST(max(event_ts) AS DATE) + 1 AS TIMESTAMP) AS e FROM x GROUP BY table_key),
    clipped AS (
      SELECT c.table_key, greatest(c.s, w.s) AS s, least(c.e, w.e) AS e FROM c JOIN wanted AS w USING (table_key)
      UNION ALL SELECT table_key, s, s FROM wanted UNION ALL SELECT table_key, e, e FROM wanted),
    reached AS (
      SELECT table_key, s, max(e) OVER (PARTITION BY table_key ORDER BY s, e
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM clipped WHERE s <= e)
    SELECT table_key, reach AS window_start, s AS window_end FROM reached WHERE s > reach
    """
)
def uncovered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each table's time, from its first day to its last, no success covers."""
    log = transitions(spark, sf_dir)
    day = F.to_date("event_ts")
    wanted = log.groupBy("table_key").agg(
        F.min(day).cast("timestamp_ntz").alias("window_start"), F.date_add(F.max(day), 1).cast("timestamp_ntz").alias("window_end")
    )
    return intervals.uncovered(wanted, _covered(spark, sf_dir), ["table_key"])
