"""How the standard tables stand in for a ledger, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.functions.columns import run_id_text, run_path
from loadledger.functions.windows import window_end, window_start
from loadledger.operators.latest import latest
from loadledger.operators.state import due_every_day, fold
from loadledger.sinks.ledger import Ledger
from loadledger.sources.lake import LakeSource
from loadledger.work import new_dir

RUN_KEY = ("table_key", "business_date")
LOG_KEY = ("user_id", "business_date")
ORDER = ("event_ts", "seq")

# Which transition each event type stands for.
STATUS_OF_EVENT = {
    "signup": "pending",
    "view": "running",
    "click": "retrying",
    "purchase": "completed",
    "error": "failed",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return LakeSource(spark, sf_dir).table(name)


def as_log(events: DataFrame) -> DataFrame:
    """Each event read as one ledger transition of one table, with the table still a number.

    Keys and counts become what they stand for in :func:`named`, once few rows are left: building
    text keys and parsing JSON for every event would cost more than the aggregates themselves.
    """
    status = F.lit(None).cast("string")
    for event, word in STATUS_OF_EVENT.items():
        status = F.when(F.col("event_type") == event, word).otherwise(status)
    return events.select(
        F.col("event_id").alias("seq"),
        "user_id",
        F.to_date("ts").alias("business_date"),
        F.col("ts").alias("event_ts"),
        status.alias("status"),
        "props",
        "value",
    )


def named(rows: DataFrame) -> DataFrame:
    """Table keys in place of numbers, and record counts in place of their JSON."""
    user = F.col("user_id")
    key = F.concat(F.lit("src"), user % 5, F.lit(".tbl"), user).alias("table_key")
    made = {
        "props": F.get_json_object("props", "$.k").cast("bigint").alias("record_count"),
        "value": F.floor(F.col("value") * 1000).cast("bigint").alias("file_size_bytes"),
    }
    others = [name for name in rows.columns if name not in ("user_id", *made)]
    return rows.select(key, *others, *[made[name] for name in made if name in rows.columns])


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_log(load(spark, sf_dir, "events"))


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(log(spark, sf_dir))


def current(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The latest transition per table and date, with the named columns."""
    wanted = ["props" if name == "record_count" else name for name in columns]
    rows = log(spark, sf_dir).select(*dict.fromkeys([*LOG_KEY, *ORDER, *wanted]))
    return named(latest(rows, LOG_KEY, ORDER)).select(*RUN_KEY, *columns)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folded log, one row per numbered table and date."""
    return fold(log(spark, sf_dir), LOG_KEY, carried=("props", "value"))


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(states(spark, sf_dir))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest status per numbered table and date."""
    return states(spark, sf_dir).select(*LOG_KEY, "status")


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every numbered table is due daily, from the first day it was seen on to the last day of all."""
    rows = log(spark, sf_dir)
    first = rows.groupBy("user_id").agg(F.min("business_date").alias("first_day"))
    return due_every_day(first, "first_day", last_day(spark, sf_dir))


def last_day(spark: SparkSession, sf_dir: str) -> Column:
    """The last day anything happened, as a value to compare with."""
    return log(spark, sf_dir).select(F.max("business_date")).scalar()


# Which attempt each transition of the stand-in belongs to.
ATTEMPT_OF_STATUS = {"running": 1, "retrying": 2, "failed": 2, "pending": 0, "completed": 0}


def run_of(event_ts: Column, table_key: Column) -> Column:
    """The run a transition of the stand-in belongs to: its source and hour."""
    return F.concat(F.substring_index(table_key, ".", 1), F.date_format(event_ts, "-yyyyMMddHH"))


def stored_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """All transitions in a ledger, with windows, attempts, runs and output paths."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    part = F.split("table_key", r"\.")
    moment = F.col("event_ts")
    path = run_path("s3://lake", part[0], part[1], moment, run_id_text(moment))
    attempt = F.create_map(*[F.lit(x) for pair in ATTEMPT_OF_STATUS.items() for x in pair])
    ledger.append(
        transitions(spark, sf_dir).select(
            "*",
            window_start(F.col("business_date")).alias("window_start"),
            window_end(F.col("business_date")).alias("window_end"),
            attempt[F.col("status")].alias("attempt"),
            run_of(moment, F.col("table_key")).alias("run_id"),
            F.when(F.col("status") == "completed", path).alias("output_path"),
        )
    )
    return ledger


_X = """
x AS (
  SELECT event_id AS seq,
         concat('src', user_id % 5, '.tbl', user_id) AS table_key,
         CAST(ts AS DATE) AS business_date,
         ts AS event_ts,
         CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running'
              WHEN 'click' THEN 'retrying' WHEN 'purchase' THEN 'completed'
              WHEN 'error' THEN 'failed' END AS status,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS record_count,
         CAST(floor(value * 1000) AS BIGINT) AS file_size_bytes,
         concat('src', user_id % 5, strftime(ts, '-%Y%m%d%H')) AS run_id,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 2 ELSE 0 END AS attempt
  FROM events
)"""
_C = """
c AS (
  SELECT * EXCLUDE (newest) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY table_key, business_date ORDER BY event_ts DESC, seq DESC) AS newest
    FROM x) AS ranked
  WHERE newest = 1
)"""
_F = """
f AS (
  SELECT table_key, business_date,
         arg_max(status, struct_pack(ts := event_ts, id := seq)) AS status,
         max(event_ts) AS last_ts,
         min(event_ts) FILTER (status IN ('running', 'retrying')) AS first_start_ts,
         max(event_ts) FILTER (status IN ('running', 'retrying')) AS start_ts,
         max(event_ts) FILTER (status IN ('completed', 'failed')) AS end_ts,
         arg_max(record_count, struct_pack(ts := event_ts, id := seq))
           FILTER (status IN ('completed', 'failed')) AS record_count,
         arg_max(file_size_bytes, struct_pack(ts := event_ts, id := seq))
           FILTER (status IN ('completed', 'failed')) AS file_size_bytes,
         greatest(count(*) FILTER (status IN ('running', 'retrying')) - 1, 0) AS retry_count
  FROM x GROUP BY table_key, business_date
)"""
_G = """
g AS (
  SELECT table_key, CAST(unnest(generate_series(
           CAST(min(business_date) AS TIMESTAMP), (SELECT CAST(max(business_date) AS TIMESTAMP) FROM x),
           INTERVAL 1 DAY)) AS DATE) AS business_date
  FROM x GROUP BY table_key
)"""

WITH_X = f"WITH {_X.strip()}\n"
WITH_C = f"WITH {_X.strip()}, {_C.strip()}\n"
WITH_F = f"WITH {_X.strip()}, {_F.strip()}\n"
WITH_CG = f"WITH {_X.strip()}, {_C.strip()}, {_G.strip()}\n"
_R = """
r AS (
  SELECT run_id, table_key,
         arg_max(status, struct_pack(ts := event_ts, id := seq)) AS status,
         min(event_ts) FILTER (status IN ('running', 'retrying')) AS first_start_ts,
         max(event_ts) AS last_ts,
         arg_max(record_count, struct_pack(ts := event_ts, id := seq))
           FILTER (status IN ('completed', 'failed')) AS record_count,
         greatest(arg_max(attempt, struct_pack(ts := event_ts, id := seq)) - 1, 0) AS retry_count
  FROM x GROUP BY run_id, table_key
)"""
WITH_R = f"WITH {_X.strip()}, {_R.strip()}\n"
WITH_FG = f"WITH {_X.strip()}, {_F.strip()}, {_G.strip()}\n"
