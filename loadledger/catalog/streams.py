"""The streaming twins; each must end with what the batch query gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.registry import query
from loadledger.catalog.tables import ORDER, WITH_X, as_log, load, named
from loadledger.streaming import arrivals, daily, ingest, live
from loadledger.streaming.attempts import attempts
from loadledger.work import new_dir


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files."""
    schema = load(spark, sf_dir, "events").schema
    return ingest.file_stream(spark, f"{sf_dir}/event[s].parquet", schema)


@query("SELECT CAST(ts AS DATE) AS business_date, count(*) AS n FROM events GROUP BY 1")
def stream_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice over the same checkpoint; the second run finds nothing new."""
    root, checkpoint = new_dir(spark, "ingested"), new_dir(spark, "progress")
    for _ in range(2):
        rows = _events(spark, sf_dir)
        ingest.ingest_new_files(rows, root, F.to_date("ts"), checkpoint).awaitTermination()
    stored = spark.read.parquet(root)
    return stored.groupBy(F.col("batch_date").alias("business_date")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    """
    SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, n
    FROM (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS n FROM events GROUP BY 1) AS d
    WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    """
)
def stream_daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, checkpoint = new_dir(spark, "windows"), new_dir(spark, "progress")
    counts = daily.windowed_counts(_events(spark, sf_dir), "ts", lateness="1 hour")
    daily.store_closed(counts, root, checkpoint).awaitTermination()
    return spark.read.schema(counts.schema).parquet(root)


@query(
    WITH_X
    + """
    SELECT table_key, seq, status FROM (
      SELECT *, row_number() OVER (PARTITION BY table_key ORDER BY event_ts DESC, seq DESC) AS newest
      FROM x) AS r
    WHERE newest = 1
    """
)
def stream_live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, checkpoint = new_dir(spark, "states"), new_dir(spark, "progress")
    rows = as_log(_events(spark, sf_dir)).select("user_id", *ORDER, "status")
    live.follow_states(rows, ["user_id"], list(ORDER), root, checkpoint).awaitTermination()
    return named(live.live_states(spark, root, ["user_id"])).select("table_key", "seq", "status")


@query(
    """
    WITH e AS (SELECT user_id, ts, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END
                 AS ended FROM events WHERE event_type <> 'signup'),
    seen AS (SELECT least(max(ts) FILTER (WHERE ended IS NULL), max(ts) FILTER (WHERE ended IS NOT NULL)) AS upto FROM e),
    starts AS (SELECT DISTINCT user_id, ts FROM e, seen WHERE ended IS NULL AND ts <= upto - INTERVAL 7 HOUR),
    found AS (
      SELECT s.user_id, s.ts, x.ts AS end_ts, x.ended,
             row_number() OVER (PARTITION BY s.user_id, s.ts ORDER BY x.ts, x.ended) AS place
      FROM starts AS s
      LEFT JOIN e AS x ON x.user_id = s.user_id AND x.ended IS NOT NULL
        AND x.ts > s.ts AND x.ts <= s.ts + INTERVAL 6 HOUR)
    SELECT concat('src', user_id % 5, '.tbl', user_id) AS table_key, ts AS start_ts, end_ts, ended AS end_status,
           end_ts IS NULL AS is_abandoned
    FROM found WHERE place = 1
    """
)
def stream_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with their ends, or abandoned after six hours; the last seven hours are still open."""
    root, checkpoint = new_dir(spark, "attempts"), new_dir(spark, "progress")
    found = attempts(as_log(_events(spark, sf_dir)), ["user_id"], limit="6 hours", lateness="1 hour")
    daily.store_closed(found, root, checkpoint).awaitTermination()
    return named(spark.read.schema(found.schema).parquet(root))


@query(
    """
    WITH seen AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed FROM events WHERE event_type <> 'error'),
    days AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, event_type = 'error' AS is_second FROM events)
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end,
           count(*) FILTER (WHERE NOT (is_second AND window_start + INTERVAL 1 DAY <= closed)) AS n,
           count(*) FILTER (WHERE is_second AND window_start + INTERVAL 1 DAY <= closed) AS n_late
    FROM days, seen GROUP BY window_start
    """
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures are delivered after all the rest, together with the rest once more under other names."""
    events = load(spark, sf_dir, "events")
    inbox, root, checkpoint = (new_dir(spark, name) for name in ("inbox", "arrivals", "progress"))
    failed = F.col("event_type") == "error"
    for delivery, rows in enumerate((events.where(~failed), events)):
        rows.write.parquet(f"{inbox}/{delivery}")
        arrived = arrivals.once(ingest.file_stream(spark, f"{inbox}/*", events.schema), ["event_id"])
        arrivals.count_arrivals(arrived, "ts", root, checkpoint).awaitTermination()
    return arrivals.arrival_counts(spark, root)
