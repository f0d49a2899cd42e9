"""Column builders over whole tables: windows, keys, paths, ids, durations, text dates, hashes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.extracts import _ORDER_COLUMNS, _ORDER_PRINT, _ORDER_TEXT, printable_orders
from loadledger.catalog.registry import query
from loadledger.catalog.tables import WITH_X, load, transitions
from loadledger.functions import columns, hashing, windows


@query(
    """
    SELECT h.hours, w.day AS window_start, w.day + h.hours * INTERVAL 1 HOUR AS window_end
    FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events) AS w,
         (SELECT CAST(unnest([24, 6]) AS INTEGER) AS hours) AS h
    """
)
def day_window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = load(spark, sf_dir, "events").select(F.to_date("ts").alias("ts")).distinct()
    lengths = days.select("ts", F.explode(F.array(F.lit(24), F.lit(6))).alias("hours"))
    return lengths.select(
        "hours",
        windows.window_start(F.col("ts")).alias("window_start"),
        windows.window_end(F.col("ts"), F.col("hours")).alias("window_end"),
    )


@query(
    """
    SELECT event_id, ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
           AS in_window FROM events
    """
)
def in_window_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = windows.instant(datetime(2024, 1, 15, 12))
    inside = windows.in_window(
        F.col("ts"), windows.window_start(moment), windows.window_end(moment)
    )
    return load(spark, sf_dir, "events").select("event_id", inside.alias("in_window"))


@query(
    """
    SELECT l.l_orderkey, l.l_linenumber,
           coalesce(CAST(l.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE), true) AS is_current
    FROM lineitem AS l LEFT JOIN orders AS o ON l.l_orderkey = o.o_orderkey
    """
)
def window_current_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing follows the join, so adaptive execution may split an order key that is too hot."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    current = windows.same_day(F.col("l_shipdate"), F.col("o_orderdate"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").select(
        "l_orderkey", "l_linenumber", current.alias("is_current")
    )


@query(
    """
    SELECT o_orderkey, concat('s3://lake/db/orders/', strftime(o_orderdate, '%Y%m/%d/'), 'run_',
           o_orderkey, '.parquet') AS output_path FROM orders
    """
)
def run_output_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = F.concat(F.lit("run_"), F.col("o_orderkey"))
    path = columns.run_path("s3://lake", F.lit("db"), F.lit("orders"), F.col("o_orderdate"), run)
    return load(spark, sf_dir, "orders").select("o_orderkey", path.alias("output_path"))


@query(
    """
    SELECT n.n_nationkey, concat_ws('.', 'db', CASE WHEN r.r_regionkey > 0 THEN r.r_name END, n.n_name)
           AS table_key
    FROM nation AS n JOIN region AS r ON n.n_regionkey = r.r_regionkey
    """
)
def table_key_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    schema = F.when(F.col("r_regionkey") == 0, "").otherwise(F.col("r_name"))
    key = columns.table_key(F.lit("db"), schema, F.col("n_name"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", key.alias("table_key")
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events")
def run_id_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    run_id = columns.run_id_text(F.col("ts"))
    return load(spark, sf_dir, "events").select("event_id", run_id.alias("run_id"))


@query(
    """
    SELECT user_id, CAST(ts AS DATE) AS business_date,
           CASE WHEN count(*) > 1 THEN date_diff('microsecond', min(ts), max(ts)) / 1000000.0 END
             AS duration_seconds
    FROM events GROUP BY 1, 2
    """
)
def duration_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = load(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("business_date"))
    spans = ends.agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count(F.lit(1)).alias("n"))
    finished = F.when(F.col("n") > 1, F.col("b"))
    return spans.select(
        "user_id",
        "business_date",
        columns.seconds_between(F.col("a"), finished).alias("duration_seconds"),
    )


@query(
    WITH_X
    + """
    SELECT seq, status IN ('completed', 'failed', 'skipped') AS is_complete,
           status IN ('running', 'retrying') AS is_running FROM x
    """
)
def status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("status")
    return transitions(spark, sf_dir).select(
        "seq",
        columns.is_finished(status).alias("is_complete"),
        columns.is_running(status).alias("is_running"),
    )


@query(
    """
    SELECT run_status, run_status IN ('completed', 'failed', 'cancelled') AS is_over, count(*) AS n
    FROM (SELECT unnest(['idle', 'running', 'completed', 'failed', 'paused', 'cancelled']) AS run_status) AS s
    JOIN events ON true GROUP BY 1, 2
    """
)
def run_status_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once for each status a whole run can have."""
    statuses = F.explode(F.array(*[F.lit(status) for status in columns.RUN_STATUSES])).alias("run_status")
    rows = load(spark, sf_dir, "events").select(statuses)
    over = columns.is_run_over(F.col("run_status")).alias("is_over")
    return rows.groupBy("run_status", over).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso_text, ts FROM events
    """
)
def iso_timestamp_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = load(spark, sf_dir, "events").select(
        "event_id", columns.iso_text(F.col("ts")).alias("iso_text")
    )
    return texts.withColumn("ts", columns.parse_iso(F.col("iso_text")))


@query(
    """
    SELECT o_orderkey, raw, TRY_CAST(CASE WHEN raw NOT LIKE '%/%' THEN raw END AS DATE) AS parsed,
           TRY_CAST(CASE WHEN raw NOT LIKE '%/%' THEN raw END AS DATE) IS NULL AS is_error
    FROM (SELECT o_orderkey, CASE o_orderpriority
            WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d')
            WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-13-%d')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw
          FROM orders) AS texts
    """
)
def strict_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders carry another layout and low ones a thirteenth month."""
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate")
    raw = (
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy/MM/dd"))
        .when(priority == "5-LOW", F.date_format(day, "yyyy-'13'-dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    texts = load(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    parsed = texts.withColumn("parsed", columns.parse_day(F.col("raw")))
    return parsed.withColumn("is_error", F.col("parsed").isNull())


@query(
    """
    SELECT doc_id, raw_path, CASE
             WHEN regexp_matches(raw_path, '^((s3|abfss|adl|gs)://|/dbfs/)') THEN raw_path
             ELSE '/dbfs/' || regexp_replace(raw_path, '^/', '') END AS norm_path
    FROM (SELECT doc_id, concat(CASE lang WHEN 'en' THEN 's3://' WHEN 'fr' THEN '/'
                                          WHEN 'de' THEN '/dbfs/' ELSE '' END, source) AS raw_path
          FROM documents) AS paths
    """
)
def normalize_storage_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of a document decides how its path begins."""
    lang = F.col("lang")
    start = F.when(lang == "en", "s3://").when(lang == "fr", "/").when(lang == "de", "/dbfs/")
    raw = F.concat(start.otherwise(""), F.col("source"))
    paths = load(spark, sf_dir, "documents").select("doc_id", raw.alias("raw_path"))
    return paths.withColumn("norm_path", columns.storage_path(F.col("raw_path")))


@query(f"SELECT o_orderkey, md5({_ORDER_TEXT}) AS h FROM orders")
def row_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = printable_orders(load(spark, sf_dir, "orders"))
    key = F.col("o_orderkey")
    return orders.select(key, hashing.row_hash(_ORDER_COLUMNS).alias("h"))


@query(
    f"""
    SELECT strftime(o_orderdate, '%Y%m') AS ym, count(*) AS n, {_ORDER_PRINT} AS fp
    FROM orders GROUP BY 1
    """
)
def dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyyMM")
    dated = load(spark, sf_dir, "orders").withColumn("ym", month)
    prints = printable_orders(dated).groupBy("ym")
    return prints.agg(F.count(F.lit(1)).alias("n"), hashing.fingerprint(_ORDER_COLUMNS).alias("fp"))
