"""Reads and writes: full, windowed, as-of and custom extracts, runs and batches."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.registry import query
from loadledger.catalog.tables import WITH_C, current, load
from loadledger.functions.hashing import fingerprint
from loadledger.operators.progress import all_days
from loadledger.plans.extract import Extractor
from loadledger.plans.spec import TableSpec, read_spec
from loadledger.sinks.ledger import Ledger
from loadledger.sinks.runlog import RunLog
from loadledger.sinks.runs import output_files, write_batches, write_run
from loadledger.sources.asof import as_of
from loadledger.sources.lake import LakeSource
from loadledger.sources.ranges import range_number
from loadledger.sources.runs import read_runs, read_sidecars
from loadledger.work import cut_lineage, new_dir

DAY = date(1997, 5, 28)
MOMENT = datetime(2024, 1, 15, 12)
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "embeddings",
)


@query("SELECT * FROM part")
def full_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_spec(LakeSource(spark, sf_dir), TableSpec("db", "part", is_full_extract=True))


@query(
    """
    SELECT n.n_name, strftime(o.o_orderdate, '%Y%m') AS ym, count(*) AS n_orders
    FROM orders AS o JOIN customer AS c ON o.o_custkey = c.c_custkey
    JOIN nation AS n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1, 2
    """
)
def custom_query_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders are counted per customer before the join, so a customer with very many orders is a
    # handful of rows by then.
    sql = """
        WITH monthly AS (
          SELECT o_custkey, date_format(o_orderdate, 'yyyyMM') AS ym, count(*) AS n
          FROM orders GROUP BY o_custkey, date_format(o_orderdate, 'yyyyMM'))
        SELECT n_name, ym, sum(n) AS n_orders
        FROM monthly JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name, ym
    """
    spec = TableSpec(
        "db", "orders_by_nation", custom_query=sql, query_tables=("orders", "customer", "nation")
    )
    return read_spec(LakeSource(spark, sf_dir), spec)


@query(
    """
    SELECT * FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-05-28 00:00:00'
      AND o_orderdate < TIMESTAMP '1997-05-29 00:00:00'
    """
)
def incremental_window_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("db", "orders", incremental_column="o_orderdate", extraction_date=DAY)
    return read_spec(LakeSource(spark, sf_dir), spec)


@query(
    """
    SELECT 'db.lineitem' AS table_key, 'full' AS mode, count(*) AS n FROM lineitem
    UNION ALL
    SELECT 'db.orders' AS table_key, 'window' AS mode, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-05-28 00:00:00'
      AND o_orderdate < TIMESTAMP '1997-05-29 00:00:00'
    """
)
def first_run_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders succeeded the day before, line items never: what their extracts for one day then take."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger)
    columns = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
    specs = [
        TableSpec("db", table, incremental_column=column, extraction_date=DAY)
        for table, column in columns.items()
    ]
    extractor.extract(replace(specs[0], extraction_date=DAY - timedelta(days=1)))
    mode = F.when(F.col("first"), "full").otherwise("window").alias("mode")
    modes = cut_lineage(extractor.decisions(specs).select("table_key", mode))
    outcomes = extractor.extract_many(specs)
    return modes.join(outcomes, "table_key").select("table_key", "mode", F.col("record_count").alias("n"))


@query(
    """
    SELECT user_id, event_id, event_type, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS newest
      FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00') AS ranked
    WHERE newest = 1
    """
)
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return as_of(versions, ["user_id"], ["ts", "event_id"], MOMENT)


@query(
    """
    SELECT CAST(least(3, (o_orderkey - low) * 4 // (high - low + 1)) AS INTEGER) AS range_no,
           count(*) AS n, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
    FROM orders, (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders) AS bounds
    GROUP BY 1
    """
)
def partitioned_range_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges a parallel database read would use, and what each of them would fetch."""
    orders = load(spark, sf_dir, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    number = range_number(F.col("o_orderkey"), low, high, 4)
    return orders.groupBy(number.alias("range_no")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderkey").alias("min_key"),
        F.max("o_orderkey").alias("max_key"),
    )


def _three_runs(spark: SparkSession, sf_dir: str) -> tuple[Extractor, list[date]]:
    """All events, extracted in three windows of as many days each."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger)
    day = F.to_date("ts")
    first, last = extractor.source.table("events").agg(F.min(day), F.max(day)).first()
    days = (last - first).days // 3 + 1
    window = TableSpec("db", "events", incremental_column="ts", window_hours=24 * days, bootstrap=False)
    starts = [first + timedelta(days=days * n) for n in range(3)]
    extractor.extract_many(
        [replace(window, extraction_date=start) for start in starts], run_id="backfill"
    )
    return extractor, starts


_THIRDS = """
    WITH ends AS (
      SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE) AS span FROM events),
    placed AS (
      SELECT events.*, CAST((CAST(ts AS DATE) - first) // (span // 3 + 1) AS INTEGER) AS third,
             CAST(first + CAST(((CAST(ts AS DATE) - first) // (span // 3 + 1)) * (span // 3 + 1) AS INTEGER) AS DATE)
               AS business_date
      FROM events, ends)
"""


@query(
    _THIRDS
    + """
    SELECT business_date, 'backfill' AS run_id, count(*) AS n, count(DISTINCT event_id) AS n_events
    FROM placed GROUP BY 1
    """
)
def extract_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three windows that cover the table, read back by what the paths say about them."""
    extractor, _ = _three_runs(spark, sf_dir)
    schema = extractor.source.table("events").schema
    runs = read_runs(spark, extractor.root, schema)
    return runs.groupBy("business_date", "run_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_events")
    )


@query(WITH_C + "SELECT table_key, business_date, status, record_count FROM c")
def ledger_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    ledger.append(current(spark, sf_dir, "event_ts", "seq", "status", "record_count"))
    return ledger.transitions().select("table_key", "business_date", "status", "record_count")


@query(
    _THIRDS
    + """
    SELECT CAST(business_date AS TIMESTAMP) AS window_start, count(*) AS record_count,
           count(*) + CASE WHEN third = 1 THEN 1 ELSE 0 END AS stored_records,
           CASE WHEN third = 1 THEN 'size_off' ELSE 'valid' END AS verdict
    FROM placed GROUP BY business_date, third
    """
)
def stored_run_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored runs checked row by row, after the second of them was given a row too many."""
    extractor, starts = _three_runs(spark, sf_dir)
    second = extractor.ledger.current([starts[1]]).first().output_path
    stored = spark.read.parquet(second)
    newest = stored.agg(*[F.max_by(c, "event_id").alias(c) for c in stored.columns])
    newest.write.mode("append").parquet(second)
    return extractor.verify(starts).select(
        "window_start", "record_count", "stored_records", "verdict"
    )


@query(WITH_C + "SELECT table_key, business_date, seq, record_count FROM c WHERE status = 'completed'")
def sidecar_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed states written as JSON run descriptions, and taken from there into a ledger."""
    root = new_dir(spark, "sidecars")
    done = current(spark, sf_dir, "event_ts", "seq", "status", "record_count")
    parts = F.split("table_key", r"\.")
    (
        done.where(F.col("status") == "completed")
        .select(
            F.concat(F.lit("s3://lake/"), "table_key").alias("output_path"),
            "record_count",
            F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("end_time"),
            F.lit(True).alias("extraction_complete"),
            F.struct(
                parts[0].alias("source_name"),
                parts[1].alias("table_name"),
                F.col("business_date").cast("string").alias("extraction_date"),
                F.col("seq").cast("string").alias("run_id"),
            ).alias("table_config"),
        )
        .write.json(root)
    )
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    ledger.append(read_sidecars(spark, root, "*.json", one_per_file=False))
    return ledger.current().select(
        "table_key", "business_date", F.col("run_id").cast("bigint").alias("seq"), "record_count"
    )


@query(
    WITH_C
    + """
    SELECT count(*) AS n_rows, CAST(sum(record_count) AS BIGINT) AS total_records FROM c
    """
)
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second of them sent twice under one id."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    states = current(spark, sf_dir, "event_ts", "seq", "status", "record_count")
    early = F.col("business_date") < F.lit(date(2024, 1, 16))
    ledger.append(states.where(early), append_id="early")
    for _ in range(2):
        ledger.append(states.where(~early), append_id="late")
    return ledger.transitions().agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("record_count").alias("total_records")
    )


@query(
    "\nUNION ALL\n".join(
        f"SELECT 'db.{t}' AS table_key, true AS success, count(*) AS record_count FROM {t}"
        for t in TABLES
    )
)
def multi_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger)
    outcomes = extractor.extract_many([TableSpec("db", t, is_full_extract=True) for t in TABLES])
    return outcomes.select("table_key", "success", "record_count")


_ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
]
# What engines print alike: prices in cents, dates in one layout.
_ORDER_SQL = {name: f"CAST({name} AS VARCHAR)" for name in _ORDER_COLUMNS} | {
    "o_totalprice": "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)",
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')",
}
_ORDER_TEXT = "concat_ws(';', {})".format(
    ", ".join(
        f"coalesce('{name}=' || length({text}) || ':' || {text}, '{name}=~')"
        for name, text in sorted(_ORDER_SQL.items())
    )
)
_ORDER_PRINT = " || ':' || ".join(
    f"CAST(sum(CAST('0x' || substr(md5({_ORDER_TEXT}), {start}, 16) AS UBIGINT)) AS VARCHAR)" for start in (1, 17)
)


def printable_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "o_totalprice": F.round(F.col("o_totalprice") * 100).cast("bigint"),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
    )


@query(f"SELECT count(*) AS n, {_ORDER_PRINT} AS fp FROM orders")
def run_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_dir(spark, 'runs')}/db/orders/199705/28/r1.parquet"
    write_run(load(spark, sf_dir, "orders"), path)
    stored = printable_orders(spark.read.parquet(path))
    return stored.agg(F.count(F.lit(1)).alias("n"), fingerprint(_ORDER_COLUMNS).alias("fp"))


@query(
    "SELECT table_key, n, greatest(1, CAST(ceil(n / 5000.0) AS BIGINT)) AS n_needed, true AS bound_held FROM (\n"
    + "\nUNION ALL\n".join(f"SELECT 'db.{t}' AS table_key, count(*) AS n FROM {t}" for t in TABLES)
    + "\n) AS counts"
)
def output_file_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that runs were really written in, each bounded to 5,000 rows, against what they need."""
    root, per_file = new_dir(spark, "runs"), 5_000
    found = []
    for table in TABLES:
        write_run(load(spark, sf_dir, table), f"{root}/{table}", rows_per_file=per_file)
        stored = spark.read.parquet(f"{root}/{table}").groupBy(F.col("_metadata.file_path").alias("file"))
        files = stored.agg(F.count(F.lit(1)).alias("rows")).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
            F.count(F.lit(1)).alias("n_files"),
            F.coalesce(F.max("rows"), F.lit(0)).alias("most"),
        )
        found.append(files.withColumn("table_key", F.lit(f"db.{table}")))
    needed = output_files(F.col("n"), per_file)
    held = (F.col("most") <= per_file) & ((F.col("n") == 0) | (F.col("n_files") >= needed))
    return reduce(DataFrame.unionByName, found).select(
        "table_key", "n", needed.alias("n_needed"), held.alias("bound_held")
    )


@query(
    """
    SELECT d.business_date, count(o.o_orderkey) AS n, count(o.o_orderkey) = 0 AS is_empty
    FROM (SELECT CAST(unnest(generate_series(
            (SELECT CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders),
            (SELECT CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders), INTERVAL 1 DAY)) AS DATE)
          AS business_date) AS d
    LEFT JOIN orders AS o ON CAST(o.o_orderdate AS DATE) = d.business_date
    GROUP BY 1
    """
)
def empty_window_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every daily window with its record count; a day without orders is a success with 0."""
    orders = load(spark, sf_dir, "orders")
    counts = orders.groupBy(F.to_date("o_orderdate").alias("business_date")).agg(
        F.count("o_orderkey").alias("found")
    )
    n = F.coalesce("found", F.lit(0))
    return all_days(orders, "o_orderdate").join(counts, "business_date", "left").select(
        "business_date", n.alias("n"), (n == 0).alias("is_empty")
    )


@query(
    """
    SELECT d.day AS business_date, count(o.o_orderkey) AS record_count, 'completed' AS status,
           count(o.o_orderkey) > 0 AS has_output
    FROM (SELECT unnest([CAST(min(o_orderdate) AS DATE) - 1, CAST(min(o_orderdate) AS DATE),
                         CAST(max(o_orderdate) AS DATE) + 1]) AS day FROM orders) AS d
    LEFT JOIN orders AS o ON CAST(o.o_orderdate AS DATE) = d.day
    GROUP BY 1
    """
)
def empty_window_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows before, at and after the orders, extracted: empty ones are done, and store nothing."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger)
    day = F.to_date("o_orderdate")
    first, last = extractor.source.table("orders").agg(F.min(day), F.max(day)).first()
    spec = TableSpec("db", "orders", incremental_column="o_orderdate", bootstrap=False)
    days = [first - timedelta(days=1), first, last + timedelta(days=1)]
    extractor.extract_many([replace(spec, extraction_date=d) for d in days])
    has_output = F.col("output_path").isNotNull().alias("has_output")
    return ledger.current().select("business_date", "record_count", "status", has_output)


@query("SELECT CAST(ts AS DATE) AS batch_date, count(*) AS n FROM events GROUP BY 1")
def batch_partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days as batches; one of them is run again under the same run id and changes nothing."""
    root = new_dir(spark, "batches")
    events = load(spark, sf_dir, "events")
    day = F.to_date("ts")
    write_batches(events, root, day, "r1")
    write_batches(events.where(day == F.lit(MOMENT.date())), root, day, "r1")
    return spark.read.parquet(root).groupBy("batch_date").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(l_shipdate AS DATE) AS business_date, count(*) AS n FROM lineitem GROUP BY 1")
def record_counts_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate").alias("business_date")
    return lineitem.groupBy(day).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT o_orderkey AS order_key, CAST(o_custkey AS VARCHAR) AS customer, 'i' AS version, NULL AS status FROM orders
    UNION ALL
    SELECT o_orderkey, CAST(o_custkey + 10000000000 AS VARCHAR), 'l', NULL FROM orders
    UNION ALL
    SELECT o_orderkey, concat('c', o_custkey), 't', o_orderstatus FROM orders
    """
)
def evolved_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table whose column went from int to bigint to text, was spelt anew and got a neighbour, read whole."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger, allow_type_changes=True)
    texts = [
        "SELECT o_orderkey AS order_key, CAST(o_custkey AS INT) AS customer, 'i' AS version FROM orders",
        "SELECT o_orderkey AS order_key, o_custkey + 10000000000 AS CUSTOMER, 'l' AS version FROM orders",
        "SELECT o_orderkey AS order_key, concat('c', o_custkey) AS customer, 't' AS version, o_orderstatus AS status FROM orders",
    ]
    days = [DAY + timedelta(days=k) for k in range(len(texts))]
    extractor.extract_many(
        [TableSpec("db", "sales", custom_query=t, query_tables=("orders",), extraction_date=d) for t, d in zip(texts, days)]
    )
    return ledger.read("db.sales", days)


@query(
    """
    SELECT 'db.supplier' AS table_key, 'completed' AS status, count(*) AS n, NULL AS error, 'PARTIAL' AS run_status FROM supplier
    UNION ALL SELECT 'db.part', 'completed', count(*), NULL, 'PARTIAL' FROM part
    UNION ALL SELECT 'db.pairs', 'failed', NULL, 'cancelled: over the limit of 3 seconds', 'PARTIAL'
    """
)
def bounded_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table past its limit is cancelled alone, and the run says that it is partial."""
    ledger, log = Ledger(spark, new_dir(spark, "ledger")), RunLog(spark, new_dir(spark, "log"))
    extractor = Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger, run_log=log, scheduler_pool="extracts")
    endless = "SELECT r_name FROM range(0, 100000000000000, 1, 1) JOIN region ON r_regionkey = id % 7 + 8"
    specs = [TableSpec("db", table, is_full_extract=True, extraction_date=DAY) for table in ("supplier", "part")]
    specs.append(TableSpec("db", "pairs", custom_query=endless, query_tables=("region",), extraction_date=DAY, limit_seconds=3))
    extractor.extract_many(specs, run_id="r1")
    runs = log.runs([DAY]).select("run_id", "run_status")
    return ledger.current([DAY]).join(runs, "run_id").select(
        "table_key", "status", F.col("record_count").alias("n"), F.col("error_message").alias("error"), "run_status"
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers,
           min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY 1, 2
    """
)
def even_range_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read range by range of orders, each range a run of its own, then added up."""
    reads = LakeSource(spark, sf_dir).in_ranges("lineitem", "l_orderkey", 6)
    folders = [new_dir(spark, "range") for _ in reads]
    for rows, folder in zip(reads, folders):
        write_run(rows, folder, pack=True)
    stored = spark.read.schema(reads[0].schema).parquet(*folders)
    return stored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").alias("orders"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )
