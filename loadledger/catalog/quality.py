"""Rules, quarantine, drift, manifests, integrity and window conformance over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.catalog.registry import query
from loadledger.catalog.tables import load
from loadledger.operators import quality
from loadledger.operators.differences import differing_keys
from loadledger.plans.extract import Extractor
from loadledger.plans.spec import TableSpec
from loadledger.sinks.ledger import Ledger
from loadledger.sinks.runs import write_batches, write_run
from loadledger.sources.lake import LakeSource
from loadledger.work import cut_lineage, new_dir

_RULES_SQL = """
SELECT d.doc_id, d.lang, d.text IS NULL OR trim(d.text) = '' AS no_text,
       l.quality IS NULL AS no_quality,
       coalesce(l.quality = 1 AND d.n_chars < 20, false) AS too_short
FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id
"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels. Texts are judged before the join and do not travel through it."""
    blank = quality.is_blank(F.col("text")).alias("blank_text")
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", blank)
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left")


def _rules() -> dict[str, Column]:
    return {
        "text is required": F.col("blank_text"),
        "quality is required": F.col("quality").isNull(),
        "good text has 20 characters": (F.col("quality") == 1) & (F.col("n_chars") < 20),
    }


@query(
    f"""
    WITH r AS ({_RULES_SQL})
    SELECT doc_id, 'text is required' AS violation FROM r WHERE no_text
    UNION ALL SELECT doc_id, 'quality is required' AS violation FROM r WHERE no_quality
    UNION ALL SELECT doc_id, 'good text has 20 characters' AS violation FROM r WHERE too_short
    """
)
def row_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(_documents(spark, sf_dir), ["doc_id"], _rules())


@query(
    f"""
    WITH r AS ({_RULES_SQL})
    SELECT lang, count(*) FILTER (NOT (no_text OR no_quality OR too_short)) AS n_accepted,
           count(*) FILTER (no_text OR no_quality OR too_short) AS n_rejected
    FROM r GROUP BY lang
    """
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = quality.judged(_documents(spark, sf_dir), _rules())
    return marked.groupBy("lang").agg(
        F.count_if("is_valid").alias("n_accepted"), F.count_if(~F.col("is_valid")).alias("n_rejected")
    )


@query(
    """
    WITH columns AS (
      SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'long' WHEN 'DOUBLE' THEN 'double'
               WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS type
      FROM (DESCRIBE SELECT * FROM orders) AS described),
    runs AS (
      SELECT 1 AS run_no, name, type FROM columns WHERE name <> 'o_orderpriority'
      UNION ALL SELECT 2 AS run_no, name, type FROM columns
      UNION ALL SELECT 3 AS run_no, name,
                       CASE name WHEN 'o_totalprice' THEN 'decimal(15,2)' ELSE type END AS type
                FROM columns WHERE name <> 'o_orderstatus'),
    pairs AS (
      SELECT coalesce(new.run_no, old.run_no + 1) AS run_no, coalesce(new.name, old.name) AS name,
             new.type AS new_type, old.type AS old_type
      FROM runs AS new FULL JOIN runs AS old ON new.run_no = old.run_no + 1 AND new.name = old.name)
    SELECT 'db.orders' AS table_name, CAST(run_no AS INTEGER) AS run_no, name AS "column", new_type, old_type,
           CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'removed'
                WHEN old_type <> new_type THEN 'type_changed' ELSE 'same' END AS change,
           coalesce(old_type <> new_type, false) AS is_error
    FROM pairs WHERE run_no BETWEEN 2 AND 3
    """
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of all tables of a ledger: orders were extracted three times in other shapes, lines once."""
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    source = LakeSource(spark, sf_dir)
    extractor = Extractor(source, new_dir(spark, "runs"), ledger, allow_type_changes=True)
    columns = source.table("orders").columns
    price = "CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice"
    shapes = [
        [name for name in columns if name != "o_orderpriority"],
        columns,
        [price if name == "o_totalprice" else name for name in columns if name != "o_orderstatus"],
    ]
    for day, names in enumerate(shapes, start=1):
        sql = f"SELECT {', '.join(names)} FROM orders"
        spec = TableSpec("db", "orders", custom_query=sql, query_tables=("orders",), extraction_date=date(2024, 1, day))
        extractor.extract(spec)
    counted = "SELECT count(*) AS n FROM lineitem"
    extractor.extract(
        TableSpec("db", "lines", custom_query=counted, query_tables=("lineitem",), extraction_date=date(2024, 1, 1))
    )
    done = ledger.transitions().where(F.col("status") == "completed")
    return quality.schema_drift(quality.schema_rows(done))


@query(
    """
    SELECT CAST(ts AS DATE) AS batch_date, CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) AS changed
    FROM events GROUP BY 1, 2
    """
)
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of all events, listed before and after a file was added to the last of them."""
    root = new_dir(spark, "batches")
    events = load(spark, sf_dir, "events")
    write_batches(events, root, F.to_date("ts"), "r1")
    pattern = r"batch_date=[^/]+/run_id=[^/]+"
    before = cut_lineage(quality.file_manifest(spark, root, pattern))
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    events.where(F.to_date("ts") == F.lit(last)).write.mode("append").parquet(
        f"{root}/batch_date={last}/run_id=r1"
    )
    changed = quality.changed_runs(before, quality.file_manifest(spark, root, pattern))
    day = F.to_date(F.regexp_extract("run", r"batch_date=([^/]+)/", 1))
    return changed.select(day.alias("batch_date"), "changed")


@query(
    """
    WITH recorded AS (
      SELECT CAST(o_orderdate AS DATE) AS business_date, count(*) AS recorded FROM orders GROUP BY 1),
    actual AS (
      SELECT CAST(o_orderdate AS DATE) AS business_date, count(*) AS actual FROM orders
      WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
    SELECT r.business_date, r.recorded, a.actual,
           CASE WHEN a.actual IS NULL THEN 'missing'
                WHEN a.actual <> r.recorded THEN 'size_off'
                ELSE 'valid' END AS verdict
    FROM recorded AS r LEFT JOIN actual AS a ON r.business_date = a.business_date
    """
)
def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders recorded per day against those that arrived with line items."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("business_date")
    )
    arrived = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    recorded = orders.groupBy("business_date").agg(F.count(F.lit(1)).alias("recorded"))
    actual = (
        orders.join(arrived.distinct(), "o_orderkey", "left_semi")
        .groupBy("business_date")
        .agg(F.count(F.lit(1)).alias("actual"))
    )
    worth = quality.verdict(F.col("recorded"), F.col("actual"))
    return recorded.join(actual, "business_date", "left").withColumn("verdict", worth)


@query(
    """
    SELECT o_orderkey, count(l_shipdate) AS n_checked,
           count(*) FILTER (l_shipdate < o_orderdate
                            OR l_shipdate >= o_orderdate + INTERVAL 365 DAY) AS n_outside
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """
)
def window_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items shipped outside the year that starts with their order.

    Lines are counted per order and ship date before the join, so a huge order is as many rows as it
    has ship dates.
    """
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_shipdate")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shipped = lines.agg(F.count(F.lit(1)).alias("n"))
    start = F.col("o_orderdate")
    return quality.outside_window(
        shipped.join(orders, shipped.l_orderkey == orders.o_orderkey),
        ["o_orderkey"],
        F.col("l_shipdate"),
        start,
        start + F.make_interval(days=F.lit(365)),
        F.col("n"),
    )


@query(
    """
    SELECT o_orderkey, count(l_shipdate) AS n_checked,
           count(*) FILTER (l_shipdate < o_orderdate
                            OR l_shipdate >= o_orderdate + INTERVAL 30 DAY) AS n_outside,
           count(*) FILTER (l_shipdate < o_orderdate
                            OR l_shipdate >= o_orderdate + INTERVAL 30 DAY) = 0 AS is_consistent
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """
)
def window_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all lines of an order were shipped within 30 days of it."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_shipdate")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shipped = lines.agg(F.count(F.lit(1)).alias("n"))
    start = F.col("o_orderdate")
    return quality.window_report(
        shipped.join(orders, shipped.l_orderkey == orders.o_orderkey),
        ["o_orderkey"],
        F.col("l_shipdate"),
        start,
        start + F.make_interval(days=F.lit(30)),
        F.col("n"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate AS window_start,
           o_orderdate + INTERVAL 30 DAY AS window_end
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_shipdate < o_orderdate OR l_shipdate >= o_orderdate + INTERVAL 30 DAY
    """
)
def window_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines shipped outside the 30 days of their order, with that window."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    start = F.col("o_orderdate")
    outside = quality.outside_rows(
        lines.join(orders, lines.l_orderkey == orders.o_orderkey),
        F.col("l_shipdate"),
        start,
        start + F.make_interval(days=F.lit(30)),
    )
    return outside.drop("o_orderkey", "o_orderdate")


@query(
    """
    SELECT CAST(ts AS DATE) AS batch_date, count(*) AS n,
           CASE WHEN CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events) THEN 1 ELSE 0 END
             AS n_unreadable
    FROM events GROUP BY 1
    """
)
def unreadable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of all events, with one file among those of one day that is no Parquet file."""
    root = new_dir(spark, "batches")
    events = load(spark, sf_dir, "events")
    write_batches(events, root, F.to_date("ts"), "r1")
    first = events.agg(F.min(F.to_date("ts"))).first()[0]
    spoiled = f"{root}/batch_date={first}/run_id=r1"
    spark.range(1).selectExpr("'no table'").coalesce(1).write.mode("append").text(spoiled)
    day = F.to_date(F.regexp_extract("path", r"batch_date=([^/]+)/", 1)).alias("batch_date")
    broken = quality.unreadable_files(spark, root, events.schema).groupBy(day)
    counts = (
        spark.read.schema(events.schema)
        .option("recursiveFileLookup", True)
        .option("ignoreCorruptFiles", True)
        .parquet(root)
        .groupBy(F.to_date("ts").alias("batch_date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.join(
        broken.agg(F.count(F.lit(1)).cast("int").alias("found")), "batch_date", "left"
    ).select("batch_date", "n", F.coalesce("found", F.lit(0)).alias("n_unreadable"))


@query(
    """
    WITH after AS (
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'F'
      UNION ALL SELECT -o_orderkey, o_custkey FROM orders
      WHERE o_orderdate >= TIMESTAMP '1998-07-01 00:00:00')
    SELECT coalesce(o.o_orderkey, a.o_orderkey) AS o_orderkey,
           CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN a.o_orderkey IS NULL THEN 'missing' ELSE 'changed' END AS change
    FROM orders AS o FULL JOIN after AS a ON o.o_orderkey = a.o_orderkey
    WHERE o.o_orderkey IS NULL OR a.o_orderkey IS NULL OR o.o_custkey <> a.o_custkey
    """
)
def run_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of two runs, of which the second lost, gained and changed some."""
    columns = ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    orders = load(spark, sf_dir, "orders")
    customer = F.col("o_custkey")
    changed = orders.where("o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'F'").withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") == "P", customer + 1).otherwise(customer)
    )
    late = orders.where("o_orderdate >= TIMESTAMP_NTZ '1998-07-01 00:00:00'").withColumn("o_orderkey", -F.col("o_orderkey"))
    runs = [new_dir(spark, "run") for _ in range(2)]
    write_run(orders.select(*columns), runs[0])
    write_run(changed.select(*columns).unionByName(late.select(*columns)), runs[1])
    before, after = (spark.read.parquet(path) for path in runs)
    return differing_keys(before, after, ["o_orderkey"])
