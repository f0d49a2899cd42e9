"""Plans and skew: what must hold whatever the size of the data."""

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadledger.catalog.tables import LOG_KEY, ORDER, as_log
from loadledger.operators.latest import latest
from loadledger.operators.progress import table_lists
from loadledger.operators.running import number_rows, running_sums
from loadledger.operators.state import fold
from loadledger.plans.spec import TableSpec, read_spec
from loadledger.sinks.runs import write_batches
from loadledger.sources.lake import LakeSource
from loadledger.sources.runs import list_files
from loadledger.work import new_dir


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, sf_dir):
    """Events of which more than a third belong to one user."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("user_id", F.when(F.col("event_type").isin("view", "click"), 7).otherwise(F.col("user_id")))


def test_window_reaches_the_scan(spark, sf_dir):
    spec = TableSpec("db", "orders", incremental_column="o_orderdate", extraction_date=datetime(1997, 5, 28).date())
    rows = read_spec(LakeSource(spark, sf_dir), spec).select("o_orderkey")
    text = plan_of(rows)
    assert "GreaterThanOrEqual(o_orderdate,1997-05-28T00:00)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_batches_are_pruned_by_date(spark, sf_dir):
    root = new_dir(spark, "batches")
    write_batches(spark.read.parquet(f"{sf_dir}/events.parquet"), root, F.to_date("ts"), "r1")
    rows = spark.read.parquet(root).where("batch_date = DATE '2024-01-15'")
    assert "PartitionFilters: [isnotnull(batch_date" in plan_of(rows)
    read = rows.select(F.input_file_name().alias("file")).distinct().collect()
    assert read and all("batch_date=2024-01-15" in row.file for row in read)


def test_numbering_a_hot_key_equals_a_window(spark, sf_dir):
    events = skewed(spark, sf_dir).select("user_id", "ts", "event_id")
    plain = events.withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    sliced = number_rows(events, ["user_id"], ["ts", "event_id"], "n", slices=16)
    assert sorted(sliced.collect()) == sorted(plain.withColumn("n", F.col("n").cast("bigint")).collect())


def test_numbering_keeps_null_keys_and_ties(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 600, None).otherwise(F.col("id") % 3).alias("k"), "id")
    numbered = number_rows(rows, ["k"], ["id"], "n", slices=9).groupBy("k").agg(
        F.count("*").alias("c"), F.countDistinct("n").alias("d"), F.max("n").alias("m")
    )
    assert all(r.c == r.d == r.m for r in numbered.collect())


def test_running_sums_of_a_hot_key_equal_a_window(spark, sf_dir):
    events = skewed(spark, sf_dir).select("user_id", "ts", "event_id", F.col("event_id").alias("a"), F.lit(1).alias("b"))
    upto = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    plain = events.withColumns({"a": F.sum("a").over(upto), "b": F.sum("b").over(upto)})
    sliced = running_sums(events, ["user_id"], ["ts", "event_id"], ["a", "b"], slices=16)
    assert sliced.columns == events.columns
    assert sorted(sliced.collect()) == sorted(plain.collect())


def test_few_rows_are_one_slice(spark):
    rows = running_sums(spark.range(200), [], ["id"], ["id"])
    assert rows.rdd.getNumPartitions() <= 8
    assert max(r.id for r in rows.collect()) == 199 * 100


def test_no_slice_of_a_hot_key_is_large(spark, sf_dir):
    events = skewed(spark, sf_dir).select("user_id", "ts", "event_id")
    sizes = (
        events.repartitionByRange(16, "user_id", "ts", "event_id")
        .groupBy(F.spark_partition_id().alias("p"))
        .count()
        .agg(F.max("count"))
        .first()[0]
    )
    hot = events.where("user_id = 7").count()
    assert hot > events.count() / 3
    assert sizes < hot / 3


def test_hot_keys_shrink_before_the_shuffle(spark, sf_dir):
    log = as_log(skewed(spark, sf_dir))
    for result in (latest(log, LOG_KEY, ORDER), fold(log, LOG_KEY, carried=("props",))):
        text = plan_of(result)
        assert text.count("Exchange") == 1
        assert "partial_max_by" in text.split("Exchange")[1]


def test_long_lists_come_in_parts(spark):
    state = spark.range(2500).select(
        F.lit("r").alias("run"), F.format_string("t%05d", "id").alias("table_key"), F.lit("completed").alias("status")
    )
    parts = [r for r in table_lists(state, ["run"], chunk=1000).collect() if r.list == "succeeded"]
    parts.sort(key=lambda r: r.part)
    assert [(r.part, r.n) for r in parts] == [(0, 1000), (1, 1000), (2, 500)]
    assert ",".join(r.tables for r in parts).split(",") == [f"t{i:05d}" for i in range(2500)]


def test_a_big_day_is_split_into_files(spark):
    root = new_dir(spark, "batches")
    write_batches(spark.range(10_000), root, F.lit("2024-01-01").cast("date"), "r1", rows_per_file=3000)
    assert list_files(spark, root, "*.parquet").count() >= 4
    assert spark.read.parquet(root).count() == 10_000
