"""Rows that are delivered more than once or late: counted once, and late ones apart."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadledger.work import paths, small_frame


def once(rows: DataFrame, ids: Sequence[str], remember: str = "7 days") -> DataFrame:
    """Of rows with equal ids that arrive within ``remember`` of the first, the first.

    The watermark is on the time of the batch, which the stream's own log keeps for batches that are
    tried again. It never runs back, so no row is dropped for coming late, whatever its event time,
    and state holds the ids that arrived in the last ``remember``.
    """
    arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
    return arrived.dropDuplicatesWithinWatermark(list(ids)).drop("_arrived")


def count_arrivals(
    rows: DataFrame,
    ts: str,
    root: str,
    checkpoint: str,
    window: timedelta = timedelta(days=1),
    lateness: timedelta = timedelta(hours=1),
) -> StreamingQuery:
    """Store, per batch, the counts of the windows its rows belong to, on time or late.

    A window is closed once the newest row of the batches before is ``lateness`` past its end; what
    comes after that is late. Each batch keeps how far event time had come, so the next one reads
    that single row, and a batch that is tried again writes the same two folders anew.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _newest(spark, root, batch_id)
        start = _window_start(F.col(ts).cast("timestamp_ntz"), window)
        end = F.timestamp_add("MICROSECOND", F.lit(_micros(window)), F.col("window_start"))
        counts = batch.groupBy(start.alias("window_start")).agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col(ts).cast("timestamp_ntz")).alias("newest")
        )
        closed = F.lit(None if before is None else (before - lateness).isoformat(sep=" ")).cast("timestamp_ntz")
        late = F.coalesce(F.col("window_end") <= closed, F.lit(False))
        part = f"{root}/counts/batch_id={batch_id}"
        counts.withColumn("window_end", end).withColumn("is_late", late).coalesce(1).write.mode("overwrite").parquet(part)
        here = spark.read.parquet(part).agg(F.max("newest")).first()[0]
        upto = max((moment for moment in (before, here) if moment is not None), default=None)
        mark = small_frame(spark, [(upto,)], "newest TIMESTAMP_NTZ")
        mark.write.mode("overwrite").parquet(f"{root}/marks/batch_id={batch_id}")

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrival_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per window: those on time, and those that came after it was closed.

    Rows without a time are on time in a window without bounds, which never closes.
    """
    late = F.col("is_late")
    return spark.read.parquet(f"{root}/counts").groupBy("window_start", "window_end").agg(
        F.sum(F.when(late, 0).otherwise(F.col("n"))).alias("n"),
        F.sum(F.when(late, F.col("n")).otherwise(0)).alias("n_late"),
    )


def _newest(spark: SparkSession, root: str, batch_id: int) -> datetime | None:
    """How far event time had come in the batches before this one."""
    folder = f"{root}/marks/batch_id={batch_id - 1}"
    if not paths(spark, folder):
        return None
    return spark.read.schema("newest TIMESTAMP_NTZ").parquet(folder).first()[0]


def _micros(length: timedelta) -> int:
    return length // timedelta(microseconds=1)


def _window_start(moment: Column, window: timedelta) -> Column:
    """Start of the half-open window; the session's zone has no part in it."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    past = F.timestamp_diff("MICROSECOND", epoch, moment)
    return F.timestamp_add("MICROSECOND", past - F.pmod(past, F.lit(_micros(window))), epoch)
