"""Starts joined with their ends while both stream in, and starts that nothing ended."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.functions.columns import is_finished, is_running


def attempts(
    transitions: DataFrame,
    keys: Sequence[str],
    limit: str = "6 hours",
    lateness: str = "1 hour",
) -> DataFrame:
    """Each start with the first end of its key, after it and at most ``limit`` later.

    An end closes all starts of its key that are open: the later ones were retries of the first. A
    start without an end inside the limit was left behind by a crash and comes out as abandoned. It
    can come out only once the watermarks of starts and ends have both passed its limit, and so do
    the others. State holds the transitions of one limit and lateness, whatever the length of the
    stream. Rows without a key or a time match nothing: without a key they come out as abandoned,
    without a time not at all.
    """
    timed = transitions.where("event_ts IS NOT NULL").withColumn("moment", F.col("event_ts").cast("timestamp"))
    starts = (
        timed.where(is_running(F.col("status")))
        .select(*keys, F.col("moment").alias("started"))
        .withWatermark("started", lateness)
    )
    ends = (
        timed.where(is_finished(F.col("status")))
        .select(
            *[F.col(key).alias(f"end_{n}") for n, key in enumerate(keys)],
            F.col("moment").alias("ended"),
            F.col("status").alias("end_status"),
        )
        .withWatermark("ended", lateness)
    )
    same = F.lit(True)
    for n, key in enumerate(keys):
        same = same & (F.col(key) == F.col(f"end_{n}"))
    within = (F.col("ended") > F.col("started")) & (F.col("ended") <= F.col("started") + F.expr(f"INTERVAL {limit}"))
    end = F.when(F.col("ended").isNotNull(), F.struct("ended", "end_status"))
    first = starts.join(ends, same & within, "left_outer").groupBy(*keys, "started").agg(F.min(end).alias("end"))
    return first.select(
        *keys,
        F.col("started").cast("timestamp_ntz").alias("start_ts"),
        F.col("end.ended").cast("timestamp_ntz").alias("end_ts"),
        F.col("end.end_status").alias("end_status"),
        F.col("end").isNull().alias("is_abandoned"),
    )
