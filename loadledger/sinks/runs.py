"""Writing runs: Parquet at a fixed path, counted and fingerprinted while it is written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loadledger.functions.hashing import quick_fingerprint


@dataclass(frozen=True)
class Written:
    """What went into a run, taken from the rows that were written and not from a second read."""

    records: int
    fingerprint: str


def write_run(
    df: DataFrame, path: str, rows_per_file: int | None = None, pack: bool = False
) -> Written:
    """Write one run at a path of its own, which must not exist yet.

    Tasks write side by side, so files have the size of the splits they were read from. Set ``pack``
    when a selective filter leaves little in each of many tasks: the rows are then evened out into
    files of the size Spark advises for a partition. ``rows_per_file`` is a bound besides.
    """
    rows = df.hint("rebalance") if pack else df
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        quick_fingerprint(df.schema).alias("fingerprint"),
    )
    counted.write.option("maxRecordsPerFile", rows_per_file or 0).parquet(path)
    got = seen.get
    return Written(got["records"], got["fingerprint"])


def write_batches(
    df: DataFrame, root: str, batch_date: Column, run_id: str, rows_per_file: int | None = None
) -> None:
    """Store rows below ``batch_date=…/run_id=…``, replacing only the folders this call fills.

    The rebalance gathers each date into few files and splits a date that is too big for one task.
    """
    (
        df.withColumn("batch_date", batch_date)
        .withColumn("run_id", F.lit(run_id))
        .hint("rebalance", "batch_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file or 0)
        .partitionBy("batch_date", "run_id")
        .parquet(root)
    )


def output_files(records: Column, per_file: int = 500_000) -> Column:
    """How many files a run of this many records needs when none may hold more than ``per_file``."""
    return F.greatest(F.lit(1), F.ceil(records / F.lit(per_file))).cast("bigint")
