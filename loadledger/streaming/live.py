"""The present state of every table, kept up to date from a stream of transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadledger.operators.latest import latest
from loadledger.work import delete, paths


def follow_states(
    transitions: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    root: str,
    checkpoint: str,
    merge_after: int = 20,
) -> StreamingQuery:
    """Store, per batch, the new state of the keys that changed in it.

    After ``merge_after`` batches what is stored becomes one table of all states, and the folders it
    came from are deleted. That happens before a batch is stored, from committed batches only, so a
    batch that is tried again finds or makes the same table.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        _merge(batch.sparkSession, root, keys, batch_id, merge_after)
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{root}/delta/batch_id={batch_id}")

    return (
        latest(transitions, keys, order)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _merge(spark: SparkSession, root: str, keys: Sequence[str], batch_id: int, after: int) -> None:
    base, deltas = _stored(spark, root)
    done = [number for number in deltas if number < batch_id]
    if len(done) >= after:
        upto = max(done)
        _states(spark, root, keys, base, done).drop("batch_id").hint("rebalance").write.mode("overwrite").parquet(
            f"{root}/base/batch_id={upto}"
        )
        base = upto
    # What a table of all states stands for can go, also after a crash in between.
    for number in done:
        if base is not None and number <= base:
            delete(spark, f"{root}/delta/batch_id={number}")
    for number in _numbers(spark, f"{root}/base"):
        if base is not None and number < base:
            delete(spark, f"{root}/base/batch_id={number}")


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Batches whose folder was written to the end."""
    return sorted(
        int(path.split("batch_id=")[1].split("/")[0]) for path in paths(spark, f"{folder}/batch_id=*/_SUCCESS")
    )


def _stored(spark: SparkSession, root: str) -> tuple[int | None, list[int]]:
    """The newest table of all states, and the batches after it."""
    base = max(_numbers(spark, f"{root}/base"), default=None)
    return base, _numbers(spark, f"{root}/delta")


def _states(spark: SparkSession, root: str, keys: Sequence[str], base: int | None, deltas: list[int]) -> DataFrame:
    folders = [f"{root}/delta/batch_id={n}" for n in deltas if base is None or n > base]
    folders += [] if base is None else [f"{root}/base/batch_id={base}"]
    batch = F.regexp_extract("_metadata.file_path", r"batch_id=(\d+)/", 1).cast("bigint").alias("batch_id")
    return latest(spark.read.parquet(*folders).select("*", batch), keys, ["batch_id"])


def live_states(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The newest stored state of each key."""
    return _states(spark, root, keys, *_stored(spark, root)).drop("batch_id")
