"""Restartable ingest: every file once, every batch in folders of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files as a stream; ``path`` may be a folder or a pattern for files."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def ingest_new_files(
    rows: DataFrame, root: str, batch_date: Column, checkpoint: str
) -> StreamingQuery:
    """Store what is new below ``batch_date=…/batch_id=…`` and stop when caught up.

    A batch that is tried again replaces only its own folders: its id is part of their name. The
    checkpoint keeps the files that were done, so a second call takes up where the first one ended.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_date", batch_date)
            .withColumn("batch_id", F.lit(batch_id))
            .hint("rebalance", "batch_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_date", "batch_id")
            .parquet(root)
        )

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
