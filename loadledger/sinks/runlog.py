"""A log of whole runs: what was started when, under which name, and how it ended."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger.operators.progress import resume_run, run_log
from loadledger.sinks.ledger import Ledger
from loadledger.work import paths, small_frame

# The words for how a run stands.
STARTED, ENDED = "STARTED", ("SUCCESS", "PARTIAL", "FAILED", "CANCELLED")

RUN_SCHEMA = (
    T.StructType()
    .add("seq", T.LongType())
    .add("run_id", T.StringType())
    .add("name", T.StringType())
    .add("event_ts", T.TimestampNTZType())
    .add("run_status", T.StringType())
    .add("attempted", T.LongType())
    .add("succeeded", T.LongType())
    .add("failed", T.LongType())
    .add("records", T.LongType())
    .add("business_date", T.DateType())
)
_FIGURES = ("attempted", "succeeded", "failed", "records")


class RunLog:
    """Entries are only added; the newest that names a thing says how it stands.

    A run may be started again under its id, after a failure or a pause. All runs are kept.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def append(self, rows: DataFrame) -> None:
        """Add entries; columns they lack are NULL."""
        shaped = rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in RUN_SCHEMA
            ],
            F.lit(uuid.uuid4().hex).alias("append_id"),
        )
        # Each append has folders of its own, so nothing is overwritten.
        shaped.write.mode("append").partitionBy("business_date", "append_id").parquet(self.root)

    def _note(self, run_id: str, day: date, status: str, **facts) -> None:
        known = {
            "seq": time.time_ns(),
            "run_id": run_id,
            "event_ts": datetime.now(timezone.utc).replace(tzinfo=None),
            "run_status": status,
            "business_date": day,
            **facts,
        }
        self.append(small_frame(self.spark, [tuple(known.get(f.name) for f in RUN_SCHEMA)], RUN_SCHEMA))

    def start(self, run_id: str, name: str, day: date) -> None:
        self._note(run_id, day, STARTED, name=name)

    def update(self, run_id: str, day: date, status: str, **figures: int) -> None:
        """Note a status, such as PAUSED or CANCELLED, or figures so far."""
        self._note(run_id, day, status, **figures)

    def finish(self, run_id: str, day: date, ledger: Ledger) -> str:
        """End a run with what its tables came to, and say what that is."""
        tables = ledger.by_run([day]).where(F.col("run_id") == run_id)
        row = run_log(tables, ["run_id"]).first()
        status = row.run_status if row else "SUCCESS"
        figures = {name: getattr(row, name) if row else 0 for name in _FIGURES}
        self._note(run_id, day, status, **figures)
        return status

    def entries(self, days: Sequence[date] = ()) -> DataFrame:
        """The log. Naming ``days`` leaves all other date folders unlisted."""
        schema = T.StructType(list(RUN_SCHEMA)).add("append_id", T.StringType())
        named = ",".join(sorted({day.isoformat() for day in days})) or "*"
        pattern = f"{self.root}/business_date={{{named}}}" if days else f"{self.root}/business_date=*"
        folders = paths(self.spark, pattern)
        if not folders:
            return small_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*folders)

    def runs(self, days: Sequence[date] = ()) -> DataFrame:
        """One row per run as it stands now."""
        return standing(self.entries(days))

    def resume(self, run_id: str, day: date, ledger: Ledger) -> DataFrame:
        """The tables that a run taken up again still has to do."""
        return resume_run(ledger.by_run([day]), run_id)


def standing(entries: DataFrame) -> DataFrame:
    """Fold entries to one row per run: one aggregate, combined before the shuffle."""
    moment = F.struct("event_ts", "seq")
    status = F.col("run_status")

    def newest(name: str):
        return F.max_by(name, F.when(F.col(name).isNotNull(), moment)).alias(name)

    folded = entries.groupBy("run_id", "business_date").agg(
        newest("name"),
        F.max_by("run_status", moment).alias("run_status"),
        F.min("event_ts").alias("started_ts"),
        F.max("event_ts").alias("last_ts"),
        F.greatest(F.count_if(status == STARTED) - 1, F.lit(0)).alias("restarts"),
        *[newest(name) for name in _FIGURES],
    )
    over = F.col("run_status").isin(*ENDED)
    return folded.withColumn("ended_ts", F.when(over, F.col("last_ts"))).drop("last_ts")
