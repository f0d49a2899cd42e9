"""The run ledger: an append-only Parquet table of state transitions, a folder per business date."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger.functions.common import read_versions
from loadledger.operators.latest import latest
from loadledger.operators.state import ORDER, fold, is_retained
from loadledger.work import delete, exists, paths, small_frame

_STRING, _LONG, _NTZ = T.StringType(), T.LongType(), T.TimestampNTZType()

SPEC_SCHEMA = (
    T.StructType()
    .add("source_name", _STRING)
    .add("table_name", _STRING)
    .add("schema_name", _STRING)
    .add("incremental_column", _STRING)
    .add("extraction_date", T.DateType())
    .add("is_full_extract", T.BooleanType())
    .add("custom_query", _STRING)
    .add("run_id", _STRING)
    .add("as_of", _NTZ)
    .add("window_hours", T.IntegerType())
)
LEDGER_SCHEMA = (
    T.StructType()
    .add("seq", _LONG)
    .add("table_key", _STRING)
    .add("window_start", _NTZ)
    .add("window_end", _NTZ)
    .add("event_ts", _NTZ)
    .add("status", _STRING)
    .add("attempt", T.IntegerType())
    .add("run_id", _STRING)
    .add("record_count", _LONG)
    .add("file_size_bytes", _LONG)
    .add("output_path", _STRING)
    .add("fingerprint", _STRING)
    .add("schema_hash", _STRING)
    .add("schema_json", _STRING)
    .add("error_message", _STRING)
    .add("duration_seconds", T.DoubleType())
    .add("spec", SPEC_SCHEMA)
    .add("business_date", T.DateType())
)

IDENTITY = ("table_key", "window_start", "window_end")
DATED = (*IDENTITY, "business_date")
_FIGURES = ("record_count", "file_size_bytes", "output_path", "fingerprint", "schema_json", "error_message")


class Ledger:
    """Every append fills folders of its own, so concurrent writers never share a commit.

    A state is never edited. Later transitions supersede earlier ones when the log is folded, and a
    run whose ledger row was never written does not exist for any reader.

    The log lies in ``log/business_date=…/append_id=…``: a call for some dates lists their folders
    only. ``newest`` holds, for the dates that were compacted, the last success of each table, so that
    whether a table ever succeeded needs no look at old dates.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/log"
        self._newest = f"{self.root}/newest"

    def append(self, rows: DataFrame, append_id: str | None = None) -> str:
        """Add transitions. Repeating an ``append_id`` replaces that append instead of doubling it."""
        return self._store(rows.hint("rebalance", "business_date"), append_id)

    def append_rows(self, rows: list[dict], append_id: str | None = None) -> str:
        """Add transitions known to the driver, a few per table at most."""
        values = [tuple(row.get(f.name) for f in LEDGER_SCHEMA) for row in rows]
        return self._store(small_frame(self.spark, values, LEDGER_SCHEMA), append_id)

    def _store(self, rows: DataFrame, append_id: str | None) -> str:
        name = append_id or uuid.uuid4().hex
        shaped = rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in LEDGER_SCHEMA
            ]
        ).withColumn("append_id", F.lit(name))
        self._write(shaped, self._log)
        upto = self._compacted()
        if upto is not None:
            # An old date was worked on again: its successes must be found without a look at it.
            late = shaped.where((F.col("business_date") < F.lit(upto)) & (F.col("status") == "completed"))
            self._write(late, self._newest)
        return name

    @staticmethod
    def _write(rows: DataFrame, root: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "business_date", "append_id"
        ).parquet(root)

    def _read(self, root: str, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType(list(LEDGER_SCHEMA)).add("append_id", T.StringType())
        if not folders:
            return small_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*folders)

    def dates(self) -> list[date]:
        """Business dates the log has, from one listing of its first level."""
        names = [path.rsplit("business_date=", 1)[1] for path in paths(self.spark, f"{self._log}/business_date=*")]
        return sorted(date.fromisoformat(name) for name in names if name[:1].isdigit())

    def transitions(self, days: Sequence[date] = ()) -> DataFrame:
        """The log. Naming ``days`` leaves all other date folders unlisted."""
        if not days:
            return self._read(self._log, [self._log] if exists(self.spark, self._log) else [])
        named = ",".join(sorted({day.isoformat() for day in days}))
        return self._read(self._log, paths(self.spark, f"{self._log}/business_date={{{named}}}"))

    def current(self, days: Sequence[date] = ()) -> DataFrame:
        """One row per table and window with its present state."""
        return self._folded(self.transitions(days), DATED, ("run_id",))

    def by_run(self, days: Sequence[date] = ()) -> DataFrame:
        """One row per table, window and run: what each run came to, whatever happened later."""
        return self._folded(self.transitions(days).where("run_id IS NOT NULL"), (*DATED, "run_id"), ())

    @staticmethod
    def _folded(log: DataFrame, keys: Sequence[str], last: Sequence[str]) -> DataFrame:
        attempts = (*last, "attempt")
        folded = fold(log, keys, carried=(*_FIGURES, "duration_seconds"), last=attempts, attempt="attempt")
        return folded.withColumnRenamed("attempt", "attempts")

    def succeeded_tables(self, tables: DataFrame | None = None) -> DataFrame:
        """Tables that completed at least once, for whatever window: schema and seconds of last time.

        ``tables`` (``table_key``) says which are asked for; the others' history is dropped first.
        """
        done = self._successes()
        if tables is not None:
            done = done.join(tables.select("table_key").distinct(), "table_key", "left_semi")
        last = [F.max_by(name, F.struct(*ORDER)).alias(name) for name in ("schema_json", "duration_seconds")]
        return done.groupBy("table_key").agg(*last)

    def _successes(self) -> DataFrame:
        """Completed transitions: all of open dates, and the last of each table for compacted ones."""
        upto = self._compacted()
        if upto is None:
            return self.transitions().where(F.col("status") == "completed")
        kept = self._read(self._newest, [self._newest])
        opened = [day for day in self.dates() if day >= upto]
        if opened:
            kept = kept.unionByName(self.transitions(opened))
        return kept.where(F.col("status") == "completed")

    def _compacted(self) -> date | None:
        """The first date that no compaction has reached, if there was one."""
        marks = paths(self.spark, f"{self.root}/upto=*")
        return max((date.fromisoformat(path.rsplit("upto=", 1)[1]) for path in marks), default=None)

    def compact(self, before: date) -> None:
        """Pack each date before ``before`` into one append, and note every table's last success.

        A packed append is written before those it replaces are deleted. In between, readers see
        transitions twice, which changes no fold; so a crash does no harm and the next call goes on.
        """
        since = self._compacted()
        closed = [day for day in self.dates() if day < before]
        for day in closed:
            folder = f"{self._log}/business_date={day.isoformat()}"
            appends = paths(self.spark, f"{folder}/append_id=*")
            if len(appends) > 1:
                self._write(
                    self.transitions([day]).dropDuplicates([*DATED, "seq", "status"])
                    .coalesce(1).withColumn("append_id", F.lit(f"packed-{uuid.uuid4().hex}")),
                    self._log,
                )
                for path in appends:
                    delete(self.spark, path)
        fresh = [day for day in closed if since is None or day >= since]
        if fresh:
            done = self.transitions(fresh).where(F.col("status") == "completed")
            last = latest(done, ["table_key"], ORDER).withColumn("append_id", F.lit(f"upto-{before.isoformat()}"))
            self._write(last.select(*[f.name for f in LEDGER_SCHEMA], "append_id"), self._newest)
            small_frame(self.spark, [(before,)], "upto DATE").write.mode("overwrite").parquet(
                f"{self.root}/upto={before.isoformat()}"
            )

    def complete_dataset(self, days: Sequence[date] = (), moment: datetime | None = None) -> DataFrame:
        """Where the newest successful run of every table and date is, failures since then or not.

        Windows of a date all start at its midnight, so two of them hold the same rows; the newer
        success counts. ``moment`` gives the data set as the ledger stood then.
        """
        done = self.transitions(days).where(F.col("status") == "completed")
        if moment is not None:
            done = done.where(F.col("event_ts") <= F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz"))
        kept = ("window_start", "window_end", "run_id", "record_count", "output_path", "fingerprint", "schema_json")
        keys = ("table_key", "business_date")
        return latest(done.select(*keys, *ORDER, *kept), keys, ORDER)

    def read(self, table_key: str, days: date | Sequence[date], moment: datetime | None = None) -> DataFrame:
        """The rows of one table for some business dates, from exactly the runs that count.

        Columns are those of all these runs, whatever the case of their letters; where a run lacks one
        it is NULL. A column whose type changed has the least type that holds all its values.
        """
        days = [days] if isinstance(days, date) else list(days)
        runs = self.complete_dataset(days, moment).where(F.col("table_key") == table_key)
        stored = runs.where("output_path IS NOT NULL").orderBy(*ORDER).collect()
        if not stored:
            raise LookupError(f"no stored run of {table_key} for {', '.join(map(str, days))}")
        by_schema: dict[str | None, list[str]] = {}
        for row in stored:
            by_schema.setdefault(row.schema_json, []).append(row.output_path)
        return read_versions(self.spark, [(self._schema(text, found), found) for text, found in by_schema.items()])

    def _schema(self, text: str | None, folders: Sequence[str]) -> T.StructType:
        """A schema as it was recorded, or as the files have it where none was."""
        if text:
            return T.StructType.fromJson(json.loads(text))
        return self.spark.read.option("mergeSchema", True).parquet(*folders).schema

    def reopen(self, chosen: DataFrame) -> str:
        """Make states pending again, by further transitions: forced tables, or failures to retry.

        ``chosen`` are rows of :meth:`current`, such as those ``state.reset_failed`` marks. Their
        attempts are counted anew.
        """
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return self.append(
            chosen.select(
                *DATED,
                "run_id",
                F.lit("pending").alias("status"),
                F.lit(0).alias("attempt"),
                F.lit(time.time_ns()).alias("seq"),
                F.lit(now.isoformat(sep=" ")).alias("event_ts"),
            )
        )

    def retain(self, target: str, today: date, days: int = 7) -> Ledger:
        """Copy what is younger than ``days`` to a new place, packed into few files per date.

        The last success of each table is kept whatever its age: without it a table would count as
        new and be read in full again. The caller moves on to the ledger returned.
        """
        kept = Ledger(self.spark, target)
        columns = [f.name for f in LEDGER_SCHEMA]
        young = is_retained(F.col("business_date"), today, days)
        last = latest(self._successes().select(*columns), ["table_key"], ORDER).where(~young)
        wanted = [day for day in self.dates() if (today - day).days <= days]
        recent = self.transitions(wanted).select(*columns) if wanted else last.limit(0)
        kept.append(recent.where(young).unionByName(last.select(*columns)))
        return kept
