"""Running extracts: decide, read, write, record."""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadledger.functions.columns import is_running
from loadledger.functions.hashing import schema_hash
from loadledger.operators.quality import BYTES_TOLERANCE, changed_types, run_contents, verdict
from loadledger.operators.state import decide
from loadledger.plans.spec import TableSpec, read_spec
from loadledger.sinks.ledger import IDENTITY, Ledger
from loadledger.sinks.runlog import RunLog
from loadledger.sinks.runs import write_run
from loadledger.sources.runs import ATTEMPT, list_files
from loadledger.work import cut_lineage, exists, folder_bytes, paths, small_frame

# A run within any path: source/table/yyyyMM/dd/run~attempt.parquet.
RUN = r"[^/]+/[^/]+/\d{6}/\d{2}/[^/]+\.parquet"
#: Seconds between looks at running tables.
_LOOK = 0.5
OUTCOME_COLUMNS = "table_key STRING, success BOOLEAN, skipped BOOLEAN, record_count BIGINT, error STRING"


@dataclass(frozen=True)
class Outcome:
    table_key: str
    success: bool
    skipped: bool
    record_count: int | None
    error: str | None

    def row(self) -> tuple:
        return (self.table_key, self.success, self.skipped, self.record_count, self.error)


def plain_name(name: str) -> str:
    """A name as one of a folder: marks that mean something in a path or a pattern become ``+`` and two
    hexadecimal digits for each byte."""
    return re.sub(r"[^\w.\- ]", lambda found: "".join(f"+{byte:02X}" for byte in found[0].encode()), name)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Extractor:
    """Extracts tables of one source into dated run folders, at most once per table and window.

    The data is written first and its ledger row last. A run that died in between left no completed
    row, so nobody reads it and the next attempt does it again. Every attempt has a folder of its own,
    so a run that counts is never written to, not even by a forced run of the same id.
    """

    def __init__(
        self,
        source,
        root: str,
        ledger: Ledger,
        max_retries: int = 3,
        concurrent_tables: int = 8,
        allow_type_changes: bool = False,
        check_content: bool = False,
        run_log: RunLog | None = None,
        name: str = "extract",
        scheduler_pool: str | None = None,
        table_limit: float | None = None,
    ):
        """``check_content`` has stored rows read and compared before a table is skipped.

        Tables that took longest last time start first, and those never read before them. Their jobs
        run in ``scheduler_pool``, where a session with the FAIR mode gives each pool its share. After
        ``table_limit`` seconds a table's jobs are cancelled: it fails, and the others go on.
        """
        self.source = source
        self.root = root.rstrip("/")
        self.ledger = ledger
        self.spark = ledger.spark
        self.max_retries = max_retries
        self.concurrent_tables = concurrent_tables
        self.allow_type_changes = allow_type_changes
        self.check_content = check_content
        self.run_log = run_log
        self.name = name
        self.scheduler_pool = scheduler_pool
        self.table_limit = table_limit
        self._stopped = threading.Event()

    def cancel(self) -> None:
        """End the call that is under way: running tables are cancelled, waiting ones not begun.

        What had ended by then stays done; a later call does the rest.
        """
        self._stopped.set()

    def extract(self, spec: TableSpec, force: bool = False) -> Outcome:
        return self._run([spec], force, None)[0]

    def extract_many(
        self, specs: Sequence[TableSpec], force: bool = False, run_id: str | None = None
    ) -> DataFrame:
        """Extract side by side; a table that fails does not stop the others. One row per table.

        All tables share one run id unless their specs name another. Calling again, with the same run
        id or a new one, only does what is not yet done. A ``run_log`` gets an entry per date at the
        start and at the end.
        """
        run_id = run_id or self._new_run_id()
        days = sorted({spec.day for spec in specs})
        for day in days if self.run_log else []:
            self.run_log.start(run_id, self.name, day)
        rows = [outcome.row() for outcome in self._run(specs, force, run_id)]
        for day in days if self.run_log else []:
            self.run_log.finish(run_id, day, self.ledger)
            if self._stopped.is_set():
                self.run_log.update(run_id, day, "CANCELLED")
        return small_frame(self.spark, rows, OUTCOME_COLUMNS)

    def decisions(self, specs: Sequence[TableSpec], force: bool = False) -> DataFrame:
        """Per spec: is it needed and why, and would it be the first success of its table."""
        requested = small_frame(
            self.spark,
            [(i, s.key, *s.window, force) for i, s in enumerate(specs)],
            "position INT, table_key STRING, window_start TIMESTAMP_NTZ, "
            "window_end TIMESTAMP_NTZ, forced BOOLEAN",
        )
        days = sorted({s.day for s in specs})
        state = self.ledger.current(days).drop("business_date").withColumnRenamed("schema_json", "run_schema")
        status = F.col("status")
        known = cut_lineage(
            requested.join(state, list(IDENTITY), "left")
            .withColumn("run", F.regexp_extract("output_path", RUN, 0))
            .withColumn("known", status.isNotNull())
            # A row that still says running was left behind by an attempt that died.
            .withColumn("status", F.when(is_running(status), "pending").otherwise(status))
        )
        succeeded = self.ledger.succeeded_tables(requested).withColumn("succeeded", F.lit(True))
        succeeded = succeeded.withColumnRenamed("duration_seconds", "last_seconds")
        rows = known.join(self._stored_sizes(specs, known), "run", "left").join(succeeded, "table_key", "left")
        hashes: tuple = ()
        if self.check_content:
            runs = known.where("status = 'completed'").withColumnRenamed("run_schema", "schema_json")
            rows = rows.join(self._contents(runs).select("run", "stored_fingerprint"), "run", "left")
            hashes = (F.col("fingerprint"), F.col("stored_fingerprint"))
        empty = F.coalesce(F.col("record_count") == 0, F.lit(False))
        stored = verdict(
            F.col("file_size_bytes"), F.col("stored_bytes"), *hashes, tolerance=BYTES_TOLERANCE
        )
        judged = decide(
            rows.withColumn("verdict", F.when(empty, "valid").otherwise(stored)),
            status=F.col("status"),
            forced=F.col("forced"),
            verdict=F.col("verdict"),
            current=F.lit(True),
            retries=F.col("retry_count"),
            max_retries=self.max_retries,
        )
        return judged.select(
            "position",
            "table_key",
            "needed",
            "reason",
            "next_status",
            F.col("succeeded").isNull().alias("first"),
            "schema_json",
            F.col("last_seconds"),
            F.coalesce("record_count", F.lit(0)).alias("record_count"),
            F.coalesce(F.when(F.col("forced"), 0).otherwise(F.col("attempts")), F.lit(0)).alias("attempts"),
            "known",
        )

    def _stored_sizes(self, specs: Sequence[TableSpec], known: DataFrame) -> DataFrame:
        """Bytes per run, from one listing of the folders of the tables and dates asked for."""

        def one_of(names) -> str:
            return "{" + ",".join(sorted(set(names))) + "}"

        days = one_of(spec.day.strftime("%Y%m/%d") for spec in specs)
        sources, tables = one_of(plain_name(s.source_name) for s in specs), one_of(self._folder(s) for s in specs)
        folders = paths(self.spark, f"{self.root}/{sources}/{tables}/{days}")
        # Runs taken over from elsewhere keep their place: at most one per spec asked for.
        elsewhere = known.where(~F.col("output_path").startswith(self.root)).select("output_path").collect()
        folders += [row.output_path for row in elsewhere if exists(self.spark, row.output_path)]
        if not folders:
            return small_frame(self.spark, [], "run STRING, stored_bytes BIGINT")
        run = F.regexp_extract("path", RUN, 0)
        files = list_files(self.spark, folders, "*.parquet")
        return files.groupBy(run.alias("run")).agg(F.sum("length").alias("stored_bytes"))

    def _contents(self, runs: DataFrame) -> DataFrame:
        """Rows and fingerprints of stored runs (run, output_path, schema_json): a scan per schema.

        Runs whose folder is gone have no row. The driver handles schemas and paths, not rows.
        """
        nothing = small_frame(self.spark, [], "run STRING, stored_records BIGINT, stored_fingerprint STRING")
        listed = runs.where("output_path IS NOT NULL").select("schema_json", "output_path").distinct()
        by_schema = listed.groupBy("schema_json").agg(F.collect_list("output_path").alias("found")).collect()
        scans = []
        for row in by_schema:
            there = self._present(row.found)
            if there and row.schema_json:
                schema = StructType.fromJson(json.loads(row.schema_json))
                scans.append(run_contents(self.spark, there, schema, RUN))
        renamed = {"records": "stored_records", "fingerprint": "stored_fingerprint"}
        return reduce(DataFrame.unionByName, [scan.withColumnsRenamed(renamed) for scan in scans], nothing)

    def _present(self, wanted: Sequence[str]) -> list[str]:
        """Of these run folders those that exist, from one listing of each folder above them."""
        above = {path.rsplit("/", 1)[0] for path in wanted}
        name = lambda path: path.split(":", 1)[-1].lstrip("/")
        there = {name(found) for folder in above for found in paths(self.spark, f"{folder}/*")}
        return [path for path in wanted if name(path) in there]

    def _run(
        self, specs: Sequence[TableSpec], force: bool, run_id: str | None
    ) -> list[Outcome]:
        self._stopped.clear()
        specs = [spec.dated() for spec in specs]
        if len({(spec.key, spec.window) for spec in specs}) < len(specs):
            raise ValueError("a table and window may be requested once per call")
        run_id = run_id or self._new_run_id()
        plan = {row.position: row for row in self.decisions(specs, force).collect()}
        retired = [
            self._transition(specs[i], "skipped", None, attempt=row.attempts, error_message=row.reason)
            for i, row in plan.items()
            if row.reason == "retries_exhausted"
        ]
        if retired:
            self.ledger.append_rows(retired)
        work = [i for i, row in plan.items() if row.needed]
        whole = self._bootstrapping(specs, [i for i in work if plan[i].first])
        run_ids = {i: specs[i].run_id or run_id for i in work}
        attempts = {i: plan[i].attempts + 1 for i in work}
        started = [
            self._transition(
                specs[i], "retrying" if plan[i].known else "running", run_ids[i], attempt=attempts[i]
            )
            for i in work
        ]
        if started:
            self.ledger.append_rows(started)

        done: dict[int, Outcome] = {}
        for i, row in plan.items():
            if not row.needed:
                ok = row.reason == "up_to_date"
                count = row.record_count if ok else None
                done[i] = Outcome(row.table_key, ok, True, count, None if ok else row.reason)
        # The longest first, so that none is left running alone at the end.
        seconds = {i: plan[i].last_seconds for i in work}
        work.sort(key=lambda i: (seconds[i] is not None, -(seconds[i] or 0.0), i))
        began: dict[int, float] = {}
        tags = {i: f"extract-{uuid.uuid4().hex}" for i in work}
        with ThreadPoolExecutor(max_workers=self.concurrent_tables) as pool:
            # Wrapped for each table, as all calls of one wrapper share its properties, and so their tags.
            futures = {
                pool.submit(
                    inheritable_thread_target(self.spark)(self._tagged),
                    began, i, tags[i], specs[i], run_ids[i], i in whole, plan[i].schema_json, attempts[i],
                ): i
                for i in work
            }
            ended_all = threading.Event()
            watch = inheritable_thread_target(self.spark)(self._watch)
            # Apart from this thread, whose own jobs may wait for the cores of a table that is over.
            limits = {i: self._limit(specs[i]) for i in work}
            watcher = threading.Thread(
                target=watch, args=(began, limits, tags, {i: f for f, i in futures.items()}, ended_all)
            )
            watcher.start()
            waiting = set(futures)
            while waiting:
                # What has ended by now goes into one append.
                ended, waiting = wait(waiting, return_when=FIRST_COMPLETED)
                found = {futures[future]: future.result() for future in ended}
                self._record([row for _, row in found.values()])
                done.update({i: outcome for i, (outcome, _) in found.items()})
            ended_all.set()
            watcher.join()
        return [done[i] for i in range(len(specs))]

    def _limit(self, spec: TableSpec) -> float | None:
        return self.table_limit if spec.limit_seconds is None else spec.limit_seconds

    def _is_over(self, began: float, limit: float | None) -> bool:
        return self._stopped.is_set() or limit is not None and time.monotonic() - began > limit

    def _watch(
        self, began: dict[int, float], limits: dict, tags: dict[int, str], futures: dict, ended: threading.Event
    ) -> None:
        """Cancels the jobs of tables that are over, again at each look: one may be between two of its jobs."""
        while not ended.wait(_LOOK):
            for i, since in list(began.items()):
                if not futures[i].done() and self._is_over(since, limits[i]):
                    self.spark.sparkContext.cancelJobsWithTag(tags[i])

    def _tagged(self, began: dict[int, float], i: int, tag: str, spec: TableSpec, *facts) -> tuple[Outcome, dict]:
        """One attempt, its jobs in the pool and under a tag of their own."""
        context = self.spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", self.scheduler_pool)
        context.addJobTag(tag)
        began[i] = time.monotonic()
        try:
            return self._attempt(spec, *facts)
        finally:
            context.removeJobTag(tag)

    @staticmethod
    def _bootstrapping(specs: Sequence[TableSpec], first: list[int]) -> set[int]:
        """Of the specs of a table that never succeeded, the earliest window takes all of it."""
        chosen: dict[str, int] = {}
        for i in sorted(first, key=lambda i: specs[i].window):
            if specs[i].bootstrap:
                chosen.setdefault(specs[i].key, i)
        return set(chosen.values())

    def _attempt(
        self, spec: TableSpec, run_id: str, bootstrap: bool, last_schema: str | None, attempt: int
    ) -> tuple[Outcome, dict]:
        """One attempt at one table: how it ended, and the transition to record."""
        began = time.monotonic()
        try:
            if self._stopped.is_set():
                raise InterruptedError("cancelled before it began")
            path = self.path_of(spec, run_id)
            rows = read_spec(self.source, spec, bootstrap)
            if last_schema and not self.allow_type_changes:
                changes = changed_types(StructType.fromJson(json.loads(last_schema)), rows.schema)
                if changes:
                    raise ValueError("; ".join(changes))
            written = write_run(rows, path, pack=spec.is_windowed and not bootstrap)
            facts = {
                "record_count": written.records,
                "fingerprint": written.fingerprint,
                "schema_hash": schema_hash(rows.schema),
                "schema_json": rows.schema.json(),
                "file_size_bytes": folder_bytes(self.spark, path),
                "output_path": path if written.records else None,
            }
        except Exception as problem:  # noqa: BLE001 - whatever went wrong belongs to this table only
            text = str(problem).strip() or type(problem).__name__
            spent = time.monotonic() - began
            if self._stopped.is_set():
                text = "cancelled by request"
            elif self._is_over(began, self._limit(spec)):
                text = f"cancelled: over the limit of {self._limit(spec):g} seconds"
            row = self._transition(
                spec, "failed", run_id, attempt=attempt, duration_seconds=spent, error_message=text
            )
            return Outcome(spec.key, False, False, None, text), row
        spent = time.monotonic() - began
        row = self._transition(spec, "completed", run_id, attempt=0, duration_seconds=spent, **facts)
        return Outcome(spec.key, True, False, written.records, None), row

    def verify(self, days: Sequence[date]) -> DataFrame:
        """What the runs that count for these business dates are worth, judged by the rows they hold now.

        Runs of one schema are read in one scan, however many they are.
        """
        runs = cut_lineage(
            self.ledger.complete_dataset(days).withColumn("run", F.regexp_extract("output_path", RUN, 0))
        )
        found = self._contents(runs)
        checked = verdict(
            F.col("record_count"),
            F.col("stored_records"),
            F.col("fingerprint"),
            F.col("stored_fingerprint"),
        )
        return (
            runs.join(found, "run", "left")
            .withColumn("verdict", F.when(F.col("record_count") == 0, "valid").otherwise(checked))
            .select(*IDENTITY, "run_id", "record_count", "stored_records", "verdict")
        )

    @staticmethod
    def _folder(spec: TableSpec) -> str:
        return plain_name(f"{spec.schema_name}.{spec.table_name}" if spec.schema_name else spec.table_name)

    def path_of(self, spec: TableSpec, run_id: str) -> str:
        """A new folder for an attempt; a path that was once recorded is never given out again."""
        day = spec.day.strftime("%Y%m/%d")
        attempt = uuid.uuid4().hex[:12]
        return f"{self.root}/{plain_name(spec.source_name)}/{self._folder(spec)}/{day}/{run_id}{ATTEMPT}{attempt}.parquet"

    def _record(self, rows: list[dict]) -> None:
        self.ledger.append_rows(rows)

    @staticmethod
    def _new_run_id() -> str:
        return f"{_now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"

    @staticmethod
    def _transition(spec: TableSpec, status: str, run_id: str | None, **facts) -> dict:
        start, end = spec.window
        return {
            "seq": time.time_ns(),
            "table_key": spec.key,
            "business_date": spec.day,
            "window_start": start,
            "window_end": end,
            "event_ts": _now(),
            "status": status,
            "run_id": run_id,
            "spec": spec.row(),
            **facts,
        }
