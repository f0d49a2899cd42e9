"""Extracts from files into runs: reruns, failures, crashes, windows and bootstraps."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadledger import Extractor, LakeSource, Ledger, TableSpec
from loadledger.functions.hashing import quick_fingerprint
from loadledger.operators import progress
from loadledger.operators.state import reset_failed
from loadledger.plans.spec import load_specs
from loadledger.sinks.runlog import RunLog
from loadledger.sources.runs import read_runs, read_sidecars, read_state_files
from loadledger.work import cut_lineage, exists, new_dir, workspace

DAY = date(1997, 5, 28)


@pytest.fixture
def extractor(spark, sf_dir):
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    return Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), ledger)


def states(extractor):
    return {row.table_key: row for row in extractor.ledger.current().collect()}


def by_key(outcomes):
    return {row.table_key: row for row in outcomes.collect()}


def full(table):
    return TableSpec("db", table, is_full_extract=True, extraction_date=DAY)


def test_second_run_does_nothing(extractor):
    first = by_key(extractor.extract_many([full("nation"), full("region")]))
    files = extractor.ledger.transitions().count()
    second = by_key(extractor.extract_many([full("nation"), full("region")]))
    assert [first[k].skipped for k in sorted(first)] == [False, False]
    assert [second[k].skipped for k in sorted(second)] == [True, True]
    assert {k: r.record_count for k, r in second.items()} == {"db.nation": 25, "db.region": 5}
    assert extractor.ledger.transitions().count() == files


def test_force_runs_again_and_readers_get_the_same_rows(spark, extractor):
    extractor.extract(full("nation"))
    before = states(extractor)["db.nation"]
    again = extractor.extract(full("nation"), force=True)
    after = states(extractor)["db.nation"]
    assert again.success and not again.skipped
    assert before.output_path != after.output_path
    assert before.fingerprint == after.fingerprint
    assert after.retry_count == 0


def test_fingerprint_is_that_of_the_stored_rows(spark, extractor):
    extractor.extract(full("orders"))
    state = states(extractor)["db.orders"]
    stored = spark.read.parquet(state.output_path)
    assert stored.agg(quick_fingerprint(stored.schema)).first()[0] == state.fingerprint
    assert stored.count() == state.record_count


def test_a_failing_table_leaves_the_others_alone(extractor):
    outcomes = by_key(extractor.extract_many([full("nation"), full("no_such_table"), full("region")]))
    assert outcomes["db.nation"].success and outcomes["db.region"].success
    assert not outcomes["db.no_such_table"].success
    assert "no_such_table" in outcomes["db.no_such_table"].error
    state = states(extractor)["db.no_such_table"]
    assert state.status == "failed" and state.error_message


def test_retries_run_out_and_the_table_is_skipped(extractor):
    extractor.max_retries = 2
    reasons = [extractor.extract(full("no_such_table")).error for _ in range(5)]
    assert reasons[-1] == "retries_exhausted" or reasons[-1] == "skipped"
    assert states(extractor)["db.no_such_table"].status == "skipped"


def test_reset_failures_are_tried_again(extractor):
    extractor.extract(full("no_such_table"))
    marked = reset_failed(extractor.ledger.current(), max_retries=3).where("was_reset")
    extractor.ledger.reopen(marked)
    assert states(extractor)["db.no_such_table"].status == "pending"
    decision = extractor.decisions([full("no_such_table")]).first()
    assert decision.needed and decision.reason == "not_finished"


def test_crash_before_the_ledger_row_is_redone(extractor, monkeypatch):
    def die(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(Extractor, "_record", die)
    with pytest.raises(KeyboardInterrupt):
        extractor.extract(full("nation"))
    monkeypatch.undo()
    assert states(extractor)["db.nation"].status == "running"
    assert extractor.extract(full("nation")).success
    state = states(extractor)["db.nation"]
    assert state.status == "completed" and state.record_count == 25


def test_missing_and_resized_outputs_are_redone(spark, extractor):
    extractor.extract(full("nation"))
    path = states(extractor)["db.nation"].output_path
    spark.range(1000).write.mode("append").parquet(path)
    assert extractor.decisions([full("nation")]).first().reason == "output_corrupt"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)
    assert extractor.decisions([full("nation")]).first().reason == "output_missing"
    assert extractor.extract(full("nation")).record_count == 25


def test_empty_window_is_done_and_stays_done(spark, extractor):
    spec = TableSpec(
        "db", "orders", incremental_column="o_orderdate", extraction_date=date(1980, 1, 1), bootstrap=False
    )
    assert extractor.extract(spec).record_count == 0
    state = states(extractor)["db.orders"]
    assert state.status == "completed" and state.output_path is None
    assert extractor.extract(spec).skipped


def test_first_run_takes_the_table_and_later_runs_their_window(extractor, spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    spec = TableSpec("db", "orders", incremental_column="o_orderdate", extraction_date=DAY)
    assert extractor.extract(spec).record_count == orders.count()
    next_day = TableSpec(
        "db", "orders", incremental_column="o_orderdate", extraction_date=DAY + timedelta(days=1)
    )
    inside = orders.where(F.to_date("o_orderdate") == F.lit(DAY + timedelta(days=1))).count()
    assert extractor.extract(next_day).record_count == inside


def test_only_one_window_of_a_new_table_bootstraps(extractor, spark, sf_dir):
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    specs = [
        TableSpec("db", "orders", incremental_column="o_orderdate", extraction_date=DAY + timedelta(days=i))
        for i in (1, 0)
    ]
    extractor.extract_many(specs).collect()
    counts = {r.business_date: r.record_count for r in extractor.ledger.current().collect()}
    assert counts[DAY] == total and counts[DAY + timedelta(days=1)] < total


def test_window_is_half_open_and_leaves_null_out(spark, tmp_path):
    moments = [
        datetime(2024, 1, 14, 23, 59, 59, 999999),
        datetime(2024, 1, 15),
        datetime(2024, 1, 15, 23, 59, 59, 999999),
        datetime(2024, 1, 16),
        None,
    ]
    for kind in ("timestamp_ntz", "timestamp", "date"):
        rows = spark.createDataFrame([(m,) for m in moments], "at timestamp_ntz")
        rows.select(F.col("at").cast(kind)).write.parquet(f"{tmp_path}/{kind}.parquet")
        spec = TableSpec("db", kind, incremental_column="at", extraction_date=date(2024, 1, 15), bootstrap=False)
        ledger = Ledger(spark, new_dir(spark, "ledger"))
        outcome = Extractor(LakeSource(spark, str(tmp_path)), new_dir(spark, "runs"), ledger).extract(spec)
        assert outcome.record_count == 2


def test_same_table_names_of_two_schemas_do_not_collide(spark, tmp_path):
    for schema, n in (("a", 3), ("b", 5)):
        spark.range(n).write.parquet(f"{tmp_path}/{schema}/t.parquet")
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, str(tmp_path)), new_dir(spark, "runs"), ledger)
    specs = [TableSpec("db", "t", schema_name=s, is_full_extract=True) for s in ("a", "b")]
    assert {k: r.record_count for k, r in by_key(extractor.extract_many(specs)).items()} == {
        "db.a.t": 3,
        "db.b.t": 5,
    }


def test_one_table_and_window_may_be_asked_for_once(extractor):
    with pytest.raises(ValueError):
        extractor.extract_many([full("nation"), full("nation")])


def test_run_figures_come_from_the_ledger(extractor):
    extractor.extract_many([full("nation"), full("no_such_table")], run_id="r7").collect()
    state = extractor.ledger.current()
    outcome = progress.outcome(state, ["run_id"]).first()
    assert (outcome.run_id, outcome.ok, outcome.failed, outcome.outcome) == ("r7", 1, 1, "PARTIAL")
    rate = progress.progress(state, ["run_id"]).first().completion_rate
    assert rate == 50.0
    lists = {r.list: r.tables for r in progress.table_lists(state, ["run_id"]).collect()}
    assert lists == {
        "attempted": "db.nation,db.no_such_table",
        "succeeded": "db.nation",
        "failed": "db.no_such_table",
    }


def test_runs_are_read_back_by_their_path(spark, extractor):
    extractor.extract_many([full("nation"), full("region")], run_id="r1").collect()
    rows = read_runs(spark, f"{extractor.root}/db/nation").select(
        "run_source", "run_table", "business_date", "run_id"
    )
    assert rows.distinct().collect() == [("db", "nation", DAY, "r1")]


def test_retention_copies_only_young_dates(spark, extractor):
    for days in (10, 0):
        extractor.extract(
            TableSpec("db", "nation", is_full_extract=True, extraction_date=DAY - timedelta(days=days))
        )
    kept = extractor.ledger.retain(new_dir(spark, "ledger"), DAY, days=7)
    assert [r.business_date for r in kept.current().collect()] == [DAY]


def test_specs_are_checked_when_loaded(spark, tmp_path):
    listed = [
        {"source_name": "s", "table_name": "a", "incremental_column": "c", "extraction_date": "2024-1-5"},
        {"source_name": "s", "table_name": "b", "is_full_extract": True},
        {"source_name": "s", "is_full_extract": True},
        {"source_name": "s", "table_name": "d"},
        {"source_name": "s", "table_name": "e", "is_full_extract": True, "extraction_date": "05.01.2024"},
    ]
    path = tmp_path / "tables.json"
    path.write_text(json.dumps(listed))
    good, bad = load_specs(spark, str(path))
    assert [(s.key, s.extraction_date) for s in good] == [("s.a", date(2024, 1, 5)), ("s.b", None)]
    assert sorted(row.violations[0] for row in bad.collect()) == [
        "extraction_date is not a date",
        "incremental_column is blank, and the spec asks neither for the full table nor a query",
        "table_name is blank: name the table to read",
    ]


def test_a_changed_type_fails_and_new_columns_do_not(spark, tmp_path):
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    extractor = Extractor(LakeSource(spark, str(tmp_path)), new_dir(spark, "runs"), ledger)

    def run(day, **columns):
        rows = spark.range(3).select(*[F.lit(v).alias(name) for name, v in columns.items()])
        rows.write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
        return extractor.extract(
            TableSpec("db", "t", is_full_extract=True, extraction_date=date(2024, 1, day))
        )

    assert run(1, id=1, name="x").success
    assert run(2, id=1, name="x", phone="y").success
    assert run(3, id=1, phone="y").success
    failed = run(4, id="1", phone="y")
    assert not failed.success and failed.error == "column id changed from int to string"
    extractor.allow_type_changes = True
    assert run(4, id="1", phone="y").success


def test_verification_reads_the_rows(spark, extractor):
    extractor.extract_many([full("nation"), full("region"), full("supplier"), full("part")]).collect()
    paths = {key: row.output_path for key, row in states(extractor).items()}
    spark.read.parquet(paths["db.nation"]).limit(3).write.mode("append").parquet(paths["db.nation"])
    renamed = spark.read.parquet(paths["db.region"]).withColumn("r_name", F.reverse("r_name")).collect()
    schema = spark.read.parquet(paths["db.region"]).schema
    spark.createDataFrame(renamed, schema).write.mode("overwrite").parquet(paths["db.region"])
    gone = spark._jvm.org.apache.hadoop.fs.Path(paths["db.part"])
    gone.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(gone, True)
    verdicts = {row.table_key: row.verdict for row in extractor.verify([DAY]).collect()}
    assert verdicts == {
        "db.nation": "size_off",
        "db.region": "content_changed",
        "db.supplier": "valid",
        "db.part": "missing",
    }


def test_earlier_runs_are_taken_over_from_json(spark, tmp_path):
    run = {
        "output_path": "/lake/s/t/202401/05/r1.parquet",
        "record_count": 7,
        "start_time": "2024-01-06T01:00:00",
        "end_time": "2024-01-06T01:02:03.5",
        "duration_seconds": 123.5,
        "file_size_bytes": 99,
        "checksum": "abc",
        "table_config": {
            "source_name": "s",
            "table_name": "t",
            "schema_name": None,
            "extraction_date": "2024-01-05T08:30:00",
            "run_id": "r1",
        },
        "extraction_complete": True,
    }
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "r1_metadata.json").write_text(json.dumps(run, indent=2))
    (tmp_path / "s" / "r2_metadata.json").write_text(json.dumps({**run, "extraction_complete": False}))
    state = {
        "pipeline": {"run_id": "p1", "extraction_date": "2024-01-05T00:00:00"},
        "extractions": {
            "s.u": {"status": "failed", "end_time": "2024-01-06T02:00:00", "error_message": "no route"},
            "s.v": {"status": "pending"},
        },
        "metadata": {"saved_at": "2024-01-06T03:00:00"},
    }
    (tmp_path / "pipeline_p1.json").write_text(json.dumps(state, indent=2))
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    ledger.append(read_sidecars(spark, str(tmp_path)))
    ledger.append(read_state_files(spark, str(tmp_path)))
    rows = {row.table_key: row for row in ledger.current().collect()}
    assert {key: row.status for key, row in rows.items()} == {
        "s.t": "completed",
        "s.u": "failed",
        "s.v": "pending",
    }
    assert rows["s.t"].window_start == datetime(2024, 1, 5)
    assert (rows["s.t"].record_count, rows["s.t"].run_id) == (7, "r1")
    assert rows["s.u"].error_message == "no route" and rows["s.v"].run_id == "p1"


def test_readers_get_the_last_success_even_after_a_failure(spark, extractor, monkeypatch):
    days = [DAY, DAY + timedelta(days=1)]
    specs = [TableSpec("db", "nation", is_full_extract=True, extraction_date=day) for day in days]
    extractor.extract_many(specs, run_id="r1").collect()
    assert all(row.skipped for row in extractor.extract_many(specs).collect())

    def refuse(*args, **kwargs):
        raise ConnectionError("simulated outage")

    monkeypatch.setattr(LakeSource, "table", refuse)
    assert not extractor.extract(specs[0], force=True).success
    monkeypatch.undo()
    assert [r.status for r in extractor.ledger.current([DAY]).collect()] == ["failed"]
    dataset = extractor.ledger.complete_dataset([DAY]).collect()
    assert [(r.table_key, r.run_id, r.record_count) for r in dataset] == [("db.nation", "r1", 25)]
    assert extractor.ledger.read("db.nation", DAY).count() == 25
    with pytest.raises(LookupError):
        extractor.ledger.read("db.region", DAY)


def test_work_goes_to_the_checkpoint_folder_or_the_warehouse(spark, tmp_path):
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, **settings):
            self.conf = settings

    plain = Session(**{"spark.sql.warehouse.dir": "hdfs://lake/warehouse/"})
    assert new_dir(plain, "stage").startswith("hdfs://lake/warehouse/_work/stage-")
    named = Session(**{"spark.sql.warehouse.dir": "x", "spark.checkpoint.dir": "hdfs://lake/shared"})
    assert new_dir(named, "stage").startswith("hdfs://lake/shared/stage-")


def test_a_workspace_deletes_what_it_owns(spark):
    with workspace(spark) as owned:
        kept = cut_lineage(spark.range(5))
        assert kept.count() == 5 and len(owned) == 1 and exists(spark, owned[0])
    assert not exists(spark, owned[0])


def small_table(spark, folder, name="t", **extra):
    """Ten rows of the day and one of the next, in a file source."""
    rows = spark.range(11).select(
        "id",
        F.when(F.col("id") < 10, F.lit(f"{DAY} 01:00:00")).otherwise(F.lit(f"{DAY + timedelta(days=1)} 02:00:00"))
        .cast("timestamp_ntz").alias("LAST_MODIFIED"),
        *[F.lit(v).alias(k) for k, v in extra.items()],
    )
    rows.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def on(spark, folder, **options):
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    return Extractor(LakeSource(spark, str(folder)), new_dir(spark, "runs"), ledger, **options)


def window(day=DAY, **more):
    return TableSpec("db", "t", incremental_column="last_modified", extraction_date=day, **more)


def test_a_column_may_be_named_in_another_case(spark, tmp_path):
    small_table(spark, tmp_path)
    assert on(spark, tmp_path).extract(window(bootstrap=False)).record_count == 10


def test_a_forced_run_that_fails_leaves_the_good_one(spark, tmp_path, monkeypatch):
    small_table(spark, tmp_path)
    extractor = on(spark, tmp_path)
    extractor.extract_many([window()], run_id="r1").collect()
    rows = extractor.ledger.read("db.t", DAY)
    bad = F.raise_error(F.lit("broken while writing")).cast("bigint")
    spark.range(3).select("id", F.lit(None).cast("timestamp_ntz").alias("LAST_MODIFIED")).write.mode("overwrite").parquet(
        f"{tmp_path}/t.parquet")
    real = LakeSource.table
    monkeypatch.setattr(LakeSource, "table", lambda *a, **k: real(*a, **k).withColumn("id", F.when(F.col("id") > 1, bad).otherwise(F.col("id"))))
    outcome = extractor.extract_many([TableSpec("db", "t", is_full_extract=True, extraction_date=DAY)], force=True, run_id="r1").first()
    monkeypatch.undo()
    assert not outcome.success and len(outcome.error) > 0
    assert extractor.ledger.read("db.t", DAY).count() == rows.count() == 11


def test_long_errors_are_kept_whole(extractor, monkeypatch):
    def refuse(*args, **kwargs):
        raise ConnectionError("x" * 5000)

    monkeypatch.setattr(LakeSource, "table", refuse)
    assert len(extractor.extract(full("nation")).error) == 5000
    assert len(states(extractor)["db.nation"].error_message) == 5000


def test_retries_are_counted_since_the_last_success_or_force(extractor, monkeypatch):
    for _ in range(4):
        assert extractor.extract(full("nation"), force=True).success

    def refuse(*args, **kwargs):
        raise ConnectionError("outage")

    monkeypatch.setattr(LakeSource, "table", refuse)
    extractor.extract(full("nation"), force=True)
    assert extractor.decisions([full("nation")]).first().reason == "retryable_failure"
    extractor.max_retries = 1
    for _ in range(3):
        extractor.extract(full("nation"))
    assert states(extractor)["db.nation"].status == "skipped"
    extractor.ledger.reopen(extractor.ledger.current())
    extractor.extract(full("nation"))
    assert extractor.decisions([full("nation")]).first().reason == "retryable_failure"


def test_retention_does_not_make_a_table_new(spark, tmp_path):
    small_table(spark, tmp_path)
    extractor = on(spark, tmp_path)
    assert extractor.extract(window()).record_count == 11
    today = DAY + timedelta(days=30)
    extractor.ledger = extractor.ledger.retain(new_dir(spark, "ledger"), today)
    assert extractor.extract(window(DAY + timedelta(days=1))).record_count == 1


def test_readers_get_one_run_per_date_and_all_columns(spark, tmp_path):
    small_table(spark, tmp_path)
    extractor = on(spark, tmp_path)
    extractor.extract(window(bootstrap=False, window_hours=6))
    small_table(spark, tmp_path, phone="1")
    extractor.extract(window(bootstrap=False))
    rows = extractor.ledger.read("db.t", DAY)
    assert rows.count() == 10 and "phone" in rows.columns
    extractor.extract(window(DAY + timedelta(days=1), bootstrap=False))
    small_table(spark, tmp_path)
    extractor.extract(window(bootstrap=False), force=True)
    both = extractor.ledger.read("db.t", [DAY, DAY + timedelta(days=1)])
    assert both.count() == 11 and both.where("phone IS NULL").count() == 10


def test_runs_keep_their_figures(extractor):
    extractor.extract_many([full("nation"), full("region")], run_id="r1").collect()
    extractor.extract_many([full("nation"), full("no_such_table")], force=True, run_id="r2").collect()
    outcomes = {r.run_id: (r.outcome, r.ok, r.success_ratio) for r in progress.outcome(extractor.ledger.by_run(), ["run_id"]).collect()}
    assert outcomes == {"r1": ("SUCCESS", 2, 1.0), "r2": ("PARTIAL", 1, 0.5)}
    runs = {r.run_id: r for r in progress.run_log(extractor.ledger.by_run(), ["run_id", "business_date"]).collect()}
    assert (runs["r2"].run_status, runs["r2"].attempted, runs["r2"].records) == ("PARTIAL", 2, 25)
    assert runs["r1"].ended_ts >= runs["r1"].started_ts
    left = progress.resume_run(extractor.ledger.by_run(), "r2").collect()
    assert [(r.table_key, r.status) for r in left] == [("db.no_such_table", "failed")]


def test_the_data_set_can_be_read_as_of_an_instant(spark, extractor):
    extractor.extract_many([full("nation")], run_id="r1").collect()
    between = extractor.ledger.current().first().last_ts + timedelta(microseconds=1)
    extractor.extract_many([full("nation")], force=True, run_id="r2").collect()
    assert extractor.ledger.complete_dataset([DAY]).first().run_id == "r2"
    assert extractor.ledger.complete_dataset([DAY], between).first().run_id == "r1"


def test_changed_content_of_the_same_size_is_found_on_demand(spark, extractor):
    extractor.extract(full("region"))
    path = states(extractor)["db.region"].output_path
    rows = spark.read.parquet(path)
    turned = rows.withColumn("r_name", F.reverse("r_name")).collect()
    spark.createDataFrame(turned, rows.schema).coalesce(1).write.mode("overwrite").parquet(path)
    assert extractor.decisions([full("region")]).first().reason == "up_to_date"
    extractor.check_content = True
    assert extractor.decisions([full("region")]).first().reason == "output_corrupt"
    assert extractor.extract(full("region")).success
    assert extractor.decisions([full("region")]).first().reason == "up_to_date"


def test_an_imported_run_is_not_done_again(spark, tmp_path):
    small_table(spark, tmp_path)
    extractor = on(spark, tmp_path)
    path = new_dir(spark, "old-runs") + f"/db/t/{DAY:%Y%m/%d}/r1.parquet"
    spark.range(10).write.parquet(path)
    run = {
        "output_path": path, "record_count": 10, "end_time": f"{DAY}T03:00:00", "file_size_bytes": 4096,
        "extraction_complete": True,
        "table_config": {"source_name": "db", "table_name": "t", "extraction_date": str(DAY), "run_id": "r1"},
    }
    (tmp_path / "r1_metadata.json").write_text(json.dumps(run))
    extractor.ledger.append(read_sidecars(spark, str(tmp_path)))
    assert extractor.decisions([window()]).first().reason == "up_to_date"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)
    assert extractor.decisions([window()]).first().reason == "output_missing"


def test_a_call_lists_only_its_dates_and_compaction_packs_them(spark):
    ledger = Ledger(spark, new_dir(spark, "ledger"))
    days = [DAY + timedelta(days=n) for n in range(30)]

    def row(table, day, seq, status="completed"):
        start = datetime(day.year, day.month, day.day)
        return {"seq": seq, "table_key": table, "window_start": start, "window_end": start + timedelta(days=1),
                "event_ts": start + timedelta(seconds=seq), "status": status, "attempt": 0, "business_date": day}

    for part in range(10):
        ledger.append_rows([row("a", day, part) for day in days])
    listed = ledger.transitions([days[3]]).inputFiles()
    assert len(listed) == 10 and all(f"business_date={days[3]}" in path for path in listed)
    before = sorted(map(str, ledger.current().collect()))
    ledger.compact(days[20])
    assert len(ledger.transitions([days[3]]).inputFiles()) == 1
    assert len(ledger.transitions([days[25]]).inputFiles()) == 10
    assert sorted(map(str, ledger.current().collect())) == before
    asked = spark.createDataFrame([("a",), ("b",)], "table_key string")
    assert [r.table_key for r in ledger.succeeded_tables(asked).collect()] == ["a"]
    assert all(f"business_date={day}" not in path for path in ledger.succeeded_tables().inputFiles()
               for day in days[:19])
    ledger.append_rows([row("b", days[1], 99)])
    assert sorted(r.table_key for r in ledger.succeeded_tables(asked).collect()) == ["a", "b"]
    ledger.compact(days[20])
    assert len(ledger.transitions([days[1]]).inputFiles()) == 1


def test_queries_leave_no_views_behind(spark, tmp_path):
    for folder, n in (("a", 3), ("b", 5)):
        spark.range(n).write.parquet(f"{tmp_path}/{folder}/t_of_query.parquet")
    one = LakeSource(spark, f"{tmp_path}/a").query("SELECT * FROM t_of_query", ("t_of_query",))
    two = LakeSource(spark, f"{tmp_path}/b").query("SELECT * FROM t_of_query", ("t_of_query",))
    assert (one.count(), two.count(), one.join(two, "id").count()) == (3, 5, 3)
    assert not spark.catalog.tableExists("t_of_query")


def test_verification_of_many_runs_scans_once_per_schema(spark, tmp_path, monkeypatch):
    small_table(spark, tmp_path)
    extractor = on(spark, tmp_path)
    days = [DAY + timedelta(days=n) for n in range(6)]
    extractor.extract_many([window(day, bootstrap=False) for day in days]).collect()
    from loadledger.plans import extract

    scans = []
    real = extract.run_contents
    monkeypatch.setattr(extract, "run_contents", lambda *a: scans.append(a) or real(*a))
    assert {r.verdict for r in extractor.verify(days).collect()} == {"valid"}
    assert len(scans) == 1


def test_runs_are_logged_updated_and_taken_up_again(spark, extractor, monkeypatch):
    extractor.run_log, extractor.name = RunLog(spark, new_dir(spark, "runlog")), "nightly"
    log = extractor.run_log
    assert log.runs().collect() == []
    extractor.extract_many([full("nation"), full("no_such_table")], run_id="r1").collect()
    extractor.extract_many([full("region")], run_id="r2").collect()
    rows = {r.run_id: r for r in log.runs([DAY]).collect()}
    assert (rows["r1"].run_status, rows["r1"].name) == ("PARTIAL", "nightly")
    assert (rows["r1"].attempted, rows["r1"].succeeded, rows["r1"].failed, rows["r1"].records) == (2, 1, 1, 25)
    assert rows["r2"].run_status == "SUCCESS" and rows["r2"].ended_ts >= rows["r2"].started_ts
    left = log.resume("r1", DAY, extractor.ledger).collect()
    assert [r.table_key for r in left] == ["db.no_such_table"]
    log.update("r1", DAY, "PAUSED")
    row = log.runs().where("run_id = 'r1'").first()
    assert (row.run_status, row.ended_ts, row.records) == ("PAUSED", None, 25)
    real = LakeSource.table
    monkeypatch.setattr(LakeSource, "table", lambda self, name, *a: real(self, name.replace("no_such_table", "part"), *a))
    extractor.extract_many([full("nation"), full("no_such_table")], run_id="r1").collect()
    row = log.runs().where("run_id = 'r1'").first()
    assert (row.run_status, row.restarts, row.succeeded) == ("SUCCESS", 1, 2)
