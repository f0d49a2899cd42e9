"""Extracts under control, and stored runs whose schema changed from one to the next."""

import threading
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger import Extractor, LakeSource, Ledger, TableSpec
from loadledger.functions.common import as_type, common_schema, common_type
from loadledger.sinks.runlog import RunLog
from loadledger.sources.runs import read_runs
from loadledger.work import exists, new_dir

DAY = date(1997, 5, 28)
# One task, so that the others find cores.
ENDLESS = "SELECT id AS k FROM range(0, 100000000000000, 1, 1) WHERE id % 7 = 8"


def extractor_of(spark, sf_dir, **options):
    return Extractor(LakeSource(spark, sf_dir), new_dir(spark, "runs"), Ledger(spark, new_dir(spark, "ledger")), **options)


def full(table, **more):
    return TableSpec("db", table, **{"is_full_extract": True, "extraction_date": DAY, **more})


def test_a_table_over_its_limit_is_cancelled_alone(spark, sf_dir):
    log = RunLog(spark, new_dir(spark, "log"))
    extractor = extractor_of(spark, sf_dir, table_limit=25, concurrent_tables=3, run_log=log, scheduler_pool="extracts")
    began = time.monotonic()
    specs = [full("endless", custom_query=ENDLESS), full("nation"), full("region")]
    got = {r.table_key: r for r in extractor.extract_many(specs, run_id="r1").collect()}
    assert time.monotonic() - began < 100
    assert got["db.nation"].success and got["db.region"].success and not got["db.endless"].success
    assert got["db.endless"].error == "cancelled: over the limit of 25 seconds"
    assert log.runs([DAY]).first().run_status == "PARTIAL"
    assert spark.sparkContext.statusTracker().getActiveJobsIds() == []
    again = {r.table_key: r for r in extractor.extract_many([full("nation"), full("part")]).collect()}
    assert again["db.nation"].skipped and again["db.part"].success


def test_a_limit_does_not_reach_tables_that_run_at_the_same_time(spark, sf_dir):
    extractor = extractor_of(spark, sf_dir, concurrent_tables=2)
    slow = "SELECT id, reflect('java.lang.Thread', 'sleep', 12000L) AS slept FROM range(0, 1, 1, 1)"
    specs = [full("endless", custom_query=ENDLESS, limit_seconds=3), full("slow", custom_query=slow)]
    got = {r.table_key: r for r in extractor.extract_many(specs).collect()}
    assert got["db.endless"].error == "cancelled: over the limit of 3 seconds"
    assert got["db.slow"].success and got["db.slow"].record_count == 1


def cancel_after(extractor, table):
    """Cancel once a table has completed."""
    while not any(r.table_key == table and r.status == "completed" for r in extractor.ledger.transitions([DAY]).collect()):
        time.sleep(0.5)
    extractor.cancel()


def test_a_cancelled_call_leaves_the_rest_to_the_next(spark, sf_dir):
    log = RunLog(spark, new_dir(spark, "log"))
    extractor = extractor_of(spark, sf_dir, concurrent_tables=1, run_log=log)
    threading.Thread(target=cancel_after, args=(extractor, "db.nation")).start()
    specs = [full("nation"), full("endless", custom_query=ENDLESS), full("region")]
    got = {r.table_key: r for r in extractor.extract_many(specs, run_id="r1").collect()}
    assert got["db.nation"].success
    assert got["db.endless"].error == got["db.region"].error == "cancelled by request"
    assert log.runs([DAY]).first().run_status == "CANCELLED"
    after = {r.table_key: r for r in extractor.extract_many([specs[0], specs[2]]).collect()}
    assert after["db.nation"].skipped and after["db.region"].success


def test_the_longest_of_last_time_starts_first(spark, sf_dir):
    extractor = extractor_of(spark, sf_dir, concurrent_tables=1)
    seconds = {"nation": 5.0, "region": 50.0, "part": 0.5}
    extractor.ledger.append_rows([
        {"seq": 1, "table_key": f"db.{table}", "business_date": DAY - timedelta(days=1), "event_ts": datetime(2024, 1, 1),
         "window_start": datetime(1997, 5, 27), "window_end": datetime(1997, 5, 28), "status": "completed", "duration_seconds": s}
        for table, s in seconds.items()])
    extractor.extract_many([full(table) for table in ("part", "nation", "supplier", "region")])
    done = extractor.ledger.transitions([DAY]).where("status = 'completed'").orderBy("seq").collect()
    assert [r.table_key for r in done] == ["db.supplier", "db.region", "db.nation", "db.part"]


@pytest.mark.parametrize("name", ["a[1]", "b{c}", "d,e", "f*g?", "h\\i", "j/k", "l:m", "ü n"])
def test_names_with_marks(spark, sf_dir, name):
    extractor = extractor_of(spark, sf_dir)
    spec = TableSpec("s{x}", name, custom_query="SELECT 1 AS k", extraction_date=DAY)
    assert extractor.extract(spec).success
    row = extractor.ledger.current([DAY]).first()
    assert row.file_size_bytes > 0 and exists(spark, row.output_path)
    assert extractor.extract(spec).skipped
    assert [tuple(r) for r in extractor.ledger.read(spec.key, DAY).collect()] == [(1,)]


def versions(extractor, queries):
    for k, text in enumerate(queries):
        spec = TableSpec("db", "t", custom_query=text, extraction_date=DAY + timedelta(days=k))
        assert extractor.extract(spec).success
    return [DAY + timedelta(days=k) for k in range(len(queries))]


def test_types_and_case_change_from_run_to_run(spark, sf_dir):
    extractor = extractor_of(spark, sf_dir, allow_type_changes=True)
    days = versions(extractor, [
        "SELECT 1 AS id, 7 AS v, named_struct('a', 1) AS s, array(1) AS l",
        "SELECT 2L AS ID, 8000000000L AS v, named_struct('A', 2.5D, 'b', 'x') AS s, array('q') AS l",
        "SELECT 3 AS id, 'nine' AS V, CAST(NULL AS STRUCT<a: INT>) AS s, CAST(NULL AS ARRAY<INT>) AS l",
    ])
    rows = extractor.ledger.read("db.t", days)
    assert [f.name.lower() for f in rows.schema] == ["id", "v", "s", "l"]
    got = sorted(rows.collect())
    assert [(r.id, r.V) for r in got] == [(1, "7"), (2, "8000000000"), (3, "nine")]
    assert [r.s and (r.s[0], r.s[1]) for r in got] == [(1.0, None), (2.5, "x"), None]
    assert [r.l for r in got] == [["1"], ["q"], None]
    every = read_runs(spark, extractor.root, runs=extractor.ledger.transitions())
    assert sorted((r.id, r.V, str(r.business_date)) for r in every.collect()) == [
        (k + 1, v, str(day)) for k, (v, day) in enumerate(zip(("7", "8000000000", "nine"), days))]
    assert extractor.ledger.read("db.t", days[0]).schema["v"].dataType == T.IntegerType()


@pytest.mark.parametrize("one,other,both", [
    ("int", "bigint", "bigint"), ("smallint", "double", "double"), ("int", "decimal(5,2)", "decimal(12,2)"), ("float", "double", "double"),
    ("decimal(38,0)", "decimal(3,2)", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"),
    ("string", "bigint", "string"), ("array<int>", "array<string>", "array<string>"), ("binary", "date", "string"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("struct<a:int>", "string", "string"), ("bigint", "float", "double")])
def test_least_common_types(one, other, both):
    kinds = [T.StructType.fromDDL(f"c {text}")[0].dataType for text in (one, other, both)]
    assert common_type(*kinds[:2]) == kinds[2] and common_type(kinds[1], kinds[0]) == kinds[2]
    assert common_schema([T.StructType().add("A", kinds[0]), T.StructType().add("a", kinds[1])]).names == ["a"]


def test_values_of_common_types(spark):
    row = spark.sql("SELECT map('k', 1) AS m, array(named_struct('x', 1)) AS l, named_struct('y', 2) AS s")
    kinds = [T.StructType.fromDDL(f"c {text}")[0].dataType for text in ("map<string,bigint>", "array<struct<x:string,z:int>>", "string")]
    made = row.select(*[as_type(F.col(f.name), f.dataType, kind).alias(f.name) for f, kind in zip(row.schema, kinds)]).first()
    assert made.m == {"k": 1} and made.l[0].x == "1" and made.l[0].z is None and made.s == '{"y":2}'
