"""Rules, drift, manifests, verdicts and unreadable files, against small planted cases."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger.functions.columns import iso_text, parse_day, parse_iso, storage_path, table_key
from loadledger.functions.hashing import fingerprint, quick_fingerprint, row_text
from loadledger.operators import quality
from loadledger.sinks.runs import output_files, write_batches
from loadledger.work import new_dir


def kinds(**columns):
    named = {"int": T.IntegerType(), "string": T.StringType(), "decimal": T.DecimalType(10, 2)}
    return T.StructType([T.StructField(name, named[kind]) for name, kind in columns.items()]).json()


def test_drift_between_neighbouring_runs(spark):
    runs = {
        "r1": kinds(id="int", name="string", email="string"),
        "r2": kinds(id="int", name="string", email="string", phone="string"),
        "r3": kinds(id="decimal", name="string", phone="string"),
    }
    rows = [("customers", run, text, datetime(2024, 1, n), n) for n, (run, text) in enumerate(runs.items(), 1)]
    rows += [("others", "r1", runs["r3"], datetime(2024, 1, 1), 9), ("others", "r0", None, datetime(2024, 1, 2), 9)]
    stored = spark.createDataFrame(rows, "table_key string, run_id string, schema_json string, event_ts timestamp_ntz, seq long")
    drift = quality.schema_drift(quality.schema_rows(stored))
    changes = {(r.run_no, r.column): (r.change, r.is_error) for r in drift.collect()}
    assert {r.table_name for r in drift.collect()} == {"customers"}
    assert changes == {
        (2, "id"): ("same", False),
        (2, "name"): ("same", False),
        (2, "email"): ("same", False),
        (2, "phone"): ("added", False),
        (3, "id"): ("type_changed", True),
        (3, "name"): ("same", False),
        (3, "phone"): ("same", False),
        (3, "email"): ("removed", False),
    }


def test_verdicts(spark):
    cases = [
        ("missing", 10, None, "a", None),
        ("no_data", 10, 0, "a", "b"),
        ("size_off", 100, 106, "a", "a"),
        ("size_off", 100, 101, "a", "a"),
        ("content_changed", 100, 100, "a", "b"),
        ("valid", 100, 100, None, "b"),
        ("valid", 0, 0, "a", "a"),
        ("size_off", 0, 7, None, None),
        ("valid", None, 7, None, None),
        ("missing", None, None, None, None),
    ]
    rows = spark.createDataFrame(cases, "wanted string, r bigint, a bigint, rh string, ah string")
    found = quality.verdict(F.col("r"), F.col("a"), F.col("rh"), F.col("ah"))
    assert rows.where(found != F.col("wanted")).count() == 0
    sizes = spark.createDataFrame([(100, 105), (100, 106), (0, 7)], "r bigint, a bigint")
    judged = sizes.select(quality.verdict(F.col("r"), F.col("a"), tolerance=quality.BYTES_TOLERANCE).alias("v"))
    assert [r.v for r in judged.collect()] == ["valid", "size_off", "valid"]


def test_manifest_sees_every_change(spark):
    def digests(rows):
        root = new_dir(spark, "batches")
        write_batches(rows, root, F.lit("2024-01-01").cast("date"), "r1")
        manifest = quality.file_manifest(spark, root, r"batch_date=[^/]+/run_id=[^/]+")
        return manifest.first(), root

    row, root = digests(spark.range(1000))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = files.option("pathGlobFilter", "*.parquet").load(root).select("length").collect()
    assert (row.n_files, row.n_bytes) == (len(listed), sum(f.length for f in listed))
    assert row.run == "batch_date=2024-01-01/run_id=r1"
    again = quality.file_manifest(spark, root, r"batch_date=[^/]+/run_id=[^/]+").first()
    assert again.digest == row.digest
    spark.range(1).coalesce(1).write.mode("append").parquet(f"{root}/{row.run}")
    changed = quality.file_manifest(spark, root, r"batch_date=[^/]+/run_id=[^/]+").first()
    assert changed.digest != row.digest and changed.n_files == row.n_files + 1


def test_sizes_need_no_content(spark):
    root = new_dir(spark, "batches")
    write_batches(spark.range(10), root, F.lit("2024-01-01").cast("date"), "r1")
    plan = quality.file_manifest(spark, root, "run_id=[^/]+")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in text
    read = quality.file_manifest(spark, root, "run_id=[^/]+", spark.range(1).schema).first()
    assert read.records == 10 and read.fingerprint == spark.range(10).agg(quick_fingerprint(spark.range(1).schema)).first()[0]


def test_broken_files_are_found_and_sound_ones_are_not(spark):
    root = new_dir(spark, "runs")
    spark.range(100).repartition(3).write.parquet(f"{root}/good")
    spark.range(2).selectExpr("'junk'").repartition(2).write.text(f"{root}/bad")
    schema = spark.range(1).schema
    paths = [r.path for r in quality.unreadable_files(spark, root, schema).collect()]
    assert len(paths) == 2 and all("/bad/" in path for path in paths)


def test_rules_name_what_is_wrong(spark):
    rows = spark.createDataFrame([(1, "x", 5), (2, " ", 5), (3, None, -1)], "id int, name string, n int")
    rules = {"name": quality.is_blank(F.col("name")), "n": F.col("n") < 0}
    broken = quality.violations(rows, ["id"], rules).collect()
    assert sorted(broken) == [(2, "name"), (3, "n"), (3, "name")]
    good, bad = quality.quarantine(rows, rules, new_dir(spark, "judged"))
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: sorted(r.violations) for r in bad.collect()} == {2: ["name"], 3: ["n", "name"]}


pairs = st.tuples(st.one_of(st.none(), st.text("ab;:=~\\1", max_size=4)), st.one_of(st.none(), st.text("ab;:=~\\1", max_size=4)))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(pairs, min_size=1, max_size=40, unique=True))
def test_row_text_tells_all_rows_apart_and_order_does_not_count(spark, rows):
    frame = spark.createDataFrame(rows, "a string, b string")
    texts = {r.t for r in frame.select(row_text(["a", "b"]).alias("t")).collect()}
    assert len(texts) == len(rows)
    backwards = spark.createDataFrame(rows[::-1], "a string, b string").repartition(3)
    prints = [f.agg(fingerprint(["b", "a"])).first()[0] for f in (frame, backwards)]
    assert prints[0] == prints[1]


def test_file_counts(spark):
    counts = spark.createDataFrame([(0,), (500_000,), (500_001,), (9_000_000_000,)], "n bigint")
    files = counts.select(output_files(F.col("n")).alias("f")).collect()
    assert [r.f for r in files] == [1, 1, 2, 18_000]


def test_paths(spark):
    cases = {
        "s3://b/x": "s3://b/x",
        "abfss://c@a/x": "abfss://c@a/x",
        "gs://b/x": "gs://b/x",
        "/dbfs/x": "/dbfs/x",
        "/data/x": "/dbfs/data/x",
        "data/x": "/dbfs/data/x",
    }
    rows = spark.createDataFrame(list(cases.items()), "given string, wanted string")
    assert rows.where(storage_path(F.col("given")) != F.col("wanted")).count() == 0


def test_texts_that_are_no_dates(spark):
    rows = spark.createDataFrame(
        [("2024-01-05",), ("2024-1-5",), ("2024-02-30",), ("2024/01/05",), ("soon",), (None,)], "t string"
    )
    parsed = [r.d and str(r.d) for r in rows.select(parse_day(F.col("t")).alias("d")).collect()]
    assert parsed == ["2024-01-05", "2024-01-05", None, None, None, None]
    moments = spark.createDataFrame([("2024-01-05T10:00:00Z",), ("2024-01-05T10:00:00+02:00",), ("x",)], "t string")
    found = [str(r.m) for r in moments.select(parse_iso(F.col("t")).alias("m")).collect()]
    assert found == ["2024-01-05 10:00:00", "2024-01-05 08:00:00", "None"]


def test_keys_drop_an_empty_schema(spark):
    rows = spark.createDataFrame([("s", "x", "t"), ("s", "", "t"), ("s", None, "t")], "a string, b string, c string")
    keys = rows.select(table_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).collect()
    assert [r.k for r in keys] == ["s.x.t", "s.t", "s.t"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_text_depends_on_no_zone_and_no_clock(spark, zone):
    wanted = {
        "2024-01-15T02:00:00Z": "2024-01-15 02:00:00",
        "2024-03-10T02:30:00": "2024-03-10 02:30:00",
        "2024-03-10 02:30:00.123456": "2024-03-10 02:30:00.123456",
        "2024-01-15T02:00:00.5-05:00": "2024-01-15 07:00:00.500000",
        "2024-01-15T02:00+0530": "2024-01-14 20:30:00",
        "12:30": None,
        "2024": None,
        "2024-01-15": None,
        "2024-02-30T00:00:00": None,
        "soon": None,
        "": None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(t,) for t in wanted], "t string").select("t", parse_iso(F.col("t")).alias("m"))
        assert {r.t: r.m and str(r.m) for r in rows.collect()} == wanted
        moment = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 0, 123456),)], "m timestamp_ntz")
        back = moment.select(parse_iso(iso_text(F.col("m"))).alias("b")).first().b
        assert back == datetime(2024, 3, 10, 2, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_any_column_can_be_hashed(spark):
    frame = spark.sql(
        "SELECT map('b', 1, 'a', 2) AS m, named_struct('x', map(1, map('k', 2))) AS s, "
        "array(map('q', array(1))) AS a, 1 AS `dotted.name`, CAST(NULL AS STRUCT<y: MAP<INT, INT>>) AS n"
    )
    turned = spark.sql(
        "SELECT map('a', 2, 'b', 1) AS m, named_struct('x', map(1, map('k', 2))) AS s, "
        "array(map('q', array(1))) AS a, 1 AS `dotted.name`, CAST(NULL AS STRUCT<y: MAP<INT, INT>>) AS n"
    )
    changed = frame.withColumn("s", F.expr("named_struct('x', map(1, map('k', 3)))"))
    prints = [f.agg(quick_fingerprint(f.schema)).first()[0] for f in (frame, turned, changed)]
    assert prints[0] == prints[1] != prints[2]
    maps = frame.select("m")
    bare = spark.range(3).select()
    assert maps.agg(quick_fingerprint(maps.schema)).first()[0] != prints[0]
    assert bare.agg(quick_fingerprint(bare.schema)).first()[0]


def test_one_pass_over_judged_rows(spark, sf_dir):
    from loadledger.catalog import QUERIES

    plan = QUERIES["quarantine_split"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
