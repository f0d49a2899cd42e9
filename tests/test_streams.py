"""Streams that stop and go on."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loadledger.streaming import arrivals, daily, ingest, live
from loadledger.streaming.attempts import attempts
from loadledger.work import new_dir

SCHEMA = "table_key string, seq bigint, event_ts timestamp_ntz, status string"
T0 = datetime(2024, 1, 1, 10)


def add(spark, inbox, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def stream(spark, inbox):
    return ingest.file_stream(spark, inbox, spark.createDataFrame([], SCHEMA).schema)


def test_ingest_goes_on_where_it_stopped(spark):
    inbox, root, checkpoint = (new_dir(spark, p) for p in ("inbox", "stored", "progress"))

    def run():
        day = F.to_date("event_ts")
        ingest.ingest_new_files(stream(spark, inbox), root, day, checkpoint).awaitTermination()
        return sorted(r.seq for r in spark.read.parquet(root).collect())

    add(spark, inbox, [("a", 1, T0, "running"), ("b", 2, T0 + timedelta(days=1), "running")])
    assert run() == [1, 2]
    assert run() == [1, 2]
    add(spark, inbox, [("a", 3, T0, "completed")])
    assert run() == [1, 2, 3]
    stored = spark.read.parquet(root).groupBy("batch_date").count().collect()
    assert sorted(r["count"] for r in stored) == [1, 2]


def test_live_state_follows_late_and_early_rows(spark):
    inbox, root, checkpoint = (new_dir(spark, p) for p in ("inbox", "states", "progress"))

    def run():
        query = live.follow_states(stream(spark, inbox), ["table_key"], ["event_ts", "seq"], root, checkpoint)
        query.awaitTermination()
        return {r.table_key: r.status for r in live.live_states(spark, root, ["table_key"]).collect()}

    add(spark, inbox, [("a", 1, T0, "running"), ("b", 2, T0, "running")])
    assert run() == {"a": "running", "b": "running"}
    add(spark, inbox, [("a", 4, T0 + timedelta(hours=2), "completed")])
    assert run() == {"a": "completed", "b": "running"}
    add(spark, inbox, [("a", 3, T0 + timedelta(hours=1), "failed"), ("b", 5, T0 + timedelta(hours=1), "failed")])
    assert run() == {"a": "completed", "b": "failed"}


def test_windows_close_once_and_late_rows_are_left_out(spark):
    inbox, root, checkpoint = (new_dir(spark, p) for p in ("inbox", "windows", "progress"))

    def run():
        counts = daily.windowed_counts(stream(spark, inbox), "event_ts", lateness="1 hour")
        daily.store_closed(counts, root, checkpoint).awaitTermination()
        rows = spark.read.schema(counts.schema).parquet(root).collect()
        return sorted((r.window_start.day, r.n) for r in rows)

    add(spark, inbox, [("a", 1, T0, "x"), ("a", 2, T0, "x"), ("a", 3, T0 + timedelta(days=2), "x")])
    assert run() == [(1, 2)]
    add(spark, inbox, [("a", 4, T0, "x"), ("a", 5, T0 + timedelta(days=4), "x")])
    assert run() == [(1, 2), (3, 1)]


def test_stored_states_stay_few(spark):
    inbox, root, checkpoint = (new_dir(spark, p) for p in ("inbox", "states", "progress"))
    from loadledger.work import paths

    for batch in range(9):
        add(spark, inbox, [("a", batch, T0 + timedelta(hours=batch), f"s{batch}"), (f"k{batch}", batch, T0, "x")])
        live.follow_states(
            stream(spark, inbox), ["table_key"], ["event_ts", "seq"], root, checkpoint, merge_after=3
        ).awaitTermination()
        folders = paths(spark, f"{root}/*/batch_id=*")
        assert len(folders) <= 5
        found = {r.table_key: r.status for r in live.live_states(spark, root, ["table_key"]).collect()}
        assert found == {"a": f"s{batch}"} | {f"k{n}": "x" for n in range(batch + 1)}


def test_starts_come_out_with_their_first_end_or_abandoned(spark):
    inbox, root, checkpoint = (new_dir(spark, p) for p in ("inbox", "attempts", "progress"))
    kept = []

    def at(hour):
        return T0.replace(hour=0) + timedelta(hours=hour)

    def run(*rows):
        add(spark, inbox, rows)
        found = attempts(stream(spark, inbox), ["table_key"], limit="2 hours", lateness="1 hour")
        query = daily.store_closed(found, root, checkpoint)
        query.awaitTermination()
        kept.append(sum(state["numRowsTotal"] for state in query.lastProgress["stateOperators"]))
        stored = spark.read.schema(found.schema).parquet(root).collect()
        assert all(r.is_abandoned == (r.end_ts is None) for r in stored)
        return sorted((r.table_key or "", r.start_ts.hour, r.end_ts and r.end_ts.hour, r.end_status) for r in stored)

    run(
        ("a", 1, at(1), "running"), ("a", 1, at(1), "running"), ("a", 2, at(2), "retrying"),
        ("a", 3, at(3), "failed"), ("a", 4, at(3) + timedelta(minutes=1), "completed"),
        ("b", 5, at(1), "running"), ("b", 6, at(4), "completed"),
        (None, 7, at(1), "running"), (None, 8, at(2), "completed"), ("c", 9, None, "running"),
    )
    for hour in range(12, 72, 12):
        rows = run(("z", 0, at(hour), "running"), ("z", 0, at(hour) + timedelta(minutes=1), "completed"))
        assert [row for row in rows if row[0] != "z"] == [
            ("", 1, None, None), ("a", 1, 3, "failed"), ("a", 2, 3, "failed"), ("b", 1, None, None),
        ]
    assert kept[-1] <= 4


def test_a_file_delivered_twice_changes_nothing_and_late_rows_are_kept_apart(spark):
    inbox, root, checkpoint = (new_dir(spark, p) for p in ("inbox", "arrivals", "progress"))

    def run():
        rows = arrivals.once(stream(spark, inbox), ["seq"])
        arrivals.count_arrivals(rows, "event_ts", root, checkpoint).awaitTermination()
        return {
            (r.window_start and r.window_start.day): (r.n, r.n_late)
            for r in arrivals.arrival_counts(spark, root).collect()
        }

    first = [("a", 1, T0, "x"), ("a", 2, T0, "x"), ("a", 3, T0 + timedelta(days=2), "x"), ("a", 9, None, "x")]
    add(spark, inbox, first)
    once = run()
    assert once == {1: (2, 0), 3: (1, 0), None: (1, 0)}
    add(spark, inbox, first)
    assert run() == once
    assert run() == once
    add(spark, inbox, [("a", 4, T0, "x"), ("a", 4, T0, "x"), ("a", 5, T0 + timedelta(days=2), "x"), ("a", 2, T0, "x")])
    assert run() == {1: (2, 1), 3: (2, 0), None: (1, 0)}
