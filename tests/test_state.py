"""Folding, deciding and changing ledger state."""

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadledger.functions.columns import STATUSES
from loadledger.operators import progress, state
from loadledger.operators.latest import latest

T0 = datetime(2024, 1, 15, 12)
LOG = "table_key string, seq bigint, event_ts timestamp_ntz, status string, record_count bigint"


def log_of(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_walk_through(spark):
    """customers completes, orders fails and may be retried, products has not begun."""
    at = [T0 + timedelta(minutes=i) for i in range(10)]
    log = log_of(
        spark,
        [
            ("s.customers", 1, at[0], "running", None),
            ("s.customers", 2, at[1], "completed", 15000),
            ("s.orders", 3, at[0], "running", None),
            ("s.orders", 4, at[2], "failed", 0),
            ("s.products", 5, at[0], "pending", None),
        ],
    )
    folded = state.fold(log, ["table_key"])
    rows = {r.table_key: r for r in folded.collect()}
    assert rows["s.customers"].record_count == 15000
    assert rows["s.customers"].end_ts - rows["s.customers"].start_ts == timedelta(minutes=1)

    def needed(forced):
        judged = state.decide(
            folded,
            status=F.col("status"),
            forced=F.col("table_key").isin(forced),
            verdict=F.lit("valid"),
            current=F.lit(True),
            retries=F.col("retry_count"),
        )
        return {r.table_key: (r.needed, r.reason) for r in judged.collect()}

    assert needed([]) == {
        "s.customers": (False, "up_to_date"),
        "s.orders": (True, "retryable_failure"),
        "s.products": (True, "not_finished"),
    }
    assert needed(["s.customers"])["s.customers"] == (True, "forced")

    figures = progress.summary(folded, []).first()
    assert (figures.total, figures.n_completed, figures.records) == (3, 1, 15000)
    assert figures.avg_s == figures.min_s == figures.max_s == 60.0
    counts = {r.status: r.n for r in progress.status_counts(folded).collect()}
    assert counts == {"pending": 1, "running": 0, "completed": 1, "failed": 1, "skipped": 0, "retrying": 0}


def test_summary_of_nothing_has_no_durations(spark):
    figures = progress.summary(state.fold(log_of(spark, []), ["table_key"]), []).first()
    assert (figures.total, figures.records, figures.avg_s, figures.min_s) == (0, 0, 0.0, None)


def test_window_and_output_decide_about_a_success(spark):
    rows = spark.createDataFrame(
        [("a", "valid", True), ("b", "missing", True), ("c", "size_off", True), ("d", "valid", False)],
        "k string, verdict string, current boolean",
    )
    judged = state.decide(
        rows,
        status=F.lit("completed"),
        forced=F.lit(False),
        verdict=F.col("verdict"),
        current=F.col("current"),
        retries=F.lit(0),
    )
    assert {r.k: (r.needed, r.reason) for r in judged.collect()} == {
        "a": (False, "up_to_date"),
        "b": (True, "output_missing"),
        "c": (True, "output_corrupt"),
        "d": (True, "window_outdated"),
    }


def test_skipped_stays_skipped_unless_forced(spark):
    rows = spark.createDataFrame([("a", False), ("b", True)], "k string, forced boolean")
    judged = state.decide(
        rows,
        status=F.lit("skipped"),
        forced=F.col("forced"),
        verdict=F.lit("valid"),
        current=F.lit(True),
        retries=F.lit(9),
    )
    assert {r.k: r.needed for r in judged.collect()} == {"a": False, "b": True}


def test_forced_rows_lose_their_past(spark):
    at = T0
    folded = state.fold(
        log_of(spark, [("a", 1, at, "running", None), ("a", 2, at, "running", None), ("a", 3, at, "failed", 0)]),
        ["table_key"],
    )
    assert folded.first().retry_count == 1
    row = state.force(folded, F.lit(True)).first()
    assert (row.status, row.retry_count, row.start_ts, row.end_ts) == ("pending", 0, None, None)


def test_days_before_the_first_are_not_due(spark):
    keys = spark.createDataFrame([("a", date(2024, 1, 29)), ("b", date(2024, 2, 5))], "k string, d date")
    due = state.due_every_day(keys, "d", date(2024, 1, 31), "day").collect()
    assert sorted((r.k, r.day.day) for r in due) == [("a", 29), ("a", 30), ("a", 31)]


transition = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.integers(0, 4),
    st.sampled_from(STATUSES),
    st.integers(0, 9),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(transition, max_size=30))
def test_fold_and_latest_equal_a_replay(spark, steps):
    rows = [
        (key, seq, T0 + timedelta(seconds=second), status, count)
        for seq, (key, second, status, count) in enumerate(steps)
    ]
    replayed = {}
    for key, seq, ts, status, count in sorted(rows, key=lambda r: (r[2], r[1])):
        at = replayed.setdefault(key, {"start": None, "end": None, "count": None, "starts": 0})
        at.update(status=status, seq=seq)
        if status in ("running", "retrying"):
            at.update(start=ts, starts=at["starts"] + 1)
        if status in ("completed", "failed"):
            at.update(end=ts, count=count)
    log = log_of(spark, rows)
    folded = {
        r.table_key: (r.status, r.start_ts, r.end_ts, r.record_count, r.retry_count)
        for r in state.fold(log, ["table_key"]).collect()
    }
    assert folded == {
        k: (a["status"], a["start"], a["end"], a["count"], max(a["starts"] - 1, 0))
        for k, a in replayed.items()
    }
    newest = latest(log, ["table_key"], ["event_ts", "seq"])
    assert {r.table_key: r.seq for r in newest.collect()} == {k: a["seq"] for k, a in replayed.items()}
