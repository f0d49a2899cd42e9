"""Windows, coverage and as-of joins against brute force, with hot keys, nulls and ties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadledger.operators.intervals import asof_join, in_windows, islands, outside_all, uncovered
from loadledger.operators.running import running

T0 = datetime(1969, 12, 30)
ROWS = "k string, t timestamp_ntz, n int"
WINDOWS = "k string, window_start timestamp_ntz, window_end timestamp_ntz, w int"


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def key(rng):
    return rng.choice(["hot"] * 4 + ["a", "b", None])


@pytest.fixture(scope="module")
def given():
    rng = random.Random(5)
    rows = [(key(rng), at(rng.choice([None, rng.randrange(6000), 60 * rng.randrange(100)])), n) for n in range(1500)]
    spans = [(60 * rng.randrange(100), rng.choice([0, 1, 30, 60, 61, 1440, 5000, -5])) for _ in range(120)]
    windows = [(key(rng), at(a), at(a + n), w) for w, (a, n) in enumerate(spans)]
    windows += [("hot", None, at(50), 500), ("hot", at(5), None, 501), ("a", T0, T0 + timedelta(microseconds=1), 502)]
    return rows, windows


def holds(w, t):
    return None not in (w[1], w[2], t) and w[1] <= t < w[2]


def test_every_window_that_holds_a_row(spark, given):
    rows, windows = given
    want = sorted((r[2], w[3]) for r in rows for w in windows if r[0] is not None and r[0] == w[0] and holds(w, r[1]))
    left, right = spark.createDataFrame(rows, ROWS), spark.createDataFrame(windows, WINDOWS)
    found = in_windows(left, "t", right, ["k"])
    assert found.columns == ["k", "t", "n", "window_start", "window_end", "w"]
    assert sorted((r.n, r.w) for r in found.collect()) == want
    free = sorted((r[2], w[3]) for r in rows for w in windows if holds(w, r[1]))
    every = in_windows(left.drop("k"), "t", right.drop("k"))
    assert sorted((r.n, r.w) for r in every.collect()) == free
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert in_windows(left, "t", right.limit(0), ["k"]).collect() == []


def test_a_long_window_costs_few_rows(spark):
    windows = spark.createDataFrame([("a", at(0), at(5_000_000), 1), ("a", at(3), at(4), 2)], WINDOWS)
    rows = spark.range(1000).select(F.lit("a").alias("k"), (F.lit(T0) + F.make_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("t"))
    found = in_windows(rows, "t", windows, ["k"])
    counts = {r.w: r["count"] for r in found.groupBy("w").count().collect()}
    assert counts == {1: 1000, 2: 1}


def test_rows_in_no_window(spark, given):
    rows, windows = given
    want = sorted(r[2] for r in rows if r[1] is not None and not any(r[0] is not None and r[0] == w[0] and holds(w, r[1]) for w in windows))
    found = outside_all(spark.createDataFrame(rows, ROWS), "t", spark.createDataFrame(windows, WINDOWS).drop("w"), ["k"])
    assert found.columns == ["k", "t", "n"]
    assert sorted(r.n for r in found.collect()) == want


@pytest.mark.parametrize("partitions", [1, 7])
def test_newest_row_before_an_instant(spark, given, partitions):
    rows, _ = given
    rng = random.Random(9)
    versions = [(key(rng), at(rng.choice([None, 60 * rng.randrange(100)])), v) for v in range(300)]
    want = {}
    for k, t, n in rows:
        past = [(u, v) for j, u, v in versions if k is not None and j == k and None not in (t, u) and u <= t]
        want[n] = max(past)[1] if past else None
    left = spark.createDataFrame(rows, ROWS).repartition(partitions)
    right = spark.createDataFrame(versions, "k string, since timestamp_ntz, v int")
    found = asof_join(left, right, ["k"], "t", "since", ["v"])
    assert found.columns == ["k", "t", "n", "since", "v"]
    got = found.collect()
    assert len(got) == len(rows) and {r.n: r.v for r in got} == want
    assert {r.v for r in asof_join(left, right.limit(0), ["k"], "t", "since").collect()} == {None}


def minutes(windows, k):
    return {m for j, a, b, *_ in windows if j == k and a is not None and b is not None
            for m in range(int((a - T0).total_seconds() // 60), int((b - T0).total_seconds() // 60))}


def ranges(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.k, []).append((r.window_start, r.window_end))
    return {k: sorted(v) for k, v in out.items()}


def check_ranges(found, want, keys):
    for k in keys:
        spans = found.get(k, [])
        assert minutes([(k, *s) for s in spans], k) == want(k)
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_coverage_and_what_it_lacks(spark, given):
    windows = [w for w in given[1] if w[3] != 502]
    covered = spark.createDataFrame(windows, WINDOWS).drop("w")
    check_ranges(ranges(islands(covered, ["k"])), lambda k: minutes(windows, k), ["hot", "a", "b", None])
    wanted = [("hot", at(-100), at(9000), 0), ("hot", at(200), at(300), 1), ("a", at(0), at(4000), 2), ("a", at(4000), at(4100), 3),
              ("new", at(7), at(9), 4), (None, at(0), at(70), 5), ("b", at(9), at(9), 6)]
    lacking = uncovered(spark.createDataFrame(wanted, WINDOWS).drop("w"), covered, ["k"])
    check_ranges(ranges(lacking), lambda k: minutes(wanted, k) - minutes(windows, k), ["hot", "a", "b", "new", None])
    assert uncovered(covered.limit(0), covered, ["k"]).collect() == []


def test_values_run_on_over_slices(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 5 > 0, F.lit("hot")).alias("k"), "id", ((F.col("id") * 37) % 101).alias("m"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"), F.lit(1).alias("one"))
    kinds = {"m": "max", "v": "last", "one": "sum"}
    listed = sorted(rows.collect(), key=lambda r: r.id)
    for before in (False, True):
        got = {r.id: r for r in running(rows, ["k"], ["id"], kinds, slices=9, before=before).collect()}
        for r in listed:
            past = [o for o in listed if o.k == r.k and (o.id < r.id if before else o.id <= r.id)]
            known = [o.v for o in past if o.v is not None]
            assert got[r.id].m == max((o.m for o in past), default=None)
            assert got[r.id].v == (known[-1] if known else None) and got[r.id].one == len(past)
