"""Ranges with even numbers of rows, on keys that are anything but even."""

import pytest
from pyspark.sql import functions as F

from loadledger.sources.lake import LakeSource
from loadledger.sources.ranges import even_cuts, predicates_at

KEYS = {
    "cubes": "id * id * id",
    "crowded": "CASE WHEN id % 3 > 0 THEN id % 5 ELSE id * 1000000 END",
    "one hot": "CASE WHEN id % 3 = 0 THEN 7 ELSE id - 15000 END",
    "nulls": "CASE WHEN id % 2 = 0 THEN id END",
    "constant": "3",
}


@pytest.mark.parametrize("name", KEYS)
def test_no_range_but_a_single_value_is_far_above_the_mean(spark, name):
    rows = spark.range(30_000).select(F.expr(KEYS[name]).cast("bigint").alias("k"))
    cuts = even_cuts(rows, "k", 12)
    ranges = [rows.where(text) for text in predicates_at("k", cuts)]
    sizes = [(r.count(), r.where("k IS NOT NULL").select("k").distinct().count()) for r in ranges]
    assert sum(n for n, _ in sizes) == 30_000
    mean = rows.where("k IS NOT NULL").count() / 12
    nulls = rows.where("k IS NULL").count()
    assert all(n <= 2 * mean + (nulls if place == 0 else 0) or values == 1 for place, (n, values) in enumerate(sizes))


def test_empty_table_and_one_part(spark):
    assert even_cuts(spark.range(0), "id", 5) == [] and even_cuts(spark.range(9), "id", 1) == []


def test_each_read_is_a_filter_on_the_files(spark, sf_dir):
    reads = LakeSource(spark, sf_dir).in_ranges("orders", "o_orderkey", 4)
    assert len(reads) == 4
    plan = reads[1]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThan(o_orderkey" in plan
