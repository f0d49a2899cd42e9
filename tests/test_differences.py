"""Where two versions differ, against brute force, and how much is looked at for it."""

import random
from collections import Counter

from pyspark.sql import functions as F

from loadledger.operators.differences import bucket, differing_keys, leaves, unequal_buckets

SHAPE = "k string, j int, v string"


def brute(one, other):
    bags = [{}, {}]
    for bag, rows in zip(bags, (one, other)):
        for k, j, v in rows:
            bag.setdefault((k, j), Counter())[v] += 1
    out = {}
    for key in bags[0].keys() | bags[1].keys():
        a, b = (bag.get(key) for bag in bags)
        if a != b:
            out[key] = "added" if a is None else "missing" if b is None else "changed"
    return out


def test_planted_differences_are_found_exactly(spark):
    rng = random.Random(2)
    one = [(rng.choice(["hot", "hot", f"k{i}", None]), rng.randrange(200), rng.choice(["x", None, "", "~"])) for i in range(3000)]
    other = [(k, j, "new" if rng.random() < 0.01 else v) for k, j, v in one if rng.random() > 0.01] + [("extra", 1, "x"), one[5]]
    frames = [spark.createDataFrame(rows, SHAPE) for rows in (one, other)]
    want = brute(one, other)
    for bits in (4, 16, 31):
        got = differing_keys(*frames, ["k", "j"], bits=bits).collect()
        assert {(r.k, r.j): r.change for r in got} == want and len(got) == len(want)
    assert differing_keys(frames[0], frames[0].repartition(7), ["k", "j"]).collect() == []
    assert {r.change for r in differing_keys(frames[0], frames[0].limit(0), ["k", "j"]).collect()} == {"missing"}
    assert differing_keys(frames[0].limit(0), frames[0].limit(0), ["k"]).collect() == []


def test_work_grows_with_the_differences(spark):
    one = spark.range(50_000).select("id", (F.col("id") % 7).alias("v"))
    other = one.withColumn("v", F.when(F.col("id").isin(17, 40_000), -1).otherwise(F.col("v")))
    trees = [leaves(df, ["id"]) for df in (one, other)]
    found = unequal_buckets(*trees)
    assert found.count() == 2
    rows = one.join(found, bucket(["id"]) == found["bucket"], "left_semi").count()
    assert rows < 20
    kept = [tree.cache() for tree in trees]
    got = differing_keys(one, other, ["id"], one_leaves=kept[0], other_leaves=kept[1])
    assert sorted(r.id for r in got.collect()) == [17, 40_000]
