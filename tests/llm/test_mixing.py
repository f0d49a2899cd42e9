import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.mixing import fly, land, mix, targets

DOCS = "doc_id long, source string, text string"


def brute_targets(sizes):
    """Fill by weight until no source is above three times its size."""
    named = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(named)}
    capped, total = set(), sum(sizes.values())
    while True:
        share = sum(weight[s] for s in named if s not in capped)
        rest = total - sum(3 * sizes[s] for s in capped)
        over = {s for s in named if s not in capped and Fraction(weight[s] * rest, share) > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else float(Fraction(weight[s] * rest, max(share, 1))) for s in named}
        capped |= over


def check(rows, words):
    sizes = {}
    for (_, source, _), n in words:
        sizes[source] = sizes.get(source, 0) + n
    want = brute_targets(sizes)
    taken, biggest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        if r.source_size:
            assert r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= max(2, biggest[source])
    return taken, want


def sized(rows):
    return [(r, len((r[2] or "").encode().split())) for r in rows]


@pytest.mark.parametrize("block", [6, 20_000])
def test_sources_come_near_their_targets(spark, block):
    random.seed(block)
    rows = [(i, random.choice(["a", "b", "c", "é", None, "hot", "hot", "hot"]), "w " * int(random.paretovariate(0.9)))
            for i in range(1500)]
    rows += [(2000, "tiny", "one"), (2001, "blank", " \n "), (2002, "none", None), (2003, "", "x y")]
    docs = spark.createDataFrame(rows, DOCS)
    got = mix(docs, block=block).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    taken, want = check(got, sized(rows))
    assert abs(taken["hot"] - want["hot"]) <= 3
    again = mix(docs.repartition(7), block=block).collect()
    assert {(r.doc_id, r.copies) for r in got} == {(r.doc_id, r.copies) for r in again}


def test_query_on_given_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text").collect()]
    got = QUERIES["op2_mix_sources"](spark, sf_dir).collect()
    assert {(r.doc_id, r.size) for r in got} == {(r[0], n) for r, n in sized(rows)}
    check(got, sized(rows))


def test_null_and_repeated_rows_and_empty_table(spark):
    big = 2**60 + 1
    rows = [(None, "a", "x y z")] * 9 + [(big, "a", "x y z")] * 9 + [(3, None, "x " * 30), (4, "b", "y " * 200_000)]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], DOCS + ", size int, hash string")
    got = mix(docs).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)
    assert mix(docs.limit(0)).collect() == []


def test_targets_match_brute_force(spark):
    random.seed(3)
    for _ in range(3):
        sizes = {random.choice("abcdefgh") * k: int(random.paretovariate(0.4)) % 10**6 for k in range(1, 12)} | {None: 5}
        rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = brute_targets(sizes)
        assert {r.source: r.target for r in rows} == {s: pytest.approx(t) for s, t in want.items()}


def test_a_flight_keeps_both_sums_and_leaves_two():
    random.seed(0)
    for trial in range(200):
        n = random.randrange(40)
        sizes = [random.randrange(1, 6 if trial % 2 else 900) for _ in range(n)]
        chances = [random.choice([0.0, 1.0, 0.3, random.random()]) for _ in range(n)]
        out = fly(sizes, chances, random.Random(trial))
        assert sum(out) == pytest.approx(sum(chances))
        assert sum(p * x for p, x in zip(out, sizes)) == pytest.approx(sum(p * x for p, x in zip(chances, sizes)))
        assert sum(0 < p < 1 for p in out) <= 2


def test_flights_are_unbiased():
    sizes, chances = [3, 5, 9, 2, 7], [0.2, 0.5, 0.4, 0.7, 0.3]
    sums = [0.0] * 5
    for trial in range(4000):
        for k, p in enumerate(fly(sizes, chances, random.Random(trial))):
            sums[k] += p / 4000
    assert sums == pytest.approx(chances, abs=0.03)


def test_landing_is_the_nearest_sum():
    random.seed(2)
    for _ in range(100):
        n = random.randrange(9)
        sizes = [random.randrange(1, 60) for _ in range(n)]
        chances = [random.choice([0.0, 1.0, random.random()]) for _ in range(n)]
        out = land(sizes, chances)
        left = [k for k in range(n) if 0 < chances[k] < 1]
        aim = sum(sizes[k] * chances[k] for k in left)
        best = min(abs(sum(sizes[k] for i, k in enumerate(left) if bits >> i & 1) - aim) for bits in range(1 << len(left)))
        assert set(out) <= {0.0, 1.0}
        assert abs(sum(sizes[k] * out[k] for k in left) - aim) <= best + 1
