import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.repeats import LENGTH, remove_repeats
from loadledger.llm.suffix import common_prefixes, suffix_array


def brute(rows):
    """Spans taken out per row, from a table of every string."""
    rank = lambda i: (i is None, i)
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for at in range(len(b) - LENGTH + 1):
            s = b[at : at + LENGTH]
            if s not in first or rank(i) < rank(first[s]):
                first[s] = i
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for at in range(len(b) - LENGTH + 1):
            if rank(first[b[at : at + LENGTH]]) < rank(i):
                gone[at : at + LENGTH] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(result):
    return sorted(((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans),
                    hashlib.sha256(r.kept).hexdigest()) for r in result.collect()), key=repr)


def made(seed, count=220):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé ", k=rng.randrange(2, 9)))
    passages = ["".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    passages += ["-" * 300, "ab" * 90, "x" * 49, "y" * 50, "z" * 51]
    rows = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(rng.choice([p, p[a:], p[:a], p[:a] + "!" + p[a + 1 :], word() * 3]))
        rows.append((rng.choice([i, i, i, 7, None, -i]), "".join(parts)))
    return rows + [(900, None), (901, ""), (902, passages[0]), (903, passages[0]), (2**62, passages[1] * 3)]


@pytest.mark.parametrize("batch, shard", [(700, 2000), (1 << 22, 1 << 22)])
def test_agrees_with_brute_force(spark, batch, shard):
    rows = made(batch)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, id string, batch int")
    assert rows_of(remove_repeats(docs.repartition(5), batch_bytes=batch, shard_bytes=shard)) == brute(rows)


def test_query_agrees_with_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in QUERIES["op3_suffix_dedup"](spark, sf_dir).collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.collect()]) and any(r[2] for r in got)


def test_long_text_and_empty_table(spark):
    rng = random.Random(0)
    long = "".join(rng.choices("abcdefgh ", k=1_500_000))
    docs = spark.createDataFrame([(1, long[1_000_000:1_000_200]), (2, long), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert [tuple(s) for s in got[2].spans] == [(1_000_000, 1_000_200)] and not got[1].spans
    assert bytes(got[2].kept).decode() == long[:1_000_000] + long[1_000_200:]
    assert remove_repeats(docs.limit(0)).collect() == []
    assert rows_of(remove_repeats(docs.where(F.col("doc_id") == 3)))[0][:4] == (3, 0, 0, 0)


def test_suffix_arrays_and_prefixes_match_brute_force():
    rng = random.Random(0)
    for trial in range(800):
        kinds = rng.choice([1, 2, 3, 256])
        text = bytes(rng.randrange(kinds) for _ in range(rng.randrange(1, 40)))
        if trial % 3 == 0:
            text = (text[:1] * rng.randrange(1, 9) + text[:4]) * rng.randrange(1, 5)
        data = np.frombuffer(text, np.uint8)
        order = suffix_array(data)
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        most = rng.choice([5, 8, 50])
        shared = common_prefixes(data, order, most)
        for place in range(1, len(text)):
            a, b = text[want[place] :], text[want[place - 1] :]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[place] == min(same, most)
