import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.graph import components
from loadledger.llm.simhash import covering_masks, fingerprint, links, near_groups
import re


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """The smallest node reachable over links of two bits or fewer."""
    nodes = sorted(set(prints))
    values = np.array(nodes, np.uint64)
    label = {n: n for n in nodes}
    changed = True
    near = {n: [nodes[j] for j in np.flatnonzero(np.bitwise_count(values ^ np.uint64(n)) <= 2)] for n in nodes}
    while changed:
        changed = False
        for n in nodes:
            least = min(label[m] for m in near[n])
            if least < label[n]:
                label[n], changed = least, True
    return label


def expected(rows):
    prints = {i: brute_fingerprint(t) for i, t in rows}
    label = brute_components(prints.values())
    least = {}
    for i, p in prints.items():
        least[label[p]] = min(i, least.get(label[p], i))
    return {i: (f"{p:016x}", least[label[p]]) for i, p in prints.items()}


def test_given_tables_agree_with_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash_near_dedup"](spark, sf_dir).collect()}
    assert got == expected(rows)


def test_hard_rows(spark):
    long = "é word " * 70_000
    rows = [(5, None), (2, " \t"), (9, "One  two"), (8, "one\ntwo"), (7, "ONE"), (1, "Ä b c d"), (3, "ä b c d"),
            (4, long), (6, long + "tail")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, root int, id string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_groups(docs).collect()}
    assert got == expected(rows)
    assert got[5] == ("0" * 16, 2) and got[9] == got[8]


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, "q r s t")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in near_groups(docs).collect()), key=repr)
    assert got == sorted([(None, 3), (3, 3), (3, 3), (None, None)], key=repr)
    assert near_groups(docs.limit(0)).collect() == []


def test_masks_cover_every_pair_of_bits():
    masks = covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not mask >> i & 1 and not mask >> j & 1 for mask in masks)


def test_links_connect_what_brute_force_connects(spark):
    random.seed(5)
    nodes = set()
    for _ in range(30):
        at = random.getrandbits(64)
        for _ in range(random.randrange(60)):
            nodes.add(at)
            for _ in range(random.choice([1, 2, 2, 3, 4])):
                at ^= 1 << random.randrange(64)
    centre = random.getrandbits(64)
    nodes |= {centre ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)}
    signed = [(n - (1 << 64) if n >= 1 << 63 else n,) for n in nodes]
    prints = spark.createDataFrame(signed, "fingerprint long")
    edges = links(prints)
    pairs = [(r[0] % 2**64, r[1] % 2**64) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    got = {}
    for r in components(edges).collect():
        got.setdefault(r.root, set()).add(r.node % 2**64)
    label = brute_components(nodes)
    want = {}
    for n, least in label.items():
        want.setdefault(least, set()).add(n)
    assert sorted(map(sorted, got.values())) == sorted(sorted(w) for w in want.values() if len(w) > 1)


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(1, 3000).select((F.col("id") * 7919 % 3001).alias("a"), ((F.col("id") + 1) * 7919 % 3001).alias("b"))
    assert components(edges).select("root").distinct().count() == 1
    assert components(edges.limit(0)).collect() == []


def test_fingerprint_matches_brute_force():
    random.seed(1)
    for _ in range(200):
        text = " ".join(random.choices(["Abc", "É", "x\x85y", "　", "THE", "\x1f"], k=random.randrange(9)))
        assert fingerprint(text) == brute_fingerprint(text)
