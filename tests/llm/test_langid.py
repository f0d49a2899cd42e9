import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.langid import PLACES, Model, accepted, cluster, fit, learnable, places, predict

DOCS = "doc_id long, text string, lang string"


def brute_places(text):
    """The same n-grams, one at a time."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not letters.strip():
        return Counter()
    line = " " + " ".join(letters.split()) + " "
    counts = Counter()
    for size in (1, 2, 3):
        for at in range(len(line) - size + 1):
            h = ord(line[at])
            for c in line[at + 1 : at + size]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            counts[(h + size) * 0x9E3779B1 % 2**32 >> (32 - PLACES)] += 1
    return counts


def brute_predict(model, text):
    counts = brute_places(text)
    if not counts:
        return "und", 0.0
    weights = {p: math.log1p(n) * model.idf[p] for p, n in counts.items()}
    length = math.sqrt(sum(w * w for w in weights.values()))
    cosines = [sum(w * model.centroids[p, k] for p, w in weights.items()) / length
               for k in range(model.centroids.shape[1])]
    best = max(range(len(cosines)), key=lambda k: (cosines[k], -k))
    return model.languages[model.owner[best]], min(1.0, cosines[best])


def test_places_match_brute_force():
    for text in [None, "", "123 !", "Ab", "ab  -- ÇA\n日本1x", "x" * 5000, "  a ", "a\ud800b"]:
        found, counts = places(text)
        assert dict(zip(found.tolist(), counts.tolist())) == dict(brute_places(text))


def test_query_agrees_with_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(learnable(docs))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op10_language_id"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        lang, score = brute_predict(model, texts[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_language_id"](spark, folder).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_hard_rows(spark, tables):
    english = [(i, f"the thing that was here and {i} there with them", "en") for i in range(40)]
    german = [(i, f"das ist nicht die sache und {i} auch nicht hier", "de") for i in range(40, 80)]
    hard = [(100, None, "en"), (101, "", "de"), (102, "12 34", "en"), (103, "日本語の文章です", None),
            (104, "the thing " * 60_000, None), (105, "nicht", None), (None, "that was", "xx"), (100, None, "en")]
    folder = tables(documents=(english + german + hard, DOCS))
    got = [r for r in QUERIES["op10_language_id"](spark, folder).collect() if r.doc_id is None or r.doc_id >= 100]
    seen = {r.doc_id: (r.lang_pred, r.rejected) for r in got}
    assert len(got) == len(hard)
    assert [seen[i][0] for i in (100, 101, 102)] == ["und"] * 3 and all(seen[i][1] for i in (100, 101, 102, 103))
    assert seen[104] == ("en", False) and seen[105][0] == "de" and seen[None][0] == "en"
    assert not next(r for r in got if r.doc_id is None).held_out
    assert all(0 <= r.score <= 1 for r in got)


def test_no_labels_and_empty_table_and_clashing_columns(spark):
    shape = DOCS + ", id string, score double, n int"
    none = spark.createDataFrame([(1, "some text", None, "x", 0.5, 1)], shape)
    model = fit(none)
    assert [tuple(r) for r in predict(none, model).collect()] == [(1, "und", 0.0, True)]
    assert fit(none.limit(0)).languages == [] and predict(none.limit(0), model).collect() == []
    assert none.where(accepted(model, spark, F.col("text"))).collect() == []


def test_clusters_hold_their_members():
    rng = np.random.default_rng(0)
    groups = np.repeat(np.eye(4), 20, axis=0) + rng.normal(0, 0.05, (80, 4))
    vectors = groups / np.linalg.norm(groups, axis=1, keepdims=True)
    centres, least = cluster(vectors)
    assert centres.shape == (4, 4) and least > 0.9
    assert isinstance(Model([], np.ones(1), centres, np.zeros(4), np.zeros(0)).predict("a")[0], str)
