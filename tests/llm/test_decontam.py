import random

import numpy as np
from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.decontam import (
    GAP, LEAST_POINTS, LEAST_SHARE, MATCH, MISMATCH, SEED_WORDS, Index, align, contamination, decontaminate, words_of)

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def brute_points(item, passage):
    row, best = [0] * (len(passage) + 1), 0
    for a in item:
        now = [0]
        for j, b in enumerate(passage, 1):
            now.append(max(0, row[j - 1] + (MATCH if a == b else MISMATCH), row[j] + GAP, now[j - 1] + GAP))
        row, best = now, max(best, *now)
    return best


def brute(docs, items):
    """Whole documents aligned with whole items that share a seed with them."""
    found = {}
    for doc_id, text in docs:
        words = words_of(text)
        grams = {tuple(words[k : k + SEED_WORDS]) for k in range(len(words) - SEED_WORDS + 1)}
        for item_id, item_text in items:
            item = words_of(item_text)
            if not grams & {tuple(item[k : k + SEED_WORDS]) for k in range(len(item) - SEED_WORDS + 1)}:
                continue
            own = MATCH * len(item)
            points = brute_points(item, words)
            if points >= max(LEAST_SHARE * own, min(LEAST_POINTS, own)):
                found[doc_id, item_id] = round(points / own, 9)
    return found


def edited(rng, words, share):
    out = []
    for word in words:
        turn = rng.random()
        if turn < share / 3:
            continue
        out.append(word if turn >= share else rng.choice(["new", "other", word + "s"]))
        if turn < share / 2:
            out.append("added")
    return " ".join(out)


def made():
    rng = random.Random(4)
    lexicon = [f"w{k}" for k in range(400)] + ["the", "of", "and", "to"] * 40
    text = lambda n: " ".join(rng.choices(lexicon, k=n))
    items = [(k, text(rng.randrange(8, 60))) for k in range(30)] + [(90, None), (91, "too short"), (92, "")]
    docs = [(k, text(rng.randrange(0, 300))) for k in range(60)]
    for k in range(60, 160):
        item = words_of(items[k % 30][1])
        copy = edited(rng, item, [0, 0.1, 0.2, 0.3][k % 4])
        docs.append((k, f"{text(rng.randrange(80))}, {copy.upper()}!\n{text(rng.randrange(80))} {copy if k % 7 == 0 else ''}"))
    docs += [(200, None), (201, ""), (202, "| -- |"), (203, text(150_000) + " " + items[3][1])]
    return docs, items


def test_agrees_with_brute_force_in_one_block_or_many(spark):
    docs, items = made()
    small = docs[:-1]
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = brute(small, items)
    for size in (500, 1 << 20):
        got = contamination(d, i, block_bytes=size).collect()
        assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got if r.doc_id != 203} == want
        assert [r.item_id for r in got if r.doc_id == 203] == [3]
    planted = {(k, k % 30) for k in range(60, 160) if k % 4 < 2}
    assert planted <= set(want) and not {pair for pair in want if pair[0] < 60}


def test_spans_hold_the_copy():
    item = "one two three four five six seven eight nine ten"
    index = Index([(7, item)])
    text = "x y " + item.replace("five", "FIVE,") + " z"
    assert list(index.find([text, None, "x"])) == [(0, 7, 1.0, 2, 12)]


def test_align_matches_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(0, 20))
        assert align(a, b)[0] == brute_points(a.tolist(), b.tolist())


def test_query_agrees_with_brute_force(spark, sf_dir):
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(
        "doc_id" if name == "documents" else "item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in QUERIES["op7_decontamination"](spark, sf_dir).collect()}
    assert got == brute(read("documents"), read("benchmark")) and got


def test_empty_tables_nulls_repeats_and_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, text, 1, "q"), (3, text, 1, "q"), (3, text, 1, "q"), (4, "no", 1, "q")],
                                 DOCS + ", item_id int, score string")
    items = spark.createDataFrame([(1, text), (1, text + " eleven"), (None, text)], ITEMS)
    got = sorted(((r.doc_id, r.item_id, r.score) for r in contamination(docs, items).collect()), key=repr)
    assert got == sorted([(d, i, 1.0) for d in (None, 3, 3) for i in (1, None)], key=repr)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [4]
    assert contamination(docs.limit(0), items).collect() == [] and contamination(docs, items.limit(0)).collect() == []
    assert decontaminate(docs, items.limit(0)).count() == 4


def test_an_item_of_common_words_is_still_found(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = spark.createDataFrame([(k, text) for k in range(40)], ITEMS)
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    assert contamination(docs, items).count() == 120


def test_a_shared_passage_finds_every_item_that_has_it_in_blocks_of_any_size(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(40))
    items = [(k, f"{passage} {' '.join(rng.choices([f'q{j}' for j in range(500)], k=12))}") for k in range(60)]
    items += [(100 + k, f"which of the following {' '.join(f'r{k}x{j}' for j in range(20))}") for k in range(60)]
    docs = [(1, f"before it {passage} after it"), (2, "which of the following is true of p1 and p2"),
            (3, passage.replace("p7 ", "other ").replace("p20 ", "")), (4, items[70][1])]
    want = brute(docs, items)
    assert {(d, i) for d, i in want} == {(d, i) for d in (1, 3) for i in range(60)} | {(4, 110)}
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for size in (2_000, 1 << 20):
        got = contamination(d, i, block_bytes=size).collect()
        assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == want


def test_a_long_passage_of_a_longer_item_is_found():
    words = [f"w{k}" for k in range(1000)]
    index = Index([(7, " ".join(words)), (8, " ".join(words[:400]))])
    found = {row[:2]: (round(row[2], 9), *row[3:]) for row in index.find([
        " ".join(["before", *words[300:350], "after"]), " ".join(words[300:329]), " ".join(words[300:330])])}
    assert found == {(0, 7): (0.05, 1, 51), (0, 8): (0.125, 1, 51), (2, 7): (0.03, 0, 30), (2, 8): (0.075, 0, 30)}


def test_scripts_without_spaces_are_cut_into_words():
    items = ["北京是中华人民共和国的首都和政治中心吗", "日本で一番高い山は富士山ですか", "ประเทศไทยมีเมืองหลวงชื่อว่าอะไร"]
    index = Index(list(enumerate(items)))
    texts = [f"前文。{items[0]}？后文", f"Q: {items[1]}!", f"ถาม {items[2]} ตอบ", "上海是一座很大的城市。", None, "no such words"]
    assert [(row[:2], row[2]) for row in index.find(texts)] == [((k, k), 1.0) for k in range(3)]
    assert words_of("Der Name 東京都,x y") == ["der", "name", "東京", "京都", "x", "y"]


def test_short_items_are_found_whole(spark):
    docs = spark.createDataFrame([(1, "what is zeolite made of indeed"), (2, "zeolite is made of"), (3, "One, word!"), (4, None)], DOCS)
    items = spark.createDataFrame([(1, "zeolite made of"), (2, "word"), (3, ""), (4, "is made of")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score) for r in contamination(docs, items).collect()}
    assert got == {(1, 1, 1.0), (2, 4, 1.0), (3, 2, 1.0)}
    assert [r.doc_id for r in decontaminate(docs, items).collect()] == [4]


def test_blocks_of_items_are_conditions_one_after_the_other(spark):
    docs = spark.createDataFrame([(i, f"some text of its own number w{i} and v{i} and u{i} end") for i in range(40)], DOCS)
    items = spark.createDataFrame([(i, f"number w{i} and v{i} and u{i} end") for i in range(0, 40, 3)], "item_id long, text string")
    kept = decontaminate(docs, items, block_bytes=60)
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(40) if i % 3]
