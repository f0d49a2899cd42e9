import random

import numpy as np
import pytest
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.tokens import PrefixCounter, longest_within, prefix_counts, tokens_before

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ODD = ["a", "b", "the", "ing", "'", "s", "ll", "RE", " ", "  ", "\n", "é", "é", "́", "İ", "ſ", "K", "日本", "가", "ᄀ",
       "ᅡ", "ᆨ", "😀", "1", "²", "-", "<|", "|>", "<|endoftext|>", "endoftext", "​", "क़", "Σ", "\x1c", "\x85", "ß",
       "ﬁ", "　", "𝒳", "\x00"]


def count(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def made():
    return PrefixCounter(PATH)


def check(made, text):
    counts = np.frombuffer(made.table(text), np.int8).cumsum(dtype=np.int64)
    assert [count(text[: n + 1]) for n in range(len(text))] == counts.tolist()


def test_every_plain_character(made):
    for code in [*range(0x180), *range(0x2010, 0x2028), 0x20AC]:
        check(made, f"a{chr(code)}b'{chr(code)}1{chr(code)}{chr(code)}")


def test_every_prefix_of_odd_texts(made):
    random.seed(3)
    for text in ["don't we'll I'VE it's ''s '' x're'll", "..<|startoftext|><|endoftext|>..<|endoftext| a", "aaaaaaaaaaaa" * 9]:
        check(made, text)
    for _ in range(600):
        check(made, "".join(random.choices(ODD, k=random.randrange(1, 14))))


def test_pairs_stay_apart_as_the_library_says(made):
    random.seed(4)
    for _ in range(3000):
        word = "".join(random.choices("etaoinshrd", k=random.randrange(1, 16)))
        assert made._word(word)[-1] == count(word)


def test_what_is_remembered_is_bounded_and_does_not_matter(monkeypatch):
    monkeypatch.setattr("loadledger.llm.tokens.REMEMBERED", 5)
    made = PrefixCounter(PATH)
    check(made, "some words and some words and other words日本 again, some words 日本 é")
    assert len(made.tables) <= 5 and len(made.apart) <= 5


def test_given_tables_agree_with_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        i: (len((t or "").encode()), count(t), count(t) > 2048) for i, t in texts.items()}
    assert len(got) == len(texts)


def test_questions_are_answered_from_the_table(spark):
    texts = ["Hello there, don't go 日本 away", "", None, "e" * 300 + " and more " * 20_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    table = prefix_counts(docs, PATH)
    asked = table.select(
        "doc_id", "n_tokens", tokens_before("changes", F.lit(7)).alias("seven"), longest_within("changes", F.lit(4)).alias("four"),
        longest_within("changes", F.lit(-1)).alias("none"), tokens_before("changes", F.lit(10**9)).alias("all"))
    for r in asked.collect():
        text = texts[r.doc_id] or ""
        assert r.seven == count(text[:7]) and r.all == r.n_tokens == count(text) and r.none == 0
        assert r.four == max([n for n in range(min(len(text), 60) + 1) if count(text[:n]) <= 4])


def test_repeated_null_and_clashing(spark):
    rows = [(None, "a b", "x", 1), (3, "a b", "x", 1), (3, "a b", "y", 2), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, n_tokens int")
    got = sorted((str(r.doc_id), r.n_tokens) for r in prefix_counts(docs, PATH).collect())
    assert got == [("3", 2), ("3", 2), ("None", 0), ("None", 2)]
    assert prefix_counts(docs.limit(0), PATH).collect() == []
