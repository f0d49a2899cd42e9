"""What becomes of one row does not befall others under its id, and equal rows become one."""

from loadledger.llm.decontam import decontaminate
from loadledger.llm.exact import exact_dedup
from loadledger.llm.similar import near_dedup

DOCS = "doc_id long, text string, source string"
NEAR = "one two three four five six seven eight nine ten " * 20
ROWS = [
    (1, "alpha beta gamma", "s"),
    (None, "alpha  beta gamma", "t"),
    (None, "a clean text without an id of its own", "s"),
    (2, "alpha beta gamma", "s"),
    (2, "another text under a repeated id", "s"),
    (3, "the same row came twice", "b"),
    (3, "the same row came twice", "a"),
    (3, "the same row came twice", None),
    (None, "twice and without an id", "s"),
    (None, "twice and without an id", "s"),
]
KEPT = sorted(
    [(1, ROWS[0][1], "s"), (None, ROWS[2][1], "s"), (2, ROWS[4][1], "s"), (3, ROWS[5][1], None), (None, ROWS[8][1], "s")],
    key=repr,
)


def kept(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_exact_copies_go_row_by_row(spark):
    assert kept(exact_dedup(spark.createDataFrame(ROWS, DOCS))) == KEPT


def test_near_copies_go_row_by_row(spark):
    assert kept(near_dedup(spark.createDataFrame(ROWS, DOCS))) == KEPT
    texts = [NEAR + end for end in ("", "end", "END")]
    rows = [(None, texts[0], "s"), (7, texts[1], "s"), (7, texts[2], "s"), (7, "far from them", "s"), (None, "far too", "s")]
    got = kept(near_dedup(spark.createDataFrame(rows, DOCS)))
    assert rows[3] in got and rows[4] in got and len(got) == 3 and {r[0] for r in got} == {7, None}


def test_benchmark_passages_go_row_by_row(spark):
    items = spark.createDataFrame([(1, NEAR[:49])], "item_id long, text string")
    rows = [(None, NEAR, "s"), (None, "clean words only", "s"), (4, "so " + NEAR, "s"), (4, "clean words too", "s")]
    assert kept(decontaminate(spark.createDataFrame(rows, DOCS), items)) == sorted([rows[1], rows[3]], key=repr)


def test_columns_without_an_order(spark):
    docs = spark.createDataFrame([(1, "a b", {"k": 1}), (1, "a b", {"k": 1})], "doc_id long, text string, m map<string,int>")
    assert [tuple(r) for r in exact_dedup(docs).collect()] == [(1, "a b", {"k": 1})]
