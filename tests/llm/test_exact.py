from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.exact import exact_dedup, exact_groups

DOCS = "doc_id long, text string, lang string"
ROWS = [
    (5, "a  b\n", "x"),
    (3, "a b ", None),
    (9, "a\t\x0bb\r", "y"),
    (1, "", None),
    (2, None, None),
    (7, "é" * 200_000, "z"),
    (8, "é" * 200_000, "z"),
    (10, "a b", "x"),
    (11, " ", "x"),
    (4, " ", None),
]


def test_agrees_with_sql_on_hard_rows(tables, agrees, spark):
    folder = tables(documents=(ROWS, DOCS))
    agrees("op8_exact_dedup", QUERIES["op8_exact_dedup"](spark, folder), folder)


def test_agrees_with_sql_on_given_tables(spark, sf_dir, agrees):
    agrees("op8_exact_dedup", QUERIES["op8_exact_dedup"](spark, sf_dir), sf_dir)


def test_colliding_hashes_are_told_apart(spark):
    rows = [(i, f"{i % 3} text {i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_groups(docs, hashed=lambda text: F.unhex(F.md5(F.substring(text, 1, 1)))).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text, []).append(doc_id)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {
        (d, min(groups[t]), len(groups[t]), d == min(groups[t])) for d, t in rows
    }


def test_null_and_repeated_ids(spark):
    rows = [(None, "a"), (4, "a"), (4, "a"), (4, "b"), (None, "c"), (None, "c"), (6, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(docs).collect()), key=repr)
    assert got == sorted(
        [(None, 4, 3, False), (4, 4, 3, True), (4, 4, 3, True), (4, 4, 2, True), (None, None, 2, True),
         (None, None, 2, True), (6, 4, 2, False)], key=repr)


def test_empty_table_and_clashing_columns(spark):
    shape = "doc_id long, text string, _id string, _hash int, keep_id long"
    assert exact_groups(spark.createDataFrame([], shape)).collect() == []
    docs = spark.createDataFrame([(2, "x", "a", 1, 7), (1, "x", "b", 2, 8)], shape)
    assert [r.doc_id for r in exact_dedup(docs).collect()] == [1]
    assert exact_dedup(docs).columns == docs.columns
