"""Every registered query against its SQL, and rules that hold for all of their plans."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from loadledger.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    from given import SF_DIR

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, database, name):
    result = QUERIES[name](spark, sf_dir)
    rows = result.collect()
    assert len(set(result.columns)) == len(result.columns)
    if name not in SQL:
        assert rows
        return
    answer = database.execute(SQL[name])
    columns = [column[0] for column in answer.description]
    assert sorted(columns) == sorted(result.columns)
    assert in_name_order(result.columns, rows) == in_name_order(columns, answer.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_joins_runs_with_their_ledger_rows(spark):
    rows = entry(spark).collect()
    assert len(rows) == 2
    assert all(row.record_count == (row.stored_records or 0) for row in rows)
    assert any(row.record_count > 0 for row in rows)
