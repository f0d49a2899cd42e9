import duckdb
import pytest

from loadledger.llm import SQL

TABLES = "documents pages benchmark labels conversations".split()


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.fixture(scope="session")
def agrees(tmp_path_factory):
    """Whether a query's rows over a folder of tables are those of its SQL."""

    def compare(name, result, sf_dir):
        connection = duckdb.connect()
        import os

        for table in TABLES:
            path = f"{sf_dir}/{table}.parquet"
            if os.path.exists(path):
                files = f"{path}/*.parquet" if os.path.isdir(path) else path
                connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
        answer = connection.execute(SQL[name])
        columns = [column[0] for column in answer.description]
        assert sorted(columns) == sorted(result.columns)
        assert in_name_order(result.columns, result.collect()) == in_name_order(columns, answer.fetchall())

    return compare


@pytest.fixture
def tables(spark, tmp_path):
    """Write rows as a table of a fresh folder, in the layout of the standard tables."""

    def write(**named):
        for name, (rows, schema) in named.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
