"""What a database would be asked, without a database: texts, options and range conditions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadledger import JdbcSource, TableSpec
from loadledger.plans.spec import read_spec
from loadledger.sources.ranges import range_cuts, range_number, range_predicates


@pytest.fixture
def oracle(spark):
    return JdbcSource.oracle(spark, "db.example", 1521, "XE", "me", "secret", fetch_size=500)


def test_urls_and_drivers(spark, oracle):
    assert oracle.url == "jdbc:oracle:thin:@db.example:1521:XE"
    server = JdbcSource.sql_server(spark, "db.example", 1433, "sales", "me", "secret")
    assert server.url == "jdbc:sqlserver://db.example:1433;databaseName=sales"
    assert server.relation("Orders", "dbo") == "dbo.Orders"
    assert server.relation("Order Lines", "dbo") == "dbo.[Order Lines]"


def test_options_of_a_plain_read(oracle):
    options = oracle.options(dbtable=oracle.relation("ORDERS", "SALES"))
    assert options["dbtable"] == "SALES.ORDERS"
    assert options["fetchsize"] == "500"
    assert (options["user"], options["password"]) == ("me", "secret")
    assert "numPartitions" not in options and "query" not in options


def test_identifiers_cannot_break_out(oracle):
    assert oracle.relation('x" WHERE 1=1 --') == '"x"" WHERE 1=1 --"'


def test_as_of_read_is_a_derived_table(spark, oracle):
    text = oracle.relation("ORDERS", "SALES", datetime(2024, 1, 15, 12, 0, 0, 123456))
    assert "AS OF TIMESTAMP TIMESTAMP '2024-01-15 12:00:00.123456'" in text
    assert text.startswith("(SELECT * FROM") and "SALES.ORDERS" in text
    server = JdbcSource.sql_server(spark, "h", 1433, "d", "u", "p")
    with pytest.raises(ValueError):
        server.relation("Orders", as_of=datetime(2024, 1, 15))


def test_parallel_read_names_column_and_bounds(oracle):
    options = oracle.ranged_options('"T"', "ID", 1, 1000)
    assert options["partitionColumn"] == "ID"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1001")
    assert options["numPartitions"] == "4"
    assert oracle.ranged_options('"T"', "ID", 5, 6)["numPartitions"] == "2"
    days = oracle.ranged_options('"T"', "DAY", datetime(2024, 1, 1), datetime(2024, 2, 1, 12))
    assert days["lowerBound"] == "2024-01-01 00:00:00" and days["numPartitions"] == "4"
    assert days["upperBound"] == "2024-02-01 12:00:00"


@pytest.mark.parametrize("low,high,parts", [(1, 1500, 4), (0, 2, 7), (-10, 10, 3), (5, 5, 4)])
def test_ranges_keep_every_row_once(spark, low, high, parts):
    keys = [*range(low - 3, high + 4), None]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint")
    conditions = range_predicates("k", low, high, parts)
    found = [row.k for c in conditions for row in rows.where(c).collect()]
    assert sorted(found, key=lambda k: (k is None, k)) == sorted(keys, key=lambda k: (k is None, k))
    numbered = rows.withColumn("n", range_number(F.col("k"), low, high, parts))
    for number, condition in enumerate(conditions):
        wanted = {row.k for row in rows.where(condition).collect()}
        assert wanted == {row.k for row in numbered.where(f"n = {number}").collect()}
    assert len(range_cuts(low, high, parts)) == len(conditions) - 1 or not range_cuts(low, high, parts)


class Recorder:
    """Stands where a source stands and notes what it is asked for."""

    def __init__(self, frame):
        self.frame = frame
        self.asked = []

    def table(self, *args, **kwargs):
        self.asked.append(("table", args, kwargs))
        return self.frame

    def ranged(self, *args, **kwargs):
        self.asked.append(("ranged", args, kwargs))
        return self.frame

    def query(self, *args):
        self.asked.append(("query", args, {}))
        return self.frame


def test_every_option_of_a_spec_reaches_the_source(spark):
    source = Recorder(spark.range(3))
    moment = datetime(2024, 1, 15)
    read_spec(source, TableSpec("s", "t", schema_name="x", as_of=moment, is_full_extract=True))
    read_spec(source, TableSpec("s", "t", split_on="id", is_full_extract=True))
    read_spec(source, TableSpec("s", "t", custom_query="SELECT 1", incremental_column="c"))
    assert source.asked == [
        ("table", ("t", "x"), {"as_of": moment}),
        ("ranged", ("t", "id", None), {"inside": None}),
        ("query", ("SELECT 1", ()), {}),
    ]


def test_plain_names_stay_bare_and_others_are_quoted(oracle):
    assert oracle.relation("employees", "hr") == "hr.employees"
    assert oracle.relation("V$SESSION#1") == "V$SESSION#1"
    assert oracle.relation("2nd table") == '"2nd table"'


def test_bounds_are_asked_for_the_window(spark, oracle):
    start, end = datetime(2024, 1, 15), datetime(2024, 1, 16)
    asked = oracle.bounds_query("hr.employees", "id", ("last_modified", start, end))
    assert asked == (
        "SELECT min(id) AS low, max(id) AS high, count(*) AS n FROM hr.employees "
        "WHERE last_modified >= TIMESTAMP '2024-01-15 00:00:00.000000' "
        "AND last_modified < TIMESTAMP '2024-01-16 00:00:00.000000'"
    )
    server = JdbcSource.sql_server(spark, "h", 1433, "d", "u", "p")
    assert "last_modified >=  '2024-01-15 00:00:00.000' AND" in server.bounds_query("t", "id", ("last_modified", start, end))
    source = Recorder(spark.range(3).withColumn("at", F.lit("2024-01-15 01:00:00").cast("timestamp_ntz")))
    spec = TableSpec("s", "t", split_on="id", incremental_column="AT", extraction_date=start.date())
    assert read_spec(source, spec).count() == 3
    assert source.asked == [("ranged", ("t", "id", None), {"inside": ("AT", start, end)})]


def test_ranges_grow_with_the_table(oracle):
    assert oracle.parts_for(10) == 4 and oracle.parts_for(1_000_000_000) == 200
    assert oracle.ranged_options("t", "id", 1, 10**9, oracle.parts_for(10**9))["numPartitions"] == "200"
