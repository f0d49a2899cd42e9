import hashlib
import random

import pytest

from loadledger.llm import QUERIES
from loadledger.llm.warc import mark_revisits, read_archive, write_archive
from loadledger.work import new_dir

PAGES = "page_id long, url string, html string"
INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:id:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [
    (1, "http://a/ b", "plain é" * 30),
    (2, None, None),
    (3, "http://x", "<p>" + INNER + "</p>" * 40),
    (4, "http://x", INNER * 5),
    (5, "http://x", "WARC/1."),
    (6, "http://x", "tail WARC/1.1\r\n\r\n"),
    (7, "http://x\r\nContent-Length: 1", "plain é" * 30),
    (8, "http://x", ""),
    (9, "http://x", "\r\n\r\n" + "WARC/1.0\r\nContent-Length: 99999\r\n\r\n"),
    (10, "http://x", "plain é" * 30),
    (None, "http://x", "plain é" * 30),
    (11, "http://x", "short"),
    (12, "http://x", "short"),
    (13, "http://x", "日本" * 300_000),
    (1, "http://twice", "plain é" * 30),
]


def test_round_trip_agrees_with_sql(spark, tables, agrees):
    folder = tables(pages=(ROWS, PAGES))
    agrees("op5_warc", QUERIES["op5_warc"](spark, folder), folder)


def test_agrees_with_sql_on_given_tables(spark, sf_dir, agrees):
    agrees("op5_warc", QUERIES["op5_warc"](spark, sf_dir), sf_dir)


def test_empty_table(spark, tables):
    folder = tables(pages=([], PAGES + ", file string, id int"))
    assert QUERIES["op5_warc"](spark, folder).collect() == []


def walk(data):
    """The records of an archive, one after the other."""
    at = 0
    while at < len(data):
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        body = rest[: int(fields[b"Content-Length"])]
        yield fields, body
        at += len(head) + 4 + len(body) + 4


@pytest.mark.parametrize("split", [700, 4096, 1 << 20])
def test_hostile_payloads_over_many_splits(spark, tmp_path, split):
    random.seed(split)
    bits = ["WARC/1.", "1\r\n", "\r\n\r\n", "Content-Length: 40", INNER, "x" * 30, "ß", "WARC-Type: response", "\r\n"]
    rows = [(i, "u", "".join(random.choices(bits, k=random.randrange(30)))) for i in range(200)]
    path = new_dir(spark, "warc")
    write_archive(mark_revisits(spark.createDataFrame(rows, PAGES).coalesce(2)), path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.id: (r.payload_bytes, r.payload_digest) for r in read_archive(spark, path).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: (len(t.encode()), hashlib.sha256(t.encode()).hexdigest()) for i, _, t in rows}
    stored = spark.read.format("binaryFile").load(path).where("path like '%part-%'").collect()
    bodies = [body for row in stored for fields, body in walk(bytes(row.content))
              if fields[b"WARC-Type"] == b"response"]
    assert len(bodies) <= len(rows) and set(bodies) == {t.encode() for _, _, t in rows}


def test_a_broken_chain_ends_its_file(spark, tmp_path):
    def record(i, body, length=None):
        n = len(body) if length is None else length
        return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:id:{i}>\r\n"
                f"Content-Length: {n}\r\n\r\n{body}\r\n\r\n")

    (tmp_path / "a.warc").write_bytes((record(1, "one") + record(2, "two", 4) + record(3, "three")).encode())
    (tmp_path / "b.warc").write_bytes((record(4, "four") + record(5, "cut off here")[:-9]).encode())
    assert sorted(r.id for r in read_archive(spark, str(tmp_path)).collect()) == [1, 4]
