"""WARC archives, written and read by Spark's own text source, with verified record boundaries.

A payload may itself hold what looks like the start of a record, even a whole record. So a reader
must not trust the magic word. Tasks read splits of an archive cut at every magic word and emit, for
each piece with a readable header, a candidate record and the offset of its successor, which its
Content-Length gives. Runs of pieces that lead straight to one another shrink to one pointer; jumps
of doubling length over those pointers, from the start of each file, mark what can be reached. Only
reached records are real; pieces in between are given back to the payload they were cut out of.

Writing and reading use DataFrame operations only, so archives can lie in any store Spark knows.

Defined results: a null payload is empty; a null id stays null; rows that repeat the smallest id of
equal payloads are all responses; control characters and spaces of a URL become ``%20``. A record
that its file ends within is left out, and so is what follows a broken chain. An empty table gives
an empty archive and no records. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadledger.llm.registry import load, query
from loadledger.work import cut_lineage, new_dir

MAGIC = "WARC/1."
CRLF = "\r\n"
END = CRLF + CRLF
#: Payloads of fewer bytes are always stored, as a reference to them would be longer.
LEAST_SHARED = 100


def mark_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Id, URL, payload, its size and digest, and for repeated payloads the smallest id that has it.

    The payloads are read twice and moved only if the repeated digests are too many to broadcast,
    which Spark decides by the size of the table they were written to.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = cut_lineage(
        rows.where(F.col("size") >= LEAST_SHARED)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _first IS NOT NULL")
        .drop("_n")
    )
    repeats = (F.col("digest") == F.col("_digest")) & ~F.col("id").eqNullSafe(F.col("_first"))
    return rows.join(shared, repeats, "left").drop("_digest").withColumnRenamed("_first", "refers_to")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archive(marked: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row, one archive per task. A revisit has the digest and size, but no payload."""
    revisit = F.col("refers_to").isNotNull()
    stored = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC + "1" + CRLF),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _urn("id")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Refers-To", _urn("refers_to")),
        _field("X-Payload-Length", F.col("size").cast("string")),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.octet_length(stored).cast("string")),
        F.lit(CRLF),
        stored,
    )
    marked.select(record.alias("value")).write.option("lineSep", END).text(path)


def _urn(name: str) -> Column:
    return F.concat(F.lit("<urn:id:"), F.url_encode(F.col(name).cast("string")), F.lit(">"))


def _header(name: str, pattern: str) -> Column:
    """A header field of a piece, or null."""
    found = F.regexp_extract(F.col("header"), rf"(?i)\r\n{name}:[ \t]*{pattern}[ \t]*(?=\r\n|$)", 1)
    return F.when(found != "", found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magic words, with its file, its split and its place in the split."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            "value",
        )
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece of the archives: its offset, its successor's if it has a header, and its fields."""
    header = F.substring_index("value", END, 1)
    parsed = _pieces(spark, path).withColumn("header", header).select(
        "file",
        "block",
        "place",
        F.octet_length("value").cast("long").alias("octets"),
        (F.octet_length("header") + 4).cast("long").alias("body"),
        F.when(
            F.col("value").rlike(r"\A[01]\r\n") & F.contains("value", F.lit(END)),
            _header("Content-Length", r"(\d{1,18})").cast("long"),
        ).alias("length"),
        _header("WARC-Type", r"(\w+)").alias("type"),
        _header("WARC-Record-ID", r"<urn:id:([^>\r\n]*)>").alias("id"),
        _header("WARC-Refers-To", r"<urn:id:([^>\r\n]*)>").alias("refers_to"),
        _header("WARC-Payload-Digest", r"sha256:([0-9a-f]{64})").alias("declared"),
        _header("X-Payload-Length", r"(\d{1,18})").cast("long").alias("declared_size"),
        "value",
    )
    whole = F.col("octets") == F.col("body") + F.col("length") + 4
    payload = F.substring(F.col("value").cast("binary"), (F.col("body") + 1).cast("int"), F.col("length").cast("int"))
    # Written once: the order of rows within a split is that of this scan.
    stored = cut_lineage(
        parsed.withColumn("digest", F.when(whole, F.sha2(payload, 256))).drop("value").withColumn("whole", whole)
    )
    order = Window.partitionBy("file").orderBy("block", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(F.col("octets") + len(MAGIC)).over(before), F.lit(0))
    # A piece starts a new segment unless the one before leads straight to it.
    broken = F.coalesce(F.lag("whole").over(order), F.lit(False)) == F.lit(False)
    return (
        stored.withColumn("whole", F.coalesce("whole", F.lit(False)))
        .withColumn("offset", here - len(MAGIC))
        .withColumn("next", F.col("offset") + len(MAGIC) + F.col("body") + F.col("length") + 4)
        .withColumn("_new", broken.cast("long"))
        .withColumn("segment", F.sum("_new").over(order))
        .withColumn("rank", F.row_number().over(Window.partitionBy("file", "block").orderBy("place")))
        .drop("_new", "place")
    )


def reachable(found: DataFrame) -> DataFrame:
    """File, segment and offset at which a chain of records from the start of the file enters it."""
    heads = found.where("length IS NOT NULL")
    start = heads.where("offset = 0").select("file", "segment", F.col("offset").alias("entry"))
    last = found.groupBy("file", "segment").agg(F.max_by("next", "offset").alias("target"))
    jumps = cut_lineage(
        last.join(
            heads.select("file", F.col("offset").alias("target"), F.col("segment").alias("to")), ["file", "target"]
        ).select("file", "segment", "to", F.col("target").alias("entry"))
    )
    reached = start
    while not jumps.isEmpty():
        step = reached.drop("entry").join(jumps, ["file", "segment"]).select(
            "file", F.col("to").alias("segment"), "entry"
        )
        reached = cut_lineage(reached.unionByName(step))
        then = jumps.select("file", F.col("segment").alias("to"), F.col("to").alias("further"), F.col("entry").alias("at"))
        jumps = cut_lineage(
            jumps.drop("entry").join(then, ["file", "to"]).select(
                "file", "segment", F.col("further").alias("to"), F.col("at").alias("entry")
            )
        )
    return reached


def read_archive(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The records of all archives under ``path``: id, payload size and digest, type, referred id."""
    found = cut_lineage(candidates(spark, path))
    entries = reachable(found)
    marked = cut_lineage(
        found.join(entries, ["file", "segment"], "left").withColumn(
            "real", F.coalesce((F.col("offset") >= F.col("entry")) & F.col("length").isNotNull(), F.lit(False))
        )
    )
    records = marked.where("real AND whole")
    if not marked.where("real AND NOT whole").isEmpty():
        records = records.unionByName(_mend(spark, path, marked), allowMissingColumns=True)
    revisit = F.col("type") == "revisit"

    def back(name: str) -> Column:
        return F.url_decode(F.col(name)).cast(id_type)

    return records.select(
        back("id").alias("id"),
        F.when(revisit, F.col("declared_size")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        back("refers_to").alias("refers_to"),
    )


def _mend(spark: SparkSession, path: str, marked: DataFrame) -> DataFrame:
    """Real records whose payload holds magic words: their pieces are read again and joined."""
    order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    cut = F.when(F.col("real"), F.struct("offset", "whole", "next"))
    owned = (
        marked.withColumn("owner", F.last(cut, ignorenulls=True).over(order))
        .where("NOT owner.whole AND offset < owner.next")
        .select("file", "block", "rank", "offset", F.col("owner.offset").alias("at"), F.col("owner.next").alias("until"))
    )
    owned = cut_lineage(owned)
    rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("place"))
    again = (
        _pieces(spark, path)
        .join(owned.select("file").distinct(), "file", "left_semi")
        .withColumn("rank", rank)
        .join(owned, ["file", "block", "rank"])
    )
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))), lambda part: part["value"])
    joined = again.groupBy("file", "at", "until").agg(F.array_join(parts, MAGIC).alias("text"))
    whole = joined.where(F.octet_length("text") + len(MAGIC) == F.col("until") - F.col("at"))
    fields = marked.where("real AND NOT whole").drop("digest").withColumnRenamed("offset", "at")
    payload = F.substring(F.col("text").cast("binary"), (F.col("body") + 1).cast("int"), F.col("length").cast("int"))
    return fields.join(whole, ["file", "at"]).select(
        F.col("at").alias("offset"), *[c for c in fields.columns if c != "at"], F.sha2(payload, 256).alias("digest")
    )


@query(
    sql="""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p),
r AS (SELECT *, n >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM f)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM r
"""
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "warc")
    pages = load(spark, sf_dir, "pages", "page_id", "url", "html")
    write_archive(mark_revisits(pages), path)
    kind = pages.schema["page_id"].dataType.simpleString()
    return read_archive(spark, path, kind).withColumnRenamed("id", "page_id")
