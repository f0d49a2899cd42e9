"""Exact deduplication: 128-bit content hashes, and a comparison of bytes inside each group.

A group of equal hashes is a claim, not a proof. Every member's text is therefore compared with the
text of the member of the smallest id; members that differ go into a group of their own, and so on
until none is left over. Only the texts of groups with several members are gathered for it.

Defined results: a null text counts as empty, and empty texts equal each other. A null id is the
smallest id of a group only where the group has no other. In ``exact_groups`` rows that repeat the
smallest id of their group with an equal text are all ``kept``, as nothing tells them apart, and each
input row gives one output row; ``exact_dedup`` leaves one of them. An empty table gives none. Columns other than the two named are not read, so their names may clash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.registry import load, query
from loadledger.llm.rows import digest, orderable
from loadledger.work import cut_lineage

# White space other than a lone space, which its replacement would equal.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the content, as bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Grouping is a partial aggregate, so a group of any size costs each task one row. The joins that
    bring a group's first text to its members are followed by no operator on the same key, so that
    adaptive execution can split a hot group over tasks.
    """
    texts = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    rows = cut_lineage(
        texts.select("_id", hashed(F.col("_text")).alias("_hash"), F.sha2("_text", 256).alias("_sha"))
    )
    members = rows
    rounds = []
    while True:
        checked = _compare(texts, members)
        agreed = checked.where("_equal")
        sizes = cut_lineage(agreed.groupBy("_hash", "_first").agg(F.count(F.lit(1)).alias("_size")))
        rounds.append(agreed.distinct().join(sizes, ["_hash", "_first"]))
        members = checked.where("NOT _equal").select("_id", "_hash", "_sha")
        if members.isEmpty():
            break
    classes = reduce(DataFrame.unionByName, rounds).select(
        F.col("_id").alias("_of"), F.col("_sha").alias("_in"), F.col("_first._id").alias("_keep"), "_size"
    )
    known = F.col("_size").isNotNull()
    return (
        rows.join(classes, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_sha") == F.col("_in")), "left")
        .withColumn("keep_id", F.when(known, F.col("_keep")).otherwise(F.col("_id")))
        .select(
            F.col("_id").alias(id_col),
            "keep_id",
            F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
            F.col("keep_id").eqNullSafe(F.col("_id")).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def _compare(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Members of groups of several rows, with their group's first member and whether texts equal its."""
    # A null id sorts last: the first field says whether there is none.
    me = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_sha")
    groups = cut_lineage(
        members.groupBy("_hash").agg(F.min(me).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    )
    claims = cut_lineage(
        members.distinct()
        .join(groups, "_hash")
        .select(F.col("_id").alias("_member"), F.col("_sha").alias("_member_sha"), "_hash", "_first")
    )
    # Digests are worked out again only for rows whose id belongs to a claim.
    gathered = cut_lineage(
        texts.join(claims, F.col("_id").eqNullSafe(F.col("_member")))
        .where(F.sha2("_text", 256) == F.col("_member_sha"))
        .select("_id", F.col("_member_sha").alias("_sha"), "_hash", "_first", "_text")
    )
    firsts = cut_lineage(
        gathered.where(me == F.col("_first"))
        .select("_hash", F.col("_text").alias("_first_text"))
        .dropDuplicates(["_hash"])
    )
    equal = F.col("_text").cast("binary") == F.col("_first_text").cast("binary")
    return cut_lineage(
        gathered.join(firsts, "_hash").select("_id", "_hash", "_sha", "_first", equal.alias("_equal"))
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """``docs`` with one row of each text, that of the smallest id; other rows under its id stay.

    One aggregate on hash and text: rows meet by hash, and grouping compares bytes. Tasks fold their
    own copies before the shuffle, and a row moves once, its text only as the key unless the two differ.
    Of rows that repeat id and text the smallest by all columns that have an order stays.
    """
    raw = docs[text_col]
    text = normalised(raw)
    order = F.struct(
        docs[id_col].isNull(), docs[id_col], digest(raw), *[docs[f.name] for f in docs.schema if f.name != text_col and orderable(f.dataType)]
    )
    names = {name: f"c{place}" for place, name in enumerate(docs.columns)}
    others = [docs[name].alias(to) for name, to in names.items() if name != text_col]
    same = raw.eqNullSafe(text)
    row = F.struct(*others, same.alias("same"), F.when(~same, raw).alias("raw"))
    kept = docs.groupBy(hashed(text).alias("hash"), text.alias("text")).agg(F.min_by(row, order).alias("row"))
    back = F.when(F.col("row.same"), F.col("text")).otherwise(F.col("row.raw"))
    return kept.select(
        *[(back if name == text_col else F.col(f"row.{to}")).alias(name) for name, to in names.items()]
    )


@query(
    sql=r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(load(spark, sf_dir, "documents", "doc_id", "text"))
