"""Near-duplicates by SimHash, found with a covering family of bit masks.

For radius r, each of the 64 bits gets a non-zero vector of r + 1 bits, and each non-zero vector v
gives a mask of the bits whose vectors have an odd product with v. Any r bits span at most r
dimensions, so some v is orthogonal to all of them: two fingerprints that differ in r bits or fewer
agree under at least one of the 2^(r+1) - 1 masks. No pair within the radius is missed.

A bucket of a mask is never paired out. Fingerprints that share a bucket emit the words reached by
flipping one of the bits the mask leaves open, and the word itself: two of them are within two bits
of each other just if they meet at such a word. At most 65 fingerprints can meet at one word, so
work is linear in the size of a bucket, however large. Components are worked out on fingerprints,
and documents with equal fingerprints appear in it as one node.

Defined results: null or blank text has fingerprint zero and links like any other. A null id is
never the smallest unless its component has no other. Repeated rows each give a row. An empty table
gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.graph import components
from loadledger.llm.registry import bound_batches, load, query
from loadledger.work import cut_lineage

SHINGLE = 3
#: The link distance. Meeting words bridge two flips, so this is not a parameter.
RADIUS = 2
# Fixed value: the seed of the shingle hash.
SEED = 42
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of a text's shingle hashes, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1)[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), _SLICE):
        part = zip(starts[at : at + _SLICE], ends[at : at + _SLICE])
        hashes = np.array([digest(line[a:b], SEED) for a, b in part], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(ends), bitorder="little")
    return int(majority.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fingerprint``, as a signed long, of every document."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            columns = [batch.column(0), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "fingerprint"])

    return rows.mapInArrow(work, f"id {kind}, fingerprint long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks as unsigned numbers; every bit is open in some and closed in others."""
    vectors = [1 + bit % (2 ** (radius + 1) - 1) for bit in range(64)]
    return [
        sum(1 << bit for bit, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


def _signed(number: int) -> Column:
    return F.lit(number - (1 << 64) if number >= 1 << 63 else number).cast("long")


def links(prints: DataFrame) -> DataFrame:
    """Edges among distinct ``fingerprint`` values that connect all those within the radius."""
    masks = covering_masks()
    tables = F.array(
        *[
            F.struct(
                F.lit(place).alias("mask"),
                F.col("fingerprint").bitwiseAND(_signed(mask)).alias("bucket"),
                _signed(mask ^ (2**64 - 1)).alias("open"),
            )
            for place, mask in enumerate(masks)
        ]
    )
    hashed = prints.select("fingerprint", F.inline(tables))
    shared = cut_lineage(
        hashed.groupBy("mask", "bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    members = hashed.join(shared, ["mask", "bucket"]).groupBy("fingerprint").agg(F.bit_or("open").alias("open"))
    bits = F.array(*[_signed(1 << bit) for bit in range(64)])
    flips = F.filter(bits, lambda bit: F.col("open").bitwiseAND(bit) != 0)
    words = F.concat(F.array("fingerprint"), F.transform(flips, lambda bit: F.col("fingerprint").bitwiseXOR(bit)))
    meets = cut_lineage(members).select("fingerprint", F.explode(words).alias("word"))
    least = F.min("fingerprint").alias("root")
    centres = meets.groupBy("word").agg(least, F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return meets.join(centres, "word").where("fingerprint <> root").select("fingerprint", "root").distinct()


def _rooted(rows: DataFrame) -> DataFrame:
    """Of every distinct fingerprint its component, as ``root``, and the smallest id it has, as ``first``."""
    prints = cut_lineage(rows.groupBy("fingerprint").agg(F.min("id").alias("first")))
    roots = components(links(prints)).select(F.col("node").alias("fingerprint"), "root")
    rooted = prints.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    return cut_lineage(rooted)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``fingerprint`` in hexadecimal and ``component_id``."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col))
    rooted = _rooted(rows)
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    known = cut_lineage(rooted.join(firsts, "root").select("fingerprint", "component_id"))
    return rows.join(known, "fingerprint").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query()
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(load(spark, sf_dir, "documents", "doc_id", "text"))
