"""Where two versions of a table differ, by a tree of fingerprints.

Rows are dealt into buckets by a hash of their key, and a bucket's fingerprint is the number of its
rows and two sums of their hashes. Buckets whose numbers share leading bits have a fingerprint
together, up to one for the whole table. Two trees are compared from the top, going down only where
they differ; only rows of buckets that differ are then brought together by key. The leaves of a stored
run can be kept beside it, so that a later comparison need not read what is equal.

Null keys are keys like any other. A key may have several rows; they are compared as a bag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.functions.hashing import row_text
from loadledger.work import cut_lineage

#: Bits of a bucket's number, and by how many of them the comparison goes down at a time.
BITS, STEP = 16, 4


def bucket(keys: Sequence[str], bits: int = BITS) -> Column:
    """The bucket of a row: leading bits of a hash of its key. Only keys of one type match."""
    return F.shiftrightunsigned(F.xxhash64(*[F.struct(F.col(key)) for key in keys]), 64 - bits)


def _prints(hashed: Column) -> list[Column]:
    halves = [F.shiftrightunsigned(hashed, 32), hashed.bitwiseAND(F.lit(0xFFFFFFFF))]
    # Halves of 32 bits: their sums stay exact for two billion rows a bucket.
    return [F.count(F.lit(1)).alias("n"), *[F.sum(half).alias(f"sum{k}") for k, half in enumerate(halves)]]


def leaves(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The fingerprint of each bucket that has rows: ``bucket``, ``n``, ``sum0``, ``sum1``."""
    hashed = df.select(bucket(keys, bits).alias("bucket"), F.xxhash64(row_text(df.columns)).alias("_hash"))
    return hashed.groupBy("bucket").agg(*_prints(F.col("_hash")))


def unequal_buckets(one: DataFrame, other: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """The buckets in which two trees differ, given their :func:`leaves`; found from the top down."""
    names = ("n", "sum0", "sum1")
    signed = one.select("bucket", *names).unionByName(other.select("bucket", *[(-F.col(c)).alias(c) for c in names]))
    left = cut_lineage(signed)
    for depth in range(step, bits + step, step):
        node = F.shiftrightunsigned("bucket", max(0, bits - depth))
        sums = left.groupBy(node.alias("_node")).agg(*[F.sum(c).alias(f"_{c}") for c in names])
        differs = sums.where(" OR ".join(f"_{c} <> 0" for c in names)).select("_node")
        left = cut_lineage(left.join(differs, node == F.col("_node"), "left_semi"))
    return left.select("bucket").distinct()


def differing_keys(
    one: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    bits: int = BITS,
    one_leaves: DataFrame | None = None,
    other_leaves: DataFrame | None = None,
) -> DataFrame:
    """Keys whose rows are not the same in both, with ``change``: added, missing or changed.

    Columns are compared by name; both versions must have the same. ``one_leaves`` and
    ``other_leaves`` are those kept with a run, if they were.
    """
    columns = sorted(one.columns)
    if sorted(other.columns) != columns:
        raise ValueError("the versions have different columns")
    trees = [
        kept if kept is not None else leaves(df, keys, bits)
        for df, kept in ((one, one_leaves), (other, other_leaves))
    ]
    wanted = cut_lineage(unequal_buckets(*trees, bits=bits)).select(F.col("bucket").alias("_bucket"))

    def bags(df: DataFrame, side: str) -> DataFrame:
        # Rows shrink to key and hash before the join, should it be a shuffle.
        hashed = df.select(*keys, F.xxhash64(row_text(columns)).alias("_hash"), bucket(keys, bits).alias("_at"))
        rows = hashed.join(wanted, F.col("_at") == F.col("_bucket"), "left_semi")
        return rows.groupBy(*keys).agg(*[column.alias(f"{side}{k}") for k, column in enumerate(_prints(F.col("_hash")))])

    before, after = bags(one, "_a"), bags(other, "_b")
    renamed = after.select(*[F.col(key).alias(f"_key{k}") for k, key in enumerate(keys)], "_b0", "_b1", "_b2")
    same = F.lit(True)
    for k, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_key{k}"))
    both = before.join(renamed, same, "full")
    change = (
        F.when(F.col("_a0").isNull(), "added")
        .when(F.col("_b0").isNull(), "missing")
        .when((F.col("_a0") != F.col("_b0")) | (F.col("_a1") != F.col("_b1")) | (F.col("_a2") != F.col("_b2")), "changed")
    )
    named = [F.when(F.col("_a0").isNull(), F.col(f"_key{k}")).otherwise(F.col(key)).alias(key) for k, key in enumerate(keys)]
    return both.select(*named, change.alias("change")).where("change IS NOT NULL")
