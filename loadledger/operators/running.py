"""Values that run along a key that may be far larger than one task can hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadledger.work import cut_lineage


def _last(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


#: How a value runs along: over rows, and what it becomes after what earlier slices came to.
KINDS = {
    "sum": (F.sum, lambda now, before: now + F.coalesce(before, F.lit(0))),
    "max": (F.max, lambda now, before: F.greatest(now, before)),
    "last": (_last, lambda now, before: F.coalesce(now, before)),
}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    kinds: Mapping[str, str],
    slices: int | None = None,
    before: bool = False,
) -> DataFrame:
    """``df`` with each column of ``kinds`` replaced by its sum, maximum or last known value over the
    rows of the key up to this one, in ``order``; with ``before``, over the rows before this one.

    A plain window would send a whole key to one task. Here the rows are range-partitioned by key
    and order, so a hot key spreads over many slices of even size. Values run along inside their
    slice and are then joined with what the same key came to in earlier slices. The slices are written
    out first: their borders come from a sample, and a recomputed task must not see others.

    Only a key that crosses a slice border needs that, and a slice has one such key at each end.
    So the broadcast side has at most two rows per slice, whatever the size of the data. Unless
    ``slices`` says how many there are, they are shuffle partitions like any others: as many as the
    session sets, small ones merged.
    """
    dealt = df.repartitionByRange(*([slices] if slices else []), *keys, *order)
    cut = cut_lineage(dealt.withColumn("_slice", F.spark_partition_id()))
    sizes = cut.groupBy(*keys, "_slice").agg(*_totals(kinds, order))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        sizes.withColumn("_later", F.count(F.lit(1)).over(earlier) > 0)
        .withColumns({f"_before_{name}": KINDS[kind][0](F.col(f"_all_{name}")).over(earlier) for name, kind in kinds.items()})
        .where("_later")
        .select(
            *[F.col(key).alias(f"_of_{key}") for key in keys],
            F.col("_slice").alias("_of_slice"),
            *[f"_before_{name}" for name in kinds],
        )
    )
    same_slice = F.col("_slice") == F.col("_of_slice")
    for key in keys:
        same_slice = same_slice & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    values = {name: KINDS[kind][0](F.col(name)).over(inside).alias(name) for name, kind in kinds.items()}
    moved = {}
    for name, kind in kinds.items():
        now = F.coalesce(F.col(name), F.lit(0)) if kind == "sum" else F.col(name)
        moved[name] = KINDS[kind][1](now, F.col(f"_before_{name}")).alias(name)
    return (
        cut.select(*[values.get(name, F.col(name)) for name in df.columns], "_slice")
        .join(F.broadcast(shifts), same_slice, "left")
        .select(*[moved.get(name, F.col(name)) for name in df.columns])
    )


def _totals(kinds: Mapping[str, str], order: Sequence[str]) -> list[Column]:
    """What each column comes to over all of a slice's rows of a key."""
    place = F.struct(*order)
    newest = {
        name: F.max_by(name, F.when(F.col(name).isNotNull(), place)) for name, kind in kinds.items() if kind == "last"
    }
    return [newest.get(name, KINDS[kind][0](F.col(name))).alias(f"_all_{name}") for name, kind in kinds.items()]


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], summed: Sequence[str], slices: int | None = None
) -> DataFrame:
    """``df`` with each of ``summed`` replaced by its sum over the rows of the key up to this one."""
    return running(df, keys, order, dict.fromkeys(summed, "sum"), slices)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """Add ``name``: 1, 2, 3, … within each key, in ``order``."""
    ones = df.withColumn(name, F.lit(1).cast("long"))
    return running_sums(ones, keys, order, [name], slices)
