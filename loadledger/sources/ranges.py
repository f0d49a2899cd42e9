"""Ranges of an integer key, the unit of a parallel read: of even width, or of even numbers of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the quantile sketch: ranks are off by about a third of a percent.
SKETCH_SIZE = 400


def range_predicates(column: str, low: int, high: int, parts: int) -> list[str]:
    """One SQL condition per range. Together they keep every row once, NULL and outliers included.

    They fit ``spark.read.jdbc(..., predicates=...)`` and ``DataFrame.where`` alike.
    """
    return predicates_at(column, range_cuts(low, high, parts))


def predicates_at(column: str, cuts: list[int]) -> list[str]:
    """The same for given inner borders, in order."""
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"{column} >= {cuts[-1]}"]


def range_cuts(low: int, high: int, parts: int) -> list[int]:
    """Inner borders of ``parts`` even ranges over ``low..high``; fewer when there are fewer values."""
    width = high - low + 1
    parts = max(1, min(parts, width))
    return [low + (width * i + parts - 1) // parts for i in range(1, parts)]


def range_number(column: Column, low: int, high: int, parts: int) -> Column:
    """The range a value belongs to, from 0, with the outer ranges open and NULL in the first."""
    width = high - low + 1
    parts = max(1, min(parts, width))
    inside = F.greatest(F.lit(low), F.least(F.lit(high), column))
    number = F.call_function("div", (inside - low).cast("bigint") * parts, F.lit(width))
    return F.when(column.isNull(), 0).otherwise(number).cast("int")


def even_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """Inner borders of about ``parts`` ranges with equal numbers of rows, whatever the values are.

    They are quantiles of a mergeable sketch: one pass over the column, a few kilobytes a task. A value
    that takes up a whole range or more shows as several equal quantiles, and gets a range for itself,
    so that what lies beside it stays even.
    """
    ranks = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    if parts < 2:
        return []
    sketch = F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), F.lit(SKETCH_SIZE))
    found = df.where(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch"))
    row = found.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", ranks)).alias("cuts")).first()
    quantiles = row.cuts or []
    atoms = {a for a, b in zip(quantiles, quantiles[1:]) if a == b}
    return sorted({*quantiles, *(atom + 1 for atom in atoms)})
