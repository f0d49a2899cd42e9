"""Taking single rows out of a table whose ids may be null or repeated.

A row is named by its id and a digest of its text, so that what becomes of one row does not befall
others under its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger.work import cut_lineage


def digest(text: Column) -> Column:
    """256 bits of a text, in hexadecimal; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, T.StructType):
        return all(orderable(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return isinstance(kind, (T.AtomicType, T.NullType)) and not isinstance(kind, T.VariantType)


def without_rows(docs: DataFrame, id_col: str, text_digest: Column, fates: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``fates`` names, and with one of each that it names ``again``.

    ``fates`` has one row per ``id`` and ``digest``; those that are to stay as they are need none. Of
    rows named again, the smallest by all columns that have an order stays.
    """
    named = cut_lineage(fates.select(F.col("id").alias("_fate_id"), F.col("digest").alias("_fate_digest"), "again"))
    same = docs[id_col].eqNullSafe(F.col("_fate_id")) & (text_digest == F.col("_fate_digest"))
    # The same join at every size: below the broadcast threshold Spark would otherwise take another.
    rest = docs.join(named.drop("again").hint("merge"), same, "left_anti")
    again = named.where("again").drop("again")
    if again.isEmpty():
        return rest
    row = F.struct(*[docs[c] for c in docs.columns])
    order = F.struct(*[docs[f.name] for f in docs.schema if orderable(f.dataType)])
    one = docs.join(again, same).groupBy("_fate_id", "_fate_digest").agg(F.min_by(row, order).alias("_row"))
    return rest.unionByName(one.select("_row.*"))
