"""Content hashes of rows and order-free fingerprints of whole datasets."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _named(name: str) -> Column:
    """A column by its name as it is, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_text(names: Sequence[str]) -> Column:
    """One unambiguous text per row: columns in name order, each value with its length.

    The length keeps ``("a;b", "c")`` apart from ``("a", "b;c")``, and ``~`` keeps NULL apart from
    the empty string. Use key, text, integer and date columns when another engine has to agree;
    engines print doubles differently.
    """

    def field(name: str) -> Column:
        value = _named(name).cast("string")
        shown = F.concat(F.lit(f"{name}="), F.length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(shown, F.lit(f"{name}=~"))

    return F.concat_ws(";", *[field(name) for name in sorted(names)])


def row_hash(names: Sequence[str]) -> Column:
    return F.md5(row_text(names))


def fingerprint(names: Sequence[str]) -> Column:
    """Aggregate: the sums of both 64-bit halves of every row's MD5, as text. Order does not matter.

    It is combined map-side, so only a few numbers per group and task are shuffled.
    """
    hashed = row_hash(names)
    halves = [_half(F.substring(hashed, start, 16)) for start in (1, 17)]
    return F.concat_ws(":", *[wide_sum(half).cast("string") for half in halves])


def _half(digits: Column) -> Column:
    """Sixteen hexadecimal digits as the bits of a long."""
    high = F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(digits, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def wide_sum(bits: Column) -> Column:
    """Aggregate: the sum of 64-bit patterns read as unsigned numbers, 0 for no rows.

    Each pattern is cut into pieces of 21 or 22 bits and the pieces are added up as longs, which
    costs less than a decimal sum and holds for 2 trillion rows.
    """
    piece = 2**21 - 1
    sums = (
        (F.shiftrightunsigned(bits, 42), 2**42),
        (F.shiftrightunsigned(bits, 21).bitwiseAND(piece), 2**21),
        (bits.bitwiseAND(piece), 1),
    )
    total = F.lit(0).cast("decimal(38,0)")
    for part, worth in sums:
        scaled = F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * F.lit(worth)
        total = (total + scaled).cast("decimal(38,0)")
    return total


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def _hashable(value: Column, kind: T.DataType) -> Column:
    """A value Spark can hash: maps at any depth become lists of their entries, by key."""
    if not _has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        keys = F.array_sort(F.map_keys(value))
        entry = lambda key: F.struct(key.alias("k"), _hashable(F.element_at(value, key), kind.valueType).alias("v"))
        return F.transform(keys, entry)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _hashable(item, kind.elementType))
    fields = [_hashable(value.getField(f.name), f.dataType).alias(f"f{n}") for n, f in enumerate(kind)]
    return F.when(value.isNotNull(), F.struct(*fields))


def hash_sum(schema: T.StructType) -> Column:
    """Aggregate: the sum of Spark's 64-bit row hashes, over all columns in the order of their names."""
    fields = sorted(schema, key=lambda field: field.name)
    # A row without columns is hashed as one constant, so that rows still count.
    return wide_sum(F.xxhash64(*[_hashable(_named(f.name), f.dataType) for f in fields] or [F.lit(0)]))


def quick_fingerprint(schema: T.StructType) -> Column:
    """Like :func:`fingerprint`, for checks that stay inside Spark."""
    return hash_sum(schema).cast("string")


def schema_hash(schema: T.StructType) -> str:
    """One text per set of column names and types, whatever the order of the columns."""
    fields = sorted(f"{field.name}:{field.dataType.simpleString()}" for field in schema)
    return hashlib.md5(";".join(fields).encode()).hexdigest()
