"""The least type that holds the values of several, and rows brought to it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 20)))
_BROKEN = (T.FloatType, T.DoubleType)
_MOMENTS = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The least type both can be cast to without a loss of digits; text where there is no other.

    Whole numbers widen, and with fractions become decimal or double. Dates widen to timestamps.
    Structs have the fields of both, whatever the case of their letters; lists and maps go by what is
    in them.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = (type(one), type(other))
    if all(kind in _WHOLE for kind in kinds):
        return max(one, other, key=lambda t: _WHOLE.index(type(t)))
    if all(kind in (*_WHOLE, T.DecimalType) for kind in kinds):
        return _decimal(one, other)
    if all(kind in (*_WHOLE, *_BROKEN, T.DecimalType) for kind in kinds):
        return T.DoubleType()
    if all(kind in _MOMENTS for kind in kinds):
        return max(one, other, key=lambda t: _MOMENTS.index(type(t)))
    if kinds == (T.StructType, T.StructType):
        return common_schema([one, other])
    if kinds == (T.ArrayType, T.ArrayType):
        return T.ArrayType(common_type(one.elementType, other.elementType))
    if kinds == (T.MapType, T.MapType):
        return T.MapType(common_type(one.keyType, other.keyType), common_type(one.valueType, other.valueType))
    return T.StringType()


def _decimal(one: T.DataType, other: T.DataType) -> T.DataType:
    sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (one, other)]
    whole, scale = (max(size) for size in zip(*sizes))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All fields of several schemas in the order they came up, with common types.

    Names that differ in case only are one field, which is spelt as it was last.
    """
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.get(field.name.lower())
            kind = common_type(known.dataType, field.dataType) if known else field.dataType
            fields[field.name.lower()] = T.StructField(field.name, kind, True)
    return T.StructType(list(fields.values()))


def as_type(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """A value of one type as a value of a common type that it went into."""
    if kind == wanted:
        return value
    if isinstance(wanted, T.StructType) and isinstance(kind, T.StructType):
        known = {field.name.lower(): field for field in kind}
        made = [
            as_type(value[known[f.name.lower()].name], known[f.name.lower()].dataType, f.dataType)
            if f.name.lower() in known
            else F.lit(None).cast(f.dataType)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*[column.alias(f.name) for column, f in zip(made, wanted)]))
    if isinstance(wanted, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: as_type(x, kind.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(kind, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: as_type(k, kind.keyType, wanted.keyType))
        return F.transform_values(keyed, lambda _, v: as_type(v, kind.valueType, wanted.valueType))
    if isinstance(wanted, T.StringType) and isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(wanted)


def conforming(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of a common schema, from a frame that has some of them; the others are NULL."""
    known = {field.name.lower(): field for field in df.schema}
    return [
        (
            as_type(df[known[f.name.lower()].name], known[f.name.lower()].dataType, f.dataType)
            if f.name.lower() in known
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in schema
    ]


def read_versions(spark: SparkSession, stored: Sequence[tuple[T.StructType, Sequence[str]]]) -> DataFrame:
    """Parquet folders of several schemas as one frame: a scan for each schema, oldest first.

    Each scan reads the types that are in its files; only then values are cast.
    """
    wanted = common_schema([schema for schema, _ in stored])
    scans = [spark.read.schema(schema).parquet(*folders) for schema, folders in stored]
    return reduce(DataFrame.unionByName, [scan.select(*conforming(scan, wanted)) for scan in scans])
