"""Tables of one kind whose columns differ from month to month.

The schemas of all months are joined in a lattice: a column that a month lacks is
NULL there, numbers widen, and text is above everything that has no narrower common
type.  Every month is then read by one projection onto the joined schema, so no month
is rewritten and columns are still pruned and filters pushed where the type is
the month's own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.operators.columns import _q

_INTEGRAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
# decimal digits that hold every value of the type
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_MOST_DIGITS = 38


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if there is none.

    Whole numbers widen to the larger, with decimals to a decimal of enough digits
    (a double beyond 38), with floating numbers to a double.  A date becomes a
    timestamp beside one.  Structs are joined by field, arrays by element, maps by
    key and value.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if a in _INTEGRAL and b in _INTEGRAL:
        return max(a, b, key=_INTEGRAL.index)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, T.FractionalType) and not isinstance(a, T.DecimalType) or isinstance(b, T.FractionalType) and not isinstance(b, T.DecimalType):
            return T.DoubleType()
        (whole_a, scale_a), (whole_b, scale_b) = _places(a), _places(b)
        scale, whole = max(scale_a, scale_b), max(whole_a, whole_b)
        return T.DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return joined_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    times = {type(a), type(b)}
    if T.DateType in times and times & {T.TimestampType, T.TimestampNTZType}:
        return a if isinstance(b, T.DateType) else b
    return T.StringType()


def _places(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0)


def joined_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of all schemas, in order of first appearance, each with its common type.

    Names that differ in case only are one column, by its first spelling.
    """
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        seen = set()
        for field in schema.fields:
            key = field.name.lower()
            if key in seen:
                raise ValueError(f"column {field.name} stands twice in one schema")
            seen.add(key)
            names.setdefault(key, field.name)
            types[key] = common_type(types[key], field.dataType) if key in types else field.dataType
    return T.StructType([T.StructField(names[k], types[k]) for k in names])


def _as_type(c: Column, found: T.DataType, wanted: T.DataType) -> Column:
    if found == wanted:
        return c
    if isinstance(wanted, T.StringType) and isinstance(found, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(wanted, T.StructType) and isinstance(found, T.StructType):
        held = {f.name.lower(): f for f in found.fields}
        fields = [(_as_type(c.getField(held[w.name.lower()].name), held[w.name.lower()].dataType, w.dataType)
                   if w.name.lower() in held else F.lit(None).cast(w.dataType)).alias(w.name) for w in wanted.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(wanted, T.ArrayType) and isinstance(found, T.ArrayType):
        return F.transform(c, lambda x: _as_type(x, found.elementType, wanted.elementType))
    return c.cast(wanted)


def conform(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """``df`` with the columns and types of a schema that joined its own: one projection, missing columns NULL."""
    held = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[(_as_type(F.col(_q(held[w.name.lower()].name)), held[w.name.lower()].dataType, w.dataType)
                        if w.name.lower() in held else F.lit(None).cast(w.dataType)).alias(w.name) for w in wanted.fields])


def conform_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables by label, all with the schema that joins theirs."""
    wanted = joined_schema(t.schema for t in tables.values())
    return {label: conform(t, wanted) for label, t in tables.items()}


def schema_drift(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``column, label, found_type, joined_type``: a row per column and table; ``found_type`` NULL where it is missing.

    From the schemas alone: no table is read.
    """
    if not tables:
        raise ValueError("no tables")
    wanted = joined_schema(t.schema for t in tables.values())
    rows = []
    for label, t in tables.items():
        held = {f.name.lower(): f.dataType.simpleString() for f in t.schema.fields}
        rows += [(w.name, label, held.get(w.name.lower()), w.dataType.simpleString()) for w in wanted.fields]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "column string, label string, found_type string, joined_type string")
