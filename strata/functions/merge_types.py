"""The least common type of drifting schemas, planned from metadata before any row is read.

A merge keeps every value: a column takes the narrowest type that holds all values of all
its versions, and text where there is none. Whole numbers widen (byte → short → int → long →
decimal); decimals widen in both their parts; a whole number or decimal meets float or
double in double only if each of its values is one exactly, else in text. Structs merge by
field, arrays and maps by element.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col
from strata.functions.contracts import SchemaMismatchError

#: Digits of the widest value of each whole-number type, narrowest first.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Digits that float and double keep of every whole number.
EXACT_DIGITS = {T.FloatType: 7, T.DoubleType: 15}
MOMENTS = (T.DateType, T.TimestampNTZType, T.TimestampType)
NESTED = (T.StructType, T.ArrayType, T.MapType)


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """(digits before, digits after the point) of an exact number type."""
    if type(t) in WHOLE:
        return WHOLE[type(t)], 0
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both; text if nothing narrower does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType),
                           a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType),
                         a.valueContainsNull or b.valueContainsNull)
    x, y = _digits(a), _digits(b)
    if x and y:
        if type(a) in WHOLE and type(b) in WHOLE:
            return a if x >= y else b
        before, after = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(before + after, after) if before + after <= 38 else T.StringType()
    if type(a) in EXACT_DIGITS and type(b) in EXACT_DIGITS:
        return T.DoubleType()
    for exact, inexact in ((x, b), (y, a)):
        if exact and type(inexact) in EXACT_DIGITS:
            # a fraction such as 0.1 is no double, so only whole numbers widen this way
            fits = exact[1] == 0 and exact[0] <= EXACT_DIGITS[T.DoubleType]
            return T.DoubleType() if fits else T.StringType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Fields in the order they are first seen, each of its common type.

    A field is nullable if any version is or lacks it. Names that differ in case only are an
    error, as Spark would not tell them apart.
    """
    schemas = list(schemas)
    types: dict[str, T.DataType] = {}
    seen: dict[str, list[bool]] = {}
    for schema in schemas:
        for f in schema.fields:
            types[f.name] = common_type(types[f.name], f.dataType) if f.name in types else f.dataType
            seen.setdefault(f.name, []).append(f.nullable)
    folded: dict[str, str] = {}
    for name in types:
        if folded.setdefault(name.lower(), name) != name:
            raise SchemaMismatchError(f"fields {folded[name.lower()]!r} and {name!r} differ in "
                                      "case only")
    return T.StructType([T.StructField(n, t, any(seen[n]) or len(seen[n]) < len(schemas))
                         for n, t in types.items()])


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in its common type; nested values that meet in text become their JSON."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(widened(value.getField(f.name), own[f.name], f.dataType) if f.name in own
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(value), lambda e: F.struct(
            widened(e["key"], have.keyType, want.keyType).alias("key"),
            widened(e["value"], have.valueType, want.valueType).alias("value"))))
    if isinstance(have, NESTED) and isinstance(want, T.StringType):
        if isinstance(have, T.StructType):
            return F.when(value.isNotNull(), F.to_json(value))
        return F.to_json(value)
    return value.cast(want)


def widen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in a common schema: one projection, absent fields null."""
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (widened(col(f.name), own[f.name], f.dataType)
         if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def widen_all(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """The frames in their common schema, ready for a union by position or name."""
    schema = common_schema(f.schema for f in frames)
    return [widen(f, schema) for f in frames]
