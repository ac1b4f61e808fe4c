"""Record contracts: explicit schemas, conforming projections and schema checks.

A contract is a ``StructType``. ``conform`` turns any DataFrame into exactly that
shape with one ``select`` (cast present fields, null-fill missing ones, drop
extras), so nothing is ever inferred and the work stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source record fields, in the order of the Bronze contract.
# Every field is text; only `name` is required (non-nullable).
BRONZE_FIELDS = (
    "id", "name", "brewery_type", "address_1", "address_2", "address_3", "city",
    "state_province", "postal_code", "country", "county_province", "phone",
    "website_url", "updated_at", "created_at",
)
BRONZE_REQUIRED = ("name",)

BRONZE_CONTRACT = T.StructType(
    [T.StructField(f, T.StringType(), f not in BRONZE_REQUIRED) for f in BRONZE_FIELDS])


class SchemaMismatchError(ValueError):
    """Raised when a DataFrame does not match its contract."""


class EmptyInputError(ValueError):
    """Raised by a stage whose input holds no rows (or cannot be read)."""


def all_strings(fields: Iterable[str | T.StructField], required: Iterable[str] = ()) -> T.StructType:
    """An all-text contract over ``fields`` (names or StructFields)."""
    req = set(required)
    names = [f.name if isinstance(f, T.StructField) else f for f in fields]
    return T.StructType([T.StructField(n, T.StringType(), n not in req) for n in names])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: cast present fields, null-fill missing, drop extras.

    Matching is case-sensitive on the name. Casts are Spark casts (for example a
    boolean becomes ``'true'``), evaluated per row inside whole-stage codegen.
    """
    present = set(df.columns)
    cols: list[Column] = []
    for field in contract.fields:
        if field.name in present:
            src = df[field.name]
            expr = src if df.schema[field.name].dataType == field.dataType else src.cast(field.dataType)
        else:
            expr = F.lit(None).cast(field.dataType)
        cols.append(expr.alias(field.name))
    return df.select(*cols)


def schema_diff(actual: T.StructType, expected: T.StructType, *, nullability: bool = True,
                order: bool = True) -> list[str]:
    """Human-readable differences between two schemas (empty list = equal).

    ``nullability=False`` ignores nullable flags (Parquet round trips make every
    field nullable); ``order=False`` compares fields by name only.
    """
    problems: list[str] = []
    a = {f.name: f for f in actual.fields}
    e = {f.name: f for f in expected.fields}
    for name in e:
        if name not in a:
            problems.append(f"missing field {name!r}")
    for name in a:
        if name not in e:
            problems.append(f"unexpected field {name!r}")
    for name, ef in e.items():
        af = a.get(name)
        if af is None:
            continue
        if af.dataType != ef.dataType:
            problems.append(f"field {name!r}: type {af.dataType.simpleString()} != "
                            f"{ef.dataType.simpleString()}")
        if nullability and af.nullable != ef.nullable:
            problems.append(f"field {name!r}: nullable {af.nullable} != {ef.nullable}")
    if order and not problems and [f.name for f in actual.fields] != [f.name for f in expected.fields]:
        problems.append("field order differs")
    return problems


def assert_schema(df: DataFrame, expected: T.StructType, *, strict: bool = True) -> DataFrame:
    """Raise ``SchemaMismatchError`` unless ``df`` matches ``expected``; return ``df``.

    ``strict`` also compares nullable flags (the behaviour before a write);
    ``strict=False`` is the check to use after a Parquet round trip.
    """
    problems = schema_diff(df.schema, expected, nullability=strict)
    if problems:
        raise SchemaMismatchError("Schema mismatch! " + "; ".join(problems))
    return df


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required column names absent from ``df`` (metadata only, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]
