"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """A column by its name, whatever marks (dots, spaces, backticks) the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def date_parts(ts: str | Column, prefix: str = "") -> list[Column]:
    """``year``, ``month``, ``day`` columns of a date/timestamp expression."""
    c = col(ts) if isinstance(ts, str) else ts
    return [F.year(c).alias(f"{prefix}year"), F.month(c).alias(f"{prefix}month"),
            F.dayofmonth(c).alias(f"{prefix}day")]


def exact_sum(value: str | Column, scale: int | None, precision: int = 18) -> Column:
    """Sum of a number as double, in fixed-point decimal if the data's ``scale`` is given.

    Summing the decimal makes the result independent of row order (a double sum
    is not), so every partitioning of the data gives the same bits. It rounds each value
    to ``scale`` decimals, so it is the caller's statement about the data; ``None`` sums
    the values as they are.
    """
    c = col(value) if isinstance(value, str) else value
    if scale is None:
        return F.sum(c.cast("double"))
    return F.sum(c.cast(T.DecimalType(precision, scale))).cast("double")


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can order values of ``dtype`` (maps, variants cannot)."""
    if isinstance(dtype, T.MapType) or type(dtype).__name__ == "VariantType":
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True
