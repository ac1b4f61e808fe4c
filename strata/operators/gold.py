"""Gold: counts and statistics per dimension, top-N and point lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col, date_parts, exact_sum

# The Gold grouping of the Silver layer and its measure.
GOLD_KEYS = ("state", "brewery_type")
GOLD_MEASURE = "id"
GOLD_ALIAS = "qty"


def _ordered(df: DataFrame, measure: str, keys: Sequence[str]) -> DataFrame:
    # Total order: measure descending, ties broken by the keys (nulls first).
    return df.orderBy(col(measure).desc(), *[col(k).asc_nulls_first() for k in keys])


def count_by(df: DataFrame, keys: Sequence[str] = GOLD_KEYS, measure: str | None = GOLD_MEASURE,
             alias: str = GOLD_ALIAS, order: bool = True) -> DataFrame:
    """``count(measure)`` per key combination (``count(*)`` when ``measure`` is None).

    ``count`` skips nulls, so a group made only of null ids has ``qty = 0``.
    Partial aggregation runs map-side, so hot keys shrink before the shuffle.
    With ``order`` the result is sorted by count descending then keys.
    """
    cnt = F.count(F.lit(1)) if measure is None else F.count(col(measure))
    out = df.groupBy(*map(col, keys)).agg(cnt.alias(alias))
    return _ordered(out, alias, keys) if order else out


def count_non_null_keys(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    """``count(*)`` per key combination over rows whose keys are all non-null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & col(k).isNotNull()
    return df.filter(cond).groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias(alias))


def stats_by(df: DataFrame, keys: Sequence[str], value: str,
             scale: int | None = None) -> DataFrame:
    """count / min / max / sum / avg of ``value`` per key.

    ``avg`` is the sum divided by the count. With ``scale``, the number of decimals the
    data have, the sum is in fixed point and does not depend on row order; without it the
    values are summed as they are.
    """
    total = exact_sum(value, scale)
    return df.groupBy(*map(col, keys)).agg(
        F.count(col(value)).alias("n"),
        F.min(col(value)).alias(f"min_{value}"),
        F.max(col(value)).alias(f"max_{value}"),
        total.alias(f"sum_{value}"),
        (total / F.count(col(value))).alias(f"avg_{value}"),
    )


def date_part_stats(df: DataFrame, ts: str, value: str,
                    scale: int | None = None) -> DataFrame:
    """``stats_by`` on ``year, month, day`` derived from ``ts``."""
    parts = date_parts(ts)
    return stats_by(df.select(*parts, value), ["year", "month", "day"], value, scale)


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows of a total order (``TakeOrderedAndProject``: per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)


def gold_top_n(gold: DataFrame, n: int, measure: str = GOLD_ALIAS,
               keys: Sequence[str] = GOLD_KEYS) -> DataFrame:
    """Top-``n`` groups by measure, ties broken by the keys."""
    return top_n(gold, n, [col(measure).desc(), *[col(k).asc_nulls_first() for k in keys]])


def point_lookup(df: DataFrame, **equals) -> DataFrame:
    """Rows where every ``column == value`` (a filter Catalyst pushes to the scan)."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (col(c).isNull() if v is None else (col(c) == F.lit(v)))
    return df.filter(cond)
