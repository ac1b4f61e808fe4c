"""Joins against reference tables: broadcast only behind a proven size bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col, exact_sum

#: Largest reference table ever broadcast by ``enrich``: rows and bytes.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(dim: DataFrame):
    """Per-row size: exact for text/binary, JSON length for nested values, 8 otherwise."""
    size = F.lit(0)
    for f in dim.schema.fields:
        t, c = f.dataType, col(f.name)
        if isinstance(t, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        elif isinstance(t, T.DecimalType):
            size = size + F.lit(16)
        else:
            size = size + F.lit(8)  # other fixed-width scalars: at most 8 bytes
    return size


def fits_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows and ``max_bytes`` bytes of data.

    The probe is one plain aggregate: every task sums its own rows, one row per task is
    shuffled. It reads the reference table once, and it measures text columns exactly
    rather than trusting statistics.
    """
    probe = dim.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(_row_bytes(dim)), F.lit(0)).alias("b"))
    r = probe.first()
    return r["n"] <= max_rows and r["b"] <= max_bytes


def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
           max_broadcast_rows: int = MAX_BROADCAST_ROWS,
           max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``fact`` with a reference table.

    The reference side is broadcast (``BroadcastHashJoin``, no shuffle of the
    fact side, immune to skewed join keys) only when it is proven under
    ``max_broadcast_rows`` rows and ``max_broadcast_bytes`` bytes; otherwise the
    join is a sort-merge join, which adaptive execution splits for skewed keys.
    """
    small = fits_broadcast(dim, max_broadcast_rows, max_broadcast_bytes)
    # Over the bound, pin a shuffle join so no optimistic size estimate broadcasts it.
    right = F.broadcast(dim) if small else dim.hint("shuffle_merge")
    return fact.join(right, on=on, how=how)


def enrich_and_aggregate(fact: DataFrame, dim: DataFrame, on: str, fact_keys: Sequence[str],
                         dim_keys: Sequence[str], value: str | None = None,
                         scale: int | None = None,
                         max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                         max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join then group: ``count(*)`` (and a ``sum(value)``, exact at ``scale``) per dim × fact keys.

    * Reference side proven small: broadcast hash join on the map side, then one
      partial + final aggregate; the only shuffle carries groups.
    * Otherwise: the fact side is first reduced to one row per (join key, fact
      keys), so the shuffle join and the final aggregate see groups, not rows.

    Output: ``*dim_keys, *fact_keys, n`` (+ ``sum_<value>``).
    """
    dim = dim.select(on, *dim_keys)
    if fits_broadcast(dim, max_broadcast_rows, max_broadcast_bytes):
        return enrich_and_aggregate_plain(fact, F.broadcast(dim), on, fact_keys, dim_keys,
                                          value, scale)
    pre = [F.count(F.lit(1)).alias("n")]
    if value is not None:
        exact = "double" if scale is None else f"decimal(18,{scale})"
        pre.append(F.sum(col(value).cast(exact)).alias("_sum"))
    reduced = fact.groupBy(on, *fact_keys).agg(*pre)
    post = [F.sum("n").cast("bigint").alias("n")]
    if value is not None:
        post.append(F.sum("_sum").cast("double").alias(f"sum_{value}"))
    joined = reduced.join(dim.hint("shuffle_merge"), on, "inner")
    return joined.groupBy(*dim_keys, *fact_keys).agg(*post)


def enrich_and_aggregate_plain(fact: DataFrame, dim: DataFrame, on: str, fact_keys: Sequence[str],
                               dim_keys: Sequence[str], value: str | None = None,
                               scale: int | None = None) -> DataFrame:
    """Join the rows, then group (the broadcast path of ``enrich_and_aggregate``)."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n")]
    if value is not None:
        aggs.append(exact_sum(value, scale).alias(f"sum_{value}"))
    return fact.join(dim, on).groupBy(*dim_keys, *fact_keys).agg(*aggs)
