"""Distinct counts over many snapshots from stored sketches.

Each snapshot keeps one HyperLogLog sketch per column next to its layer. A figure over any
dates merges those few kilobytes: no row of any snapshot is scanned again, and rows that
repeat across dates count once, which stored counts could not tell.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col
from strata.functions.contracts import EmptyInputError
from strata.sinks.writes import write_snapshot
from strata.sources.scans import SNAPSHOT_KEY, read_snapshot

LG_K = 14
SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("non_null", T.LongType()), T.StructField("sketch", T.BinaryType())])


def relative_error(lg_k: int = LG_K, sigmas: float = 3) -> float:
    """The relative error of a merged estimate, ``sigmas`` standard errors (1.04 / sqrt(k))."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def _text(df: DataFrame, c: str):
    """A value as the sketch takes it: text, whatever its type, so types may drift over time."""
    x = col(c)
    return x.cast("string") if isinstance(df.schema[c].dataType, T.AtomicType) else F.when(
        x.isNotNull(), F.to_json(F.struct(x)))


def distinct_sketches(df: DataFrame, columns: Sequence[str] | None = None,
                      lg_k: int = LG_K) -> DataFrame:
    """``column_name, rows, non_null, sketch`` per column: one pass, bounded size per task."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        x = _text(df, c)
        aggs += [F.count(x).alias(f"_n{i}"), F.hll_sketch_agg(x, lg_k).alias(f"_s{i}")]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"),
                 F.col(f"_n{i}").alias("non_null"), F.col(f"_s{i}").alias("sketch"))
        for i, c in enumerate(columns)])))


def write_distinct_sketches(df: DataFrame, base: str, snapshot,
                            columns: Sequence[str] | None = None, lg_k: int = LG_K) -> int:
    """Keep a snapshot's sketches under ``base``; a rerun of the date replaces them."""
    return write_snapshot(distinct_sketches(df, columns, lg_k), base, snapshot)


def merged_distinct(spark: SparkSession, base: str, first: dt.date | None = None,
                    last: dt.date | None = None, key: str = SNAPSHOT_KEY) -> DataFrame:
    """``column_name, snapshots, rows, non_null, distinct_estimate`` over the dates from
    ``first`` to ``last`` (both included; None is open), from the sketch files alone."""
    kept = read_snapshot(spark, base, key=key, schema=SCHEMA, require=False)
    if key not in kept.columns:
        raise EmptyInputError(f"{base} has no sketches by {key}")
    if first is not None:
        kept = kept.filter(F.col(key) >= F.lit(first))
    if last is not None:
        kept = kept.filter(F.col(key) <= F.lit(last))
    return kept.groupBy("column_name").agg(
        F.count_distinct(key).alias("snapshots"), F.sum("rows").alias("rows"),
        F.sum("non_null").alias("non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("distinct_estimate"))
