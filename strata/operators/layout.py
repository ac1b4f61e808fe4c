"""Physical-layout inspection: how rows spread over keys and partitions, and which keys are hot."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col

def bucket_skew(df: DataFrame, bucket: Column, alias: str = "bucket") -> DataFrame:
    """Rows per logical bucket and each bucket's share of all rows.

    Output ``bucket, n_rows, share``. The total is a scalar subquery that counts rows and reads
    no column, so no task holds all buckets, however many values ``bucket`` has.
    """
    per = df.groupBy(bucket.alias(alias)).agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return per.select(alias, "n_rows", (F.col("n_rows") / total).alias("share"))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The shuffle-like bucket of a key of any types (nulls are values of their own)."""
    parts = [x for k in keys for x in (col(k).isNull(), col(k).cast("string"))]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def key_skew(df: DataFrame, key: str | Sequence[str], buckets: int) -> DataFrame:
    """``bucket_skew`` of a key: ``pmod(key, buckets)`` of an integral column, the hash bucket of
    a text or composite one."""
    keys = [key] if isinstance(key, str) else list(key)
    integral = len(keys) == 1 and dict(df.dtypes).get(keys[0]) in (
        "tinyint", "smallint", "int", "bigint")
    return bucket_skew(df, F.pmod(col(keys[0]), F.lit(buckets)) if integral
                       else key_bucket(keys, buckets))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition of ``df`` (``spark_partition_id``); plan-dependent."""
    return bucket_skew(df, F.spark_partition_id(), alias="partition_id")


def _packed(keys: Sequence[str]) -> Column:
    """A key of any types as one text: each part with its length, null as a mark of its own."""
    parts = [F.when(col(k).isNull(), F.lit("-")).otherwise(F.concat(
        F.char_length(col(k).cast("string")).cast("string"), F.lit(":"),
        col(k).cast("string"))) for k in keys]
    return F.concat(*parts)


def _tracked(min_share: float) -> tuple[int, int]:
    """Items that the sketch tracks, and candidates to ask it for, so that no key with
    ``min_share`` of the rows is missed.

    A frequent-items sketch of ``m`` items errs by ``3.5 / m`` of the rows at most; with a
    quarter of ``min_share`` as that error, a hot key's lower bound is 3/4 of it, which at most
    ``4 / (3 * min_share)`` keys can have.
    """
    return math.ceil(3.5 / (min_share / 4)), math.ceil(4 / (3 * min_share))


def key_sketch(df: DataFrame, keys: Sequence[str], min_share: float,
               by: Sequence[str] = ()) -> DataFrame:
    """``(by…, sketch)``: mergeable frequent-items sketches of a key, for example one a day.

    Store them and merge any days with ``sketch_candidates``: no row is read again.
    """
    tracked, _ = _tracked(min_share)
    return (df.select(*map(col, by), _packed(keys).alias("_key")).groupBy(*map(col, by))
            .agg(F.expr(f"approx_top_k_accumulate(_key, {tracked})").alias("sketch")))


def sketch_candidates(sketches: DataFrame, min_share: float) -> DataFrame:
    """``packed, estimate``: the keys that may have ``min_share`` of the rows of all sketches."""
    tracked, candidates = _tracked(min_share)
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("s"))
    return merged.select(F.expr(f"inline(approx_top_k_estimate(s, {candidates}))")).select(
        F.col("item").alias("packed"), F.col("count").alias("estimate"))


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01,
             buckets: int | None = None, sketches: DataFrame | None = None) -> DataFrame:
    """Every key with at least ``min_share`` of the rows: the key, ``n_rows``, ``share`` and,
    with ``buckets``, its ``bucket``.

    Keys are columns of any simple types, one or several, nulls included. A frequent-items
    sketch (bounded size, partial per task) names the candidates, at most ``4 / (3 *
    min_share)``; only their rows are then counted, exactly, and reduced per task. So the
    distinct keys are never grouped or shuffled. ``sketches`` (of ``key_sketch``, with the same
    ``min_share``) spare the first pass.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share is a share of the rows, above 0 and at most 1")
    keys = list(keys)
    made = sketches if sketches is not None else key_sketch(df, keys, min_share)
    wanted = F.broadcast(sketch_candidates(made, min_share).select("packed"))
    counted = (df.select(*map(col, keys), _packed(keys).alias("packed"))
               .join(wanted, "packed", "left_semi")
               .groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias("n_rows")))
    total = df.agg(F.count(F.lit(1))).scalar()
    out = (counted.withColumn("share", F.col("n_rows") / total)
           .filter(F.col("share") >= min_share))
    return out if buckets is None else out.withColumn("bucket", key_bucket(keys, buckets))
