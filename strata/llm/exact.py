"""Exact duplicates by distributed most-significant-digit radix partitioning.

Rows are split by the length of their normalised text and then by successive pieces of
its bytes, each round's pieces longer than the last one's. A group of one row is done;
a group whose bytes have ended holds equal texts. Groups are compared byte by byte, so
equality rests on no digest. Each round groups by (group, piece) with map-side
partial aggregation, which reduces a group of copies to one row per task before the
shuffle, and deals the surviving rows on by a join with the groups of two or more:
broadcast when those are few, else a sort-merge join that adaptive execution splits.
Only rows that still share all their bytes with another row travel to the next round.

Null text counts as empty; null ids lose every tie; of equal texts with equal ids, one
row stays. Empty tables give empty results, other columns are ignored (or carried).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, ascii_lower, columns, documents, fresh, small, with_row_id

FIRST_BYTES, NEXT_BYTES, GROWTH = 64, 256, 8


def _body(text: str):
    return ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("binary")


def _split(scratch: Scratch, rows: DataFrame, keys: list[str], state: DataFrame) -> DataFrame:
    """One radix step: ``state`` rows of the groups by ``keys`` that ``rows`` has twice or more."""
    groups = scratch.stage(
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min("rid").alias("next_gid"))
        .filter("n_rows > 1").drop("n_rows"), "groups")
    return state.join(small(groups), keys)


def equal_texts(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """(rid, id, gid) of the rows (rid, id, body) whose body another row has too.

    ``rows`` must be a staged table: it is read twice.
    """
    head = (rows.withColumn("n", F.octet_length("body"))
            .withColumn("piece", F.expr(f"substring(body, 1, {FIRST_BYTES})")))
    state = scratch.stage(
        _split(scratch, head.select("rid", "n", "piece"), ["n", "piece"], head)
        .select("rid", "id", F.col("next_gid").alias("gid"),
                F.expr(f"substring(body, {FIRST_BYTES + 1})").alias("rest")), "state")
    done, size = [], NEXT_BYTES
    while True:
        ended = state.filter(F.octet_length("rest") == 0).select("rid", "id", "gid")
        done.append(scratch.stage(ended, "ended"))
        going = state.filter(F.octet_length("rest") > 0)
        if going.isEmpty():
            scratch.drop(state)
            break
        cut = going.withColumn("piece", F.expr(f"substring(rest, 1, {size})"))
        new = scratch.stage(
            _split(scratch, cut.select("rid", "gid", "piece"), ["gid", "piece"], cut)
            .select("rid", "id", F.col("next_gid").alias("gid"),
                    F.expr(f"substring(rest, {size + 1})").alias("rest")), "state")
        scratch.drop(state)
        state, size = new, size * GROWTH
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _members(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """(rid, keep_id, group_size, kept) of rows that have copies."""
    found = equal_texts(scratch, rows)
    groups = scratch.stage(
        found.groupBy("gid").agg(F.count(F.lit(1)).alias("group_size"),
                                 F.max(F.struct("id", "rid")).alias("keep")), "classes")
    return found.join(small(groups), "gid").select(
        "rid", F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("keep.rid") == F.col("rid")).alias("kept"))


def exact_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    scratch = Scratch(spark, "exact")
    rows = scratch.stage(
        df.select(F.col(id_col).alias("id"), _body(text_col).alias("body"))
        .withColumn("rid", F.monotonically_increasing_id())
        .withColumn("sha", F.sha2("body", 256)), "rows")
    members = _members(scratch, rows.select("rid", "id", "body"))
    return (rows.select("rid", "id", "sha").join(members, "rid", "left")
            .select(F.col("id").alias("doc_id"),
                    F.when(F.col("kept").isNull(), F.col("id"))
                    .otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce("kept", F.lit(True)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_exact_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``df`` with one row (the largest id) of each group of equal texts, columns unchanged."""
    scratch = Scratch(spark, "exact")
    rid = fresh(df, "rid")[0]
    whole = with_row_id(scratch, df, rid)
    rows = whole.select(F.col(rid).alias("rid"), F.col(id_col).alias("id"),
                        _body(text_col).alias("body"))
    lost = scratch.stage(_members(scratch, rows).filter("not kept")
                         .select(F.col("rid").alias(rid)), "lost")
    return whole.join(small(lost), rid, "left_anti").select(*columns(df))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark, documents(spark, sf_dir))


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM d WINDOW same AS (PARTITION BY body)
"""
