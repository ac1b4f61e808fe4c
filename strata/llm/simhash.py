"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint's 64 bits are cut into two segments of 32. Two fingerprints that differ in
at most three bits differ in at most one bit of some segment, so the Hamming ball of
radius one round each segment's value, looked up in the table of that segment, meets
every such pair; a match is verified on all 64 bits. One of two values that differ in
one bit has it clear, so only the flips of clear bits are enumerated. Equal fingerprints
are one entry of the tables, however many documents share them. A table value that more
than ``DENSE`` fingerprints share is looked up by a longer key: the other segment is cut
once more, into halves of 16 bits, of which one again differs in at most one bit; so no
bucket grows with a family of near copies and no match is lost.

Null text has no words, as has empty text: fingerprint zero, linked like any other. Null
ids never name a component unless all its ids are null. Repeated rows share fingerprint
and component. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, columns, documents, fresh, small
from strata.llm.components import components

SHINGLE, MAX_BITS, DENSE = 3, 3, 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles (XXH64, seed 42), as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - shingle + 1]
        one = xxhash.xxh64_intdigest
        hashes = [one(joined[a:b], 42) for a, b in zip(starts.tolist(),
                                                       ends[shingle - 1:].tolist())]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        some = np.array(hashes[at:at + 65536], np.uint64)
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(shingle: int = SHINGLE):
    """A column function: text to fingerprint."""

    @F.pandas_udf("long")
    def simhash(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint(t, shingle) for t in part], dtype="int64")

    return simhash


def _flips(value, width: int):
    """``value`` itself and with each clear bit of its low ``width`` bits set."""
    bits = F.sequence(F.lit(0), F.lit(width - 1))
    flipped = F.filter(F.transform(bits, lambda b: F.call_function("shiftleft",
                                                                   F.lit(1).cast("long"), b)),
                       lambda m: value.bitwiseAND(m) == 0)
    return F.concat(F.array(value), F.transform(flipped, lambda m: value.bitwiseOR(m)))


def _ball(value, width: int):
    """``value`` itself and with each of its low ``width`` bits changed."""
    bits = F.sequence(F.lit(0), F.lit(width - 1))
    return F.concat(F.array(value), F.transform(
        bits, lambda b: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))))


def links(scratch: Scratch, prints: DataFrame, max_bits: int = MAX_BITS,
          dense: int = DENSE) -> DataFrame:
    """(u, v): all pairs of distinct fingerprints ``prints`` (fp) that differ in 1 to
    ``max_bits`` bits, ``max_bits`` being at most three; a pair may come twice."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one hold for at most three bits")
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    segments = F.array(
        F.struct(F.lit(0).alias("seg"), low.alias("key"), high.alias("rest")),
        F.struct(F.lit(1).alias("seg"), high.alias("key"), low.alias("rest")))
    table = prints.select("fp", F.explode(segments).alias("s")).select("fp", "s.*")
    hot = scratch.stage(table.groupBy("seg", "key").count().filter(F.col("count") > dense)
                        .select("seg", "key", F.lit(True).alias("hot")), "hot")
    probes = (table.select("fp", "seg", "rest", F.explode(_flips(F.col("key"), 32)).alias("key")))
    near = (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits) & (
        F.col("a.fp") != F.col("b.fp"))
    a, b = probes, table
    if hot.isEmpty():
        a, b, on = a.alias("a"), b.alias("b"), ["seg", "key"]
    else:
        halves = lambda of: F.array(
            F.struct(F.lit(1).alias("half"), of(F.col("rest").bitwiseAND(F.lit(0xFFFF)))
                     .alias("subs")),
            F.struct(F.lit(2).alias("half"), of(F.shiftright("rest", 16)).alias("subs")))
        plain = F.array(F.struct(F.lit(0).alias("half"),
                                 F.array(F.lit(0).cast("long")).alias("subs")))

        def finer(df, of):
            marked = df.join(small(hot), ["seg", "key"], "left")
            return (marked.withColumn("h", F.explode(F.when(F.col("hot"), halves(of))
                                                     .otherwise(plain)))
                    .select("fp", "seg", "key", "h.half", F.explode("h.subs").alias("sub")))

        a = finer(a, lambda v: _ball(v, 16)).alias("a")
        b = finer(b, lambda v: F.array(v)).alias("b")
        on = ["seg", "key", "half", "sub"]
    cond = near
    for c in on:
        cond = cond & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return a.join(b, cond).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def _classes(scratch: Scratch, prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root) of every fingerprint of ``prints`` (fp, distinct and staged)."""
    roots = components(scratch, links(scratch, prints, max_bits))
    return (prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint (hex), component_id."""
    scratch = Scratch(spark, "simhash")
    rows = scratch.stage(df.select(F.col(id_col).alias("doc_id"),
                                   fingerprints(shingle)(F.col(text_col)).alias("fp")), "rows")
    firsts = scratch.stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    classes = scratch.stage(_classes(scratch, firsts.select("fp"), max_bits), "classes")
    named = (firsts.join(classes, "fp").groupBy("root")
             .agg(F.min("first_id").alias("component_id")))
    ids = scratch.stage(classes.join(named, "root").select("fp", "component_id"), "ids")
    return rows.join(small(ids), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one row (the smallest id) of each component, columns unchanged."""
    scratch = Scratch(spark, "simhash")
    rid, fp = fresh(df, "rid", "fp")
    whole = scratch.stage(df.withColumn(rid, F.monotonically_increasing_id())
                          .withColumn(fp, fingerprints(shingle)(F.col(text_col))), "rows")
    rows = whole.select(F.col(rid).alias("rid"), F.col(id_col).alias("id"), F.col(fp).alias("fp"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("rid"))
    firsts = scratch.stage(rows.groupBy("fp").agg(F.min(rank).alias("first")), "prints")
    classes = _classes(scratch, firsts.select("fp"), max_bits)
    kept = (firsts.join(classes, "fp").groupBy("root").agg(F.min("first").alias("k"))
            .select(F.col("k.rid").alias("rid")))
    lost = scratch.stage(rows.select("rid").join(kept, "rid", "left_anti")
                         .select(F.col("rid").alias(rid)), "lost")
    return whole.join(small(lost), rid, "left_anti").select(*columns(df))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, documents(spark, sf_dir))
