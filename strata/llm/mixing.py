"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: sources in code point order (null last) weigh ``WEIGHTS`` in turn and share
``SHARE`` times all words; a target stops at ``MOST`` times its source's size and the excess
is shared anew by weight until none is above. A source's documents are dealt into blocks
by a hash of the document, about four times the square root of its documents of them,
so neither blocks nor documents of one block grow with a hot source as the source does.
Whole passes over a source draw every block; the last, partial pass draws blocks in
permuted order until the next one would pass the target, and of the ``TAIL`` blocks from
there on the documents, in permuted order, that still fit. So a source falls short of its
target by less than the shortest document left out there.

The draws of all sources are block quotas. A binary tree over the output shards splits the
quota vector: a child's share is a multivariate-hypergeometric draw, seeded by its node, so
each shard finds its quotas on its own path from the root, quotas add up exactly and no
draw is used twice. Each shard takes the next blocks of each source's permutation and
shuffles its documents by a hash. All randomness is seeded: reruns agree.

A null text has size 0, as has one without words; size 0 is never taken. Null sources are a
source of their own; null ids and repeated rows are documents like any other. An empty
table gives an empty mix. The driver sees one number per source, never a document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, columns, documents, small

WEIGHTS, SHARE, MOST, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, "mix-1"
SHARD_WORDS, TAIL = 1 << 25, 32


def word_count(text):
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("long")


def targets(scratch: Scratch, sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, ...) with nth (code point order) and target."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("nth", F.row_number().over(order) - 1)
    weigh = F.array(*map(F.lit, WEIGHTS))[F.col("nth") % len(WEIGHTS)]
    ranked = scratch.stage(ranked.withColumn("weight", weigh), "weights")
    cap = MOST * F.col("source_size")
    level, above = 0.0, -1
    while True:  # the level rises and the capped sources with it, until none is above
        at = F.col("weight") * F.lit(level) >= cap
        row = ranked.agg(F.count(F.when(at, 1)), F.sum(F.when(at, cap)),
                         F.sum(F.when(~at, F.col("weight"))), F.sum("source_size")).first()
        if row[0] == above or not row[2]:
            break
        above, level = row[0], (SHARE * row[3] - (row[1] or 0.0)) / row[2]
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: str = SEED) -> np.ndarray:
    """The blocks of each source that a shard gets: its path down the splitting tree."""
    import xxhash

    lo, hi, left = 0, shards, np.asarray(quotas, np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        key = xxhash.xxh64_intdigest(f"{seed}:{lo}:{hi}")
        total = int(left.sum())
        part = np.random.Generator(np.random.Philox(key=key)).multivariate_hypergeometric(
            left, total * (mid - lo) // (hi - lo), method="marginals")
        lo, hi, left = (lo, mid, part) if shard < mid else (mid, hi, left - part)
    return left


def _draws(spark: SparkSession, scratch: Scratch, blocks: DataFrame, shards: int) -> DataFrame:
    """(nth, block, shards): which shards each block goes to; ``blocks`` has its passes."""
    quotas = {r["nth"]: r["q"] for r in
              blocks.groupBy("nth").agg(F.sum("passes").alias("q")).collect()}
    order = sorted(quotas)
    vector = np.array([quotas[k] for k in order], np.int64)

    def leaves(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for shard in part["id"]:
                own = shard_quotas(vector, shards, int(shard))
                yield pd.DataFrame({"nth": order, "shard": int(shard), "n": own})

    taken = scratch.stage(spark.range(shards).mapInPandas(leaves, "nth int, shard int, n long"),
                          "leaves") if order else spark.createDataFrame(
                              [], "nth int, shard int, n long")
    before = Window.partitionBy("nth").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, 0)
    slots = (taken.withColumn("hi", F.sum("n").over(before)).filter("n > 0")
             .select("nth", "shard", F.explode(F.sequence(F.col("hi") - F.col("n"),
                                                          F.col("hi") - 1)).alias("slot")))
    permuted = Window.partitionBy("nth").orderBy(
        F.xxhash64(F.lit(SEED), "nth", "block", "copy"), "block", "copy")
    draws = (blocks.filter("passes > 0")
             .select("nth", "block", F.explode(F.sequence(F.lit(1), "passes")).alias("copy"))
             .withColumn("slot", (F.row_number().over(permuted) - 1).cast("long")))
    return (draws.join(slots, ["nth", "slot"]).groupBy("nth", "block")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))),
                             lambda d: d["shard"]).alias("shards")))


def _fitting(docs: pd.DataFrame) -> pd.DataFrame:
    """Of a source's tail, the documents that fit one after another in permuted order."""
    docs = docs.sort_values(["h", "id", "size"], kind="stable")
    room, rids = float(docs["room"].iloc[0]), []
    for rid, size in zip(docs["rid"], docs["size"]):
        if 0 < size <= room:
            room -= size
            rids.append(rid)
    return pd.DataFrame({"rid": pd.Series(rids, dtype="int64")})


def mixture(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", shard_words: int = SHARD_WORDS,
            keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: doc_id, size, source_size, target, taken, copies, shards.

    ``keep`` names columns of ``df`` to carry, as a struct ``row``.
    """
    scratch = Scratch(spark, "mixing")
    text = F.col(text_col).cast("string")
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(F.lit(SEED), F.col(id_col).cast("string"), text).alias("h"),
        *([F.struct(*columns(df, keep)).alias("row")] if keep else []))
    rows = scratch.stage(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")
    sources = scratch.stage(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")), "sources")
    sources = scratch.stage(targets(scratch, sources).select(
        "source", "source_size", "target", "nth",
        F.ceil(4 * F.sqrt("n_rows")).cast("long").alias("n_blocks"),
        F.when(F.col("target") >= MOST * F.col("source_size"), F.lit(int(MOST)))
        .otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int").alias("whole"))
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    key = ["source", "source_size", "target", "nth", "whole", "n_blocks"]
    docs = (rows.withColumnRenamed("source", "s")
            .join(small(sources), F.col("s").eqNullSafe(F.col("source")))
            .withColumn("block", F.pmod("h", "n_blocks")))
    sums = (docs.groupBy("nth", "block").agg(F.sum("size").alias("words"))
            .join(small(sources.select("nth", "whole", "extra")), "nth"))
    source = Window.partitionBy("nth")
    permuted = source.orderBy(F.xxhash64(F.lit(SEED), "nth", "block"), "block")
    full = (F.col("extra") > 0) & (F.sum("words").over(permuted) <= F.col("extra"))
    marked = sums.withColumn("pos", F.row_number().over(permuted)).withColumn("full", full)
    n_full = F.sum(F.col("full").cast("int")).over(source)
    blocks = scratch.stage(marked.select(
        "nth", "block", "whole", "full",
        F.when((F.col("extra") > 0) & (F.col("pos") > n_full) & (F.col("pos") <= n_full + TAIL),
               F.col("extra") - F.sum(F.when(F.col("full"), F.col("words")).otherwise(0))
               .over(source)).alias("room"))
        .withColumn("passes", F.col("whole") + (F.col("full") | F.col("room").isNotNull())
                    .cast("int")), "blocks")
    total = int(sources.agg(F.sum("target")).first()[0] or 0)
    shards = max(1, math.ceil(total / shard_words))
    places = scratch.stage(
        blocks.join(_draws(spark, scratch, blocks, shards), ["nth", "block"], "left")
        .select("nth", "block", "room", "full", F.coalesce(
            "shards", F.array().cast("array<int>")).alias("shards")), "places")
    docs = docs.join(small(places), ["nth", "block"])
    tail = docs.filter(F.col("room").isNotNull())
    fit = scratch.stage(
        tail.select("nth", "rid", "h", F.col("doc_id").cast("string").alias("id"), "size", "room")
        .groupBy("nth").applyInPandas(_fitting, "rid long"), "fit").withColumn("last", F.lit(1))
    some = tail.join(small(fit), "rid", "left").withColumn("last", F.coalesce("last", F.lit(0)))
    whole = docs.filter(F.col("room").isNull()).withColumn("last", F.col("full").cast("int"))
    out = whole.unionByName(some).withColumn(
        "copies", F.when(F.col("size") > 0, F.col("whole") + F.col("last")).otherwise(0))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "copies",
                      F.slice("shards", F.lit(1), F.col("copies")).alias("shards"), "h",
                      *(["row"] if keep else []))


def mix(spark: SparkSession, df: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as it was taken, shard by shard.

    Rows are dealt by shard and shuffled inside it; columns are those of ``df``.
    """
    out = mixture(spark, df, keep=df.columns, **options)
    return (out.select("row", "h", F.posexplode("shards").alias("copy", "shard"))
            .withColumn("at", F.xxhash64(F.lit(SEED), "shard", "h", "copy"))
            .repartition("shard", F.pmod("at", F.lit(8)))
            .sortWithinPartitions("shard", "at").select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(spark, documents(spark, sf_dir)).drop("h")
