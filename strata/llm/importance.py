"""Importance resampling towards a target distribution, with hashed n-grams and Arrow kernels.

A slice of texts is put in lower case, split at gaps, flattened and dictionary-encoded by
Arrow; the dictionary indices, shifted by one word and again, form the n-grams. Each
distinct n-gram of a slice is hashed once (CRC32, modulo the buckets). The first pass counts
features by bucket over all documents, and over all target texts; a bucket's gain is the log
ratio of the two smoothed shares. The second pass takes each feature's gain and reduces
them by document. Of the documents with enough words, the highest Gumbel-perturbed mean
gains are drawn, which samples without replacement; ranks are global, by a range-partitioned sort.

Null text has no words. A document without features weighs 0. A null id draws as an empty
one and loses ties; repeated rows share weight and score and each count (the order among them is the order of
rows). Texts of any length are read whole; a task holds a slice of ``SLICE`` bytes, or one longer text, and
one number per bucket. Empty tables give empty results; with an empty target every gain
comes from smoothing alone. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents
from strata.llm.words import slices, split_words

ORDER, BUCKETS, SEED, SHARE, MIN_WORDS = 1, 10_000, 2024, 10, 20
SLICE = 4 << 20


def feature_buckets(texts: pa.Array, order: int, buckets: int) -> Iterator[tuple]:
    """For each n-gram length: (bucket of every n-gram in order, number of them per text)."""
    words, counts = split_words(texts)
    coded = pc.dictionary_encode(words)
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    terms = [w.encode() for w in coded.dictionary.to_pylist()]
    owner = np.repeat(np.arange(len(counts)), counts)
    heads = [(k,) for k in range(len(terms))]  # the words of each distinct n-gram so far
    grams = index
    for n in range(1, order + 1):
        if n > 1:  # shift by one word; n-grams do not cross texts
            same = owner[n - 1:] == owner[:len(owner) - n + 1] if len(owner) >= n else owner[:0] > 0
            pairs = grams[:len(same)] * max(1, len(terms)) + index[n - 1:]
            live = pairs[same]
            kinds, packed = np.unique(live, return_inverse=True)
            heads = [(*heads[k // len(terms)], k % len(terms)) for k in kinds.tolist()]
            grams = np.zeros(len(same), np.int64)
            grams[same] = packed
            used, per_text = packed, np.bincount(owner[:len(same)][same], minlength=len(counts))
        else:
            used, per_text = grams, counts
        crc = np.fromiter((zlib.crc32(b" ".join(terms[k] for k in head)) % buckets
                           for head in heads), np.int64, len(heads))
        yield crc[used], per_text


def bucket_counts(df: DataFrame, text_col: str, order: int, buckets: int) -> DataFrame:
    """(bucket, n): features of all texts by bucket; a task sends one row per bucket at most."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text", SLICE):
            for found, _ in feature_buckets(part.column(0), order, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return (df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """Gain of each bucket from the two counts by bucket (``buckets`` rows at most)."""
    s, t = [0] * buckets, [0] * buckets
    for table, into in ((raw, s), (target, t)):
        for row in table.collect():
            into[row["bucket"]] = row["n"]
    of_raw, of_target = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((t[b] + 1.0) * of_raw / ((s[b] + 1.0) * of_target)))
            for b in range(buckets)]


def weigh(df: DataFrame, by_bucket: list[int], id_col: str, text_col: str,
          order: int) -> DataFrame:
    """(doc_id, n_words, n_features, total gain) of every row of ``df``."""
    gain = np.array(by_bucket, np.int64)

    def score(batches):
        for part in slices(batches, "text", SLICE):
            features = total = None
            for found, per_text in feature_buckets(part.column(1), order, len(gain)):
                taken = np.concatenate(([0], np.cumsum(np.take(gain, found))))
                ends = np.cumsum(per_text)
                sums = taken[ends] - taken[ends - per_text]
                if features is None:
                    words, features, total = per_text, per_text.copy(), sums
                else:
                    features, total = features + per_text, total + sums
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words), pa.array(features), pa.array(total)],
                names=["doc_id", "n_words", "n_features", "total"])

    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"]] + [
        T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "total")])
    return rows.mapInArrow(score, schema)


def with_rank(scratch: Scratch, df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``df`` with the row's place (1, 2, ...) in a total order, by a range-partitioned sort.

    Rows are dealt by ranges of the whole order, so no partition or tie holds more than its
    share; only the number of rows of each partition goes through the driver's plan.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = scratch.stage(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", 33)
    sizes = {r["part"]: r["n"] for r in
             placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for k in sorted(sizes):
        offsets.append((k, before))
        before += sizes[k]
    base = df.sparkSession.createDataFrame(offsets, "part long, before long")
    return (placed.withColumn("part", part).join(F.broadcast(base), "part")
            .withColumn(name, F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("part", "before", "place"))


def resample(spark: SparkSession, df: DataFrame, target: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", target_text_col: str = "text", order: int = ORDER,
             buckets: int = BUCKETS, seed: int = SEED, share: int = SHARE,
             min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``df``: doc_id, n_features, weight, score, rank (null: not drawn).

    ``share`` percent of the documents with ``min_words`` words are drawn.
    """
    scratch = Scratch(spark, "importance")
    model = gains(bucket_counts(df, text_col, order, buckets),
                  bucket_counts(target, target_text_col, order, buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8),
        16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    weight = F.when(F.col("n_features") > 0, F.expr(
        "(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    rows = scratch.stage(
        weigh(df, model, id_col, text_col, order).withColumn("weight", weight)
        .withColumn("score", F.col("weight") + noise)
        .withColumn("rid", F.monotonically_increasing_id()), "rows")
    able = rows.filter(F.col("n_words") >= min_words).select("rid", "score", "doc_id")
    drawn = able.count() * share // 100
    ranks = with_rank(scratch, able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                                      F.col("rid")]).filter(F.col("rank") <= drawn)
    return (rows.join(ranks.select("rid", "rank"), "rid", "left")
            .select("doc_id", "n_features", "weight", "score", "rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark, documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


#: CRC32 bit by bit over a word's bytes, once per distinct word.
ORACLE = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
f AS (SELECT doc_id, unnest(words) AS word FROM w),
v AS (SELECT DISTINCT word FROM (SELECT word FROM f UNION ALL SELECT word FROM b)),
hexes AS (SELECT word, hex(encode(word)) AS hx FROM v),
bits AS (
  SELECT word, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, len(hx) // 2),
        lambda i: ('0x' || hx[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), list_transform(range(0, 8), lambda x: 0::BIGINT)),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc
  FROM hexes),
bucket AS (SELECT word, xor(crc, 4294967295::BIGINT) % 10000 AS bucket FROM bits),
s AS (SELECT bucket, count(*) AS n FROM f JOIN bucket USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN bucket USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE
      * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
      / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket)),
per AS (
  SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS total
  FROM f JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features,
         coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
         (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296 AS p
  FROM documents LEFT JOIN per USING (doc_id)),
final AS (SELECT *, weight + floor(-1000 * ln(-ln(p)))::BIGINT AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place
           FROM final WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score::BIGINT AS score,
       CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM ranked) THEN place END::BIGINT AS rank
FROM final LEFT JOIN ranked USING (doc_id)
"""
