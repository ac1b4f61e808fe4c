"""Quality rules: surface counts, then a hashed n-gram log-likelihood ratio.

Two multinomials over ``BUCKETS`` hashed character 4-grams are counted: one over every
document (the raw corpus), one over trusted documents (label quality 1). Counting is one
pass whose tasks each emit one count per bucket; the sums, ``BUCKETS`` rows at any input
size, become a weight per bucket, the log of its trusted over its raw probability with
additive smoothing. A document's score is the mean weight of its n-grams (its
log-likelihood ratio over its length), and every document with a score below
``THRESHOLD`` is rejected. The trusted ids are those of the ``MAX_TRUSTED`` trusted labels
whose id hashes lowest (a documented bound on labelled rows); they are broadcast.

Null and empty texts have no words and fail the base rules. Null ids are never trusted.
Without trusted documents all weights are zero and the base rules alone decide. A text of
under four characters scores zero. Texts are counted in blocks, so a very long one needs
no more memory than its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import columns, documents, fresh, texts

GRAM, BUCKETS, SMOOTHING = 4, 1 << 16, 1.0
THRESHOLD, MAX_TRUSTED = -0.5, 65_536
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
_BLOCK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str) -> Iterator[np.ndarray]:
    """The hashed 4-grams of a text's code points, block by block."""
    for at in range(0, max(len(text) - GRAM + 1, 0), _BLOCK):
        block = text[at:at + _BLOCK + GRAM - 1].encode("utf-32-le", "surrogatepass")
        c = np.frombuffer(block, np.uint32).astype(np.uint64)
        h = c[:-3] | (c[1:-2] << np.uint64(21)) | (c[2:-1] << np.uint64(42))
        h = (h ^ (h >> np.uint64(29))) * _MIX + c[3:]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        yield (h >> np.uint64(48)).astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    _, pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True,
                                 return_counts=True)
    twice = times[window] > 1
    if not twice.any():
        return 0
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= twice
    return int(inside.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(SPACES):
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)),
            sum(map(text.count, SYMBOLS)), again, repeated_words(words))


def count_grams(spark: SparkSession, df: DataFrame, trusted: DataFrame, id_col: str,
                text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts of the raw corpus and of its trusted documents."""

    def count(batches):
        raw, good, any_row = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), False
        for batch, bodies in texts(batches, "text"):
            for text, mark in zip(bodies, batch.column(1).to_pylist()):
                for b in buckets(text):
                    any_row = True
                    own = np.bincount(b, minlength=BUCKETS) if len(b) > 4096 else None
                    for counts in (raw, good) if mark else (raw,):
                        if own is None:
                            np.add.at(counts, b, 1)
                        else:
                            counts += own
        at = np.flatnonzero(raw)
        if any_row:
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(good[at])],
                names=["bucket", "raw", "good"])

    ids = trusted.select(F.col("doc_id").alias("_id"), F.lit(True).alias("good"))
    marked = (df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(ids), "_id", "left").select("text", "good"))
    sums = (marked.mapInArrow(count, "bucket int, raw long, good long").groupBy("bucket")
            .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))).toPandas()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums["bucket"]], good[sums["bucket"]] = sums["raw"], sums["good"]
    return raw, good


def weights(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Log of trusted over raw probability per bucket; zero if nothing is trusted."""
    if not good.any():
        return np.zeros(BUCKETS)
    share = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return share(good) - share(raw)


def score(text: str, weight: np.ndarray) -> float:
    """The mean weight of a text's n-grams."""
    total = n = 0
    for b in buckets(text):
        total, n = total + float(weight[b].sum()), n + len(b)
    return total / n if n else 0.0


def trusted_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """(doc_id) of trusted labels, the ``most`` whose ids hash lowest if there are more."""
    return (labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def quality_verdicts(spark: SparkSession, df: DataFrame, labels: DataFrame,
                     id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = THRESHOLD):
    """A column function: text to (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score, kept), with the model counted over ``df``."""
    weight = weights(*count_grams(spark, df, trusted_ids(labels), id_col, text_col))

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                  "n_repeat_words long, base_failed boolean, score double, kept boolean")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for text in part:
                counts = base_counts(text)
                failed = (counts[0] < MIN_WORDS
                          or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0])
                s = score(text or "", weight)
                out.append((*counts, failed, s, not failed and s >= threshold))
            yield pd.DataFrame(out, columns=[
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "score", "kept"])

    return judge


def judge_quality(spark: SparkSession, df: DataFrame, labels: DataFrame,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, the counts, base_failed, score, kept."""
    judge = quality_verdicts(spark, df, labels, id_col, text_col)
    return (df.select(F.col(id_col).alias("doc_id"),
                      judge(F.col(text_col).cast("string")).alias("q"))
            .select("doc_id", "q.*"))


def keep_quality(spark: SparkSession, df: DataFrame, labels: DataFrame,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, columns unchanged."""
    judge = quality_verdicts(spark, df, labels, id_col, text_col)
    q = fresh(df, "q")[0]
    return (df.withColumn(q, judge(F.col(text_col).cast("string")))
            .filter(F.col(q)["kept"]).select(*columns(df)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(spark, documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
