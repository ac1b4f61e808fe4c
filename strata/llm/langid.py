"""Language identification by a bit-sliced Bloom filter over character n-grams.

Training counts the 3- and 4-grams of each language over a bounded sample of rows
(``SAMPLE`` rows per language by a hash of the id; texts are never cut). A language's filter
holds its ``PROFILE`` most frequent n-grams at most, of those that are about as frequent
in it as in any language. All filters share their slots: a slot is a bit mask with one bit
per language, so ``HASHES`` lookups, joined by AND, return all languages that (seem to) hold
an n-gram. Per language, the set bits are counted over a document's n-grams and corrected
for the filter's rate of false positives; the largest corrected count decides, ties go to
the first language in code point order. The score is its part of all corrected counts.

A null text, or one without letters, is ``und`` with score 0. A text with letters but no
known n-gram gets the most frequent language of the sample, score 0. Null languages and
null ids teach nothing; with no language to learn, all rows are ``und``. Ids, languages
and sources are never inputs of a prediction. Long texts are read in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, documents, slot, texts

GRAMS, HASHES, SLOTS_PER_GRAM = (3, 4), 3, 16
SAMPLE, PROFILE, MIN_COUNT, NEAR = 5_000, 1 << 15, 3, 0.5
_DEALT = 1 << 62
UNKNOWN = "und"
_BLOCK, _HELD = 1 << 18, 1 << 22
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text's letters, all else being one separator, block by block."""
    letter, text = _is_letter(), text.lower()
    for at in range(0, len(text), _BLOCK):
        raw = text[max(at - 3, 0):at + _BLOCK].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, np.uint32)
        known = letter[codes]
        keep = known.copy()
        keep[1:] |= known[:-1]
        c = np.where(known, codes, 32)[keep].astype(np.uint64)
        for n in GRAMS:
            if len(c) < n:
                continue
            h = np.full(len(c) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ (h >> np.uint64(31))) * _MIX[0] + c[k:len(c) - n + 1 + k]
            yield h * _MIX[1]


def _slots(h: np.ndarray, k: int, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0] + np.uint64(k * int(_MIX[1]) % 2**64)
    return ((h ^ (h >> np.uint64(29))) * _MIX[1]) >> np.uint64(64 - bits)


class Filters:
    """The bit-sliced filters of some languages; ``profiles``: language -> n-gram hashes."""

    def __init__(self, profiles: dict[str, np.ndarray], fallback: str | None = None):
        self.languages = sorted(profiles)
        self.fallback = fallback
        most = max((len(p) for p in profiles.values()), default=1)
        self.bits = max(10, int(np.ceil(np.log2(SLOTS_PER_GRAM * max(most, 1)))))
        planes = -(-len(self.languages) // 8) or 1
        self.masks = np.zeros((planes, 1 << self.bits), np.uint8)
        for i, name in enumerate(self.languages):
            for k in range(HASHES):
                self.masks[i // 8, _slots(profiles[name], k, self.bits)] |= np.uint8(1 << i % 8)
        fill = np.array([(self.masks[i // 8] >> np.uint8(i % 8) & 1).mean()
                         for i in range(len(self.languages))])
        self.false = fill ** HASHES

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """Set bits per language over the text's n-grams, and the number of n-grams."""
        hits, n = np.zeros((len(self.masks), 256), np.int64), 0
        for h in grams(text):
            at = [_slots(h, k, self.bits) for k in range(HASHES)]
            n += len(h)
            for plane, table in zip(hits, self.masks):
                mask = table[at[0]]
                for a in at[1:]:
                    mask = mask & table[a]
                plane += np.bincount(mask, minlength=256)
        values = np.arange(256)
        return np.array([int(hits[i // 8][values >> (i % 8) & 1 == 1].sum())
                         for i in range(len(self.languages))]), n

    def predict(self, text: str | None) -> tuple[str, float]:
        import regex

        if not self.languages or not text or not regex.search(r"\p{L}", text):
            return UNKNOWN, 0.0
        hits, n = self.counts(text)
        real = np.maximum((hits - self.false * n) / np.maximum(1 - self.false, 1e-9), 0.0)
        if not real.sum() > 0:
            return self.fallback or self.languages[0], 0.0
        best = int(real.argmax())
        return self.languages[best], float(real[best] / real.sum())


def held_out(id_: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2; false for a null id (which teaches nothing)."""
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def _share(n: int, sample: int) -> int:
    """Of ``_DEALT`` slots, those whose rows are about ``sample`` of ``n``; never none."""
    return min(_DEALT, max(1, _DEALT * sample // n))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Filters:
    """Filters of the languages of the rows that are not held out."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Filters({})
    share = F.create_map(*[F.lit(x) for k, n in sizes.items()
                           for x in (k, _share(n, sample))])

    def count(batches):
        found, held = {}, 0  # language -> arrays of n-grams, at most about _HELD in all

        def counted_so_far():
            for lang, hashes in found.items():
                own, times = np.unique(np.concatenate(hashes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own)), pa.array(own.view(np.int64)),
                     pa.array(times)], names=["lang", "gram", "n"])
            found.clear()

        for batch, bodies in texts(batches, "text"):
            for text, lang in zip(bodies, batch.column(1).to_pylist()):
                for hashes in grams(text):
                    found.setdefault(lang, []).append(hashes)
                    held += len(hashes)
                    if held >= _HELD:
                        yield from counted_so_far()
                        held = 0
        yield from counted_so_far()

    picked = rows.filter(slot(F.col("doc_id"), "langid", _DEALT) < share[F.col("lang")])
    scratch = Scratch(df.sparkSession, "langid")
    counted = scratch.stage(
        picked.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
        .groupBy("gram", "lang").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["t"] for r in
              counted.groupBy("lang").agg(F.sum("n").alias("t")).collect()}
    if not totals:
        return Filters({k: np.zeros(0, np.uint64) for k in sizes}, max(sorted(sizes),
                                                                       key=sizes.get))
    rate = F.col("n") / F.create_map(*[F.lit(x) for kv in totals.items() for x in kv])[
        F.col("lang")]
    typical = (counted.withColumn("rate", rate).groupBy("gram")
               .agg(F.max("rate").alias("top"), F.collect_list(F.struct("lang", "n", "rate"))
                    .alias("langs"))
               .select("gram", "top", F.explode("langs").alias("l"))
               .filter((F.col("l.rate") >= NEAR * F.col("top")) & (F.col("l.n") >= MIN_COUNT))
               .select("gram", F.col("l.lang").alias("lang"), F.col("l.n").alias("n")))
    profiles = {}
    for lang in sorted(sizes):  # a bounded profile each, whatever the input
        top = (typical.filter(F.col("lang") == lang).orderBy(F.desc("n"), "gram")
               .limit(PROFILE).select("gram").toPandas())
        profiles[lang] = top["gram"].to_numpy(np.int64).view(np.uint64)
    scratch.close()
    return Filters(profiles, max(sorted(sizes), key=sizes.get))


def identify(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", filters: Filters | None = None) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, lang_pred, score."""
    model = filters or train(df, id_col, text_col, lang_col)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang_pred", "score"])

    return (df.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                      predict(F.col(text_col).cast("string")).alias("p"))
            .select("doc_id", "held_out", "p.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, documents(spark, sf_dir))
