"""The corpus pipeline: five stages over ``documents``, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read back as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns packed sequences. Every stage works on whatever its
predecessor kept: null columns, empty or long texts, repeated rows, extra columns and
empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact, mixing, packing, quality, simhash
from strata.llm.common import Scratch, documents, noted

#: Scratch folders by (sf_dir, stage). A stage's result has been written when the next one
#: begins, which then closes them (unless its ``docs`` still read them).
_open: dict[tuple[str, int], list[Scratch]] = {}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.keep_quality(spark, docs, documents(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact.drop_exact_duplicates(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: zero to two times."""
    return mixing.mix(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's documents as pieces in sequences of at most 4096 tokens."""
    return packing.pack(spark, docs)


def _stage(k: int, operator):
    """``operator`` as stage ``k``, which first closes the scratch of the stage before."""

    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _open.pop((sf_dir, k - 1), [])
        files = docs.inputFiles() if before else []
        for scratch in before:
            if not any(scratch.base.rpartition("/")[2] in f for f in files):
                scratch.close()
        with noted() as made:
            out = operator(spark, docs, sf_dir)
        _open.setdefault((sf_dir, k), []).extend(made)
        return out

    stage.__doc__ = operator.__doc__
    return stage


STAGES = [(name, _stage(k, f)) for k, (name, f) in enumerate([
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
])]

#: Likelihood ratios, XXH64 fingerprints, seeded draws and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
