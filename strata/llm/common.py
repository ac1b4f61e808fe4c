"""Helpers that the training-data operators share.

A word is ``[^\\x20\\x09-\\x0D]+`` everywhere, which is what ``bytes.split()`` yields on
UTF-8 text. Intermediate tables go to the shared folder that ``spark.checkpoint.dir``
names; a superseded one is deleted at once, the last ones by :meth:`Scratch.close`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A table of so many rows at most, whose texts, bytes and nested values have so many bytes at
#: most in all, is broadcast. Beyond either bound the same join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 1 << 25


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """One given table, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame, names: list[str] | None = None) -> list[Column]:
    """Columns of ``df`` (all unless named), whatever marks their names hold."""
    return [_quoted(c).alias(c) for c in (df.columns if names is None else names)]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z (only) in lower case; the whole-string ``lower`` where text is ASCII."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def slot(key: Column, salt: str, n: int) -> Column:
    """``key`` (as text; null counts as empty) dealt evenly and repeatably over 0..n-1."""
    return F.pmod(F.xxhash64(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), F.lit(n))


class Scratch:
    """Tables of one operator call under the shared scratch folder."""

    #: Lists that take note of new ones; see :func:`noted`.
    watchers: list[list] = []

    def __init__(self, spark: SparkSession, op: str):
        self.spark, self.base, self.paths = spark, scratch_path(spark, op), {}
        for seen in self.watchers:
            seen.append(self)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: cuts lineage, fixes row ids, survives lost executors."""
        path = f"{self.base}/{name}-{len(self.paths)}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a staged table that nothing needs any more."""
        self._delete(self.paths[id(df)][1])

    def close(self) -> None:
        """Delete all tables of this call; only after the results that read them were used."""
        self._delete(self.base)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(
            where, True)


@contextmanager
def noted() -> Iterator[list[Scratch]]:
    """The scratch folders that are opened inside, for whoever uses the results to close."""
    seen: list[Scratch] = []
    Scratch.watchers.append(seen)
    try:
        yield seen
    finally:
        Scratch.watchers.remove(seen)


def with_row_id(scratch: Scratch, df: DataFrame, rid: str) -> DataFrame:
    """``df`` with a row id that holds for every later read, as it is written once."""
    return scratch.stage(df.withColumn(rid, F.monotonically_increasing_id()), "rows")


def _wide_bytes(df: DataFrame) -> int:
    """Bytes of the columns of ``df`` that have no fixed width (nested ones as JSON)."""
    texts_ = [F.octet_length(_quoted(c)) for c, t in df.dtypes if t in ("string", "binary")]
    nested = [F.octet_length(F.to_json(F.struct(_quoted(c)))) for c, t in df.dtypes
              if t.startswith(("struct", "array", "map"))]
    sizes = [F.coalesce(F.sum(n), F.lit(0)) for n in texts_ + nested]
    return sum(df.agg(*sizes).first()) if sizes else 0


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table with a broadcast hint if it has ``rows`` rows and ``BROADCAST_BYTES``
    bytes of varying width at most, else with one for a shuffled join."""
    if df.count() <= rows and _wide_bytes(df) <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df.hint("shuffle_merge")


def texts(batches: Iterator, column: str) -> Iterator:
    """(batch, list of texts) of Arrow batches; a null text is an empty one."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(batch.schema.get_field_index(column))
                      .to_pylist()]
