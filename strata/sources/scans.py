"""Table and snapshot scans with explicit schemas and partition pruning."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.contracts import EmptyInputError
from strata.functions.merge_types import widen_all
from strata.sources.files import file_system, partition_folders

SNAPSHOT_KEY = "snapshot_date"
#: Texts of dates and whole numbers that no other text of the same value has.
PLAIN_VALUE = r"\d{4}-\d\d-\d\d|0|-?[1-9]\d{0,17}"
#: Spark's names of the errors that mean "no such path" or "no file in it".
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Format-generic read; pass ``schema`` to skip inference (always for JSON/CSV)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      multiline: bool = False) -> DataFrame:
    """JSON lines (or one JSON array per file with ``multiline``) under a contract."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def _partition_literal(value) -> F.Column:
    if isinstance(value, dt.datetime):
        return F.lit(value.date())
    return F.lit(value)


def read_snapshot(spark: SparkSession, base: str, snapshot=None, key: str = SNAPSHOT_KEY,
                  fmt: str = "parquet", schema: T.StructType | None = None,
                  key_type: T.DataType = T.DateType(), require: bool = True) -> DataFrame:
    """Read one snapshot (or all with ``snapshot=None``) of a partitioned layer.

    The layer base is scanned with ``key`` as a typed partition column and the
    snapshot is a filter on it, so Spark prunes every other directory
    (``PartitionFilters`` in the plan) instead of the caller building paths.
    ``schema`` is the written schema without the key (value-partition columns
    below the date included); passing it avoids partition type inference. A base whose
    folders hold no ``key=value`` level is read whole, as that snapshot, with or without a
    schema. With ``require`` a missing or empty snapshot raises ``EmptyInputError``; any
    other read error (corrupt file, access denied) is raised as it is.
    """
    layered = bool(partition_folders(file_system(spark), base, key))
    reader = spark.read.format(fmt).option("basePath", base)
    if schema is not None:
        own = [T.StructField(key, key_type)] if layered else []
        reader = reader.schema(T.StructType(list(schema.fields) + own))
    try:
        df = reader.load(base)
    except AnalysisException as exc:
        if require and exc.getCondition() in NOTHING_THERE:
            raise EmptyInputError(f"{base} is empty or missing: {exc}") from exc
        raise
    if snapshot is not None:
        value = _partition_literal(snapshot).cast(key_type)
        df = df.filter(F.col(key) == value) if layered else df.withColumn(key, value)
    if require and df.isEmpty():
        raise EmptyInputError(f"{base} snapshot {snapshot} is empty")
    return df


def default_key_type(key: str) -> T.DataType:
    """The type of a partition key that the caller does not name: snapshots are dates."""
    return T.DateType() if key == SNAPSHOT_KEY else T.StringType()


def list_snapshots(spark: SparkSession, base: str, key: str = SNAPSHOT_KEY, fmt: str = "parquet",
                   key_type: T.DataType | None = None) -> DataFrame:
    """Distinct partition values of a layer, from its folder names alone.

    No file is opened and no row is read, whatever the layer's size. Values are cast to
    ``key_type`` (the snapshot key is a date, other keys are text unless it says else).
    """
    import pyarrow as pa

    found = sorted({v for _, v in partition_folders(file_system(spark), base, key)},
                   key=lambda v: (v is None, v))
    as_type = key_type or default_key_type(key)
    # an Arrow table of this size becomes a literal relation: no task runs to make it
    names = spark.createDataFrame(pa.table([pa.array(found, pa.string())], names=[key]))
    values = names.select(F.col(key).cast(as_type).alias(key))
    plain = isinstance(as_type, T.StringType) or all(
        v is None or re.fullmatch(PLAIN_VALUE, v) for v in found)
    return values if plain else values.distinct()  # 1 and 01 may be one value


def union_all(frames, allow_missing: bool = True, widen: bool = False) -> DataFrame:
    """Stack separately read pages by column name; absent columns become null.

    Column order follows the first frame, then columns first seen later. With ``widen`` a
    column whose type drifts from page to page takes the narrowest type that keeps every
    value (``strata.functions.merge_types``); without it Spark's own coercion decides.
    """
    frames = list(frames)
    if not frames:
        raise EmptyInputError("union_all needs at least one DataFrame")
    if widen:
        frames = widen_all(frames)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=allow_missing)
    return out
