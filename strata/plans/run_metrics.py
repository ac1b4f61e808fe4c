"""Stage metrics that outlive their run: a small append-only table beside the layers.

Every stage adds one file, ``<base>/metrics/snapshot_date=<d>/stage=<s>/<run>.json``, written by the
driver in one piece: no two runs share a file or a commit, so dates may run at the same time.
Any later session reads them back; the latest run of a date and stage counts, and a run that
is repeated under its id replaces its own rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import file_system
from strata.sources.scans import NOTHING_THERE, SNAPSHOT_KEY

FOLDER = "metrics"
SCHEMA = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("written_at", T.StringType()),
    T.StructField("step", T.IntegerType()), T.StructField("metric", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField(SNAPSHOT_KEY, T.DateType()), T.StructField("stage", T.StringType())])


def new_run_id() -> str:
    return uuid.uuid4().hex[:16]


def write_metrics(spark: SparkSession, base: str, snapshot: dt.date, stage: str, step: int,
                  values: dict[str, int], run: str, written_at: str | None = None) -> str:
    """Add one stage's metrics (name → whole number); returns the file written."""
    at = written_at or dt.datetime.now(dt.UTC).isoformat(timespec="microseconds")
    path = (f"{base.rstrip('/')}/{FOLDER}/{SNAPSHOT_KEY}={snapshot.isoformat()}/stage={stage}/"
            f"{run}.json")
    lines = [json.dumps({"run": run, "written_at": at, "step": step, "metric": k, "value": int(v)})
             for k, v in values.items()]
    file_system(spark).write_text(path, "\n".join(lines) + "\n")
    return path


def read_metrics(spark: SparkSession, base: str, snapshot: dt.date | None = None,
                 latest: bool = True) -> DataFrame:
    """``snapshot_date, step, stage, run, written_at, metric, value`` of one date or all.

    ``latest`` keeps each date and stage's last run; without it the whole history comes.
    A lake without metrics gives no rows.
    """
    from pyspark.errors import AnalysisException

    path = f"{base.rstrip('/')}/{FOLDER}"
    try:
        rows = spark.read.schema(SCHEMA).json(path)
    except AnalysisException as exc:
        if exc.getCondition() not in NOTHING_THERE:
            raise
        rows = spark.createDataFrame([], SCHEMA)
    if snapshot is not None:
        rows = rows.filter(F.col(SNAPSHOT_KEY) == F.lit(snapshot))
    rows = rows.select(SNAPSHOT_KEY, "step", "stage", "run", "written_at", "metric", "value")
    if not latest:
        return rows
    last = F.max(F.struct("written_at", "run")).over(Window.partitionBy(SNAPSHOT_KEY, "stage"))
    return (rows.withColumn("_last", last)
            .filter(F.struct("written_at", "run") == F.col("_last")).drop("_last"))


def layer_metrics(spark: SparkSession, base: str, snapshot: dt.date) -> DataFrame:
    """``step, layer, rows, prev_rows, removed, reduction_pct`` of a finished run, as
    ``MedallionRun.metrics`` has them, for any session."""
    from strata.operators.quality import with_reduction

    counts = read_metrics(spark, base, snapshot).filter("metric = 'rows' and step >= 0").select(
        "step", F.col("stage").alias("layer"), F.col("value").alias("rows"))
    return with_reduction(counts)
