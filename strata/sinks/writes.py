"""Idempotent, partition-aware writes."""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import checkpoint_root, scratch_path
from strata.sources.files import file_system as _fs
from strata.sources.files import partition_folders, partition_value
from strata.sources.scans import SNAPSHOT_KEY, default_key_type


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), **options) -> None:
    """Format-generic write; ``partition_by`` columns become directories."""
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet",
                      mode: str = "overwrite", dynamic: bool = False, rebalance: bool = True,
                      **options) -> None:
    """Value-partitioned write without a small-file explosion or a hot-key task.

    A ``REBALANCE`` on the partition columns groups each value's rows into few
    tasks (few files per directory); adaptive execution splits a value that
    holds a large share of the rows across several tasks instead of one.
    ``dynamic`` replaces only the partitions present in ``df``, otherwise an overwrite
    replaces the whole table, whatever the session's overwrite mode is. Pass
    ``rebalance=False`` when every row has the same value (a snapshot): each
    task then writes its own file and nothing is shuffled.
    """
    options = {**options, "partitionOverwriteMode": "dynamic" if dynamic else "static"}
    out = df.hint("rebalance", *by) if rebalance else df
    write_table(out, path, fmt, mode, by, **options)


def snapshot_day(snapshot) -> dt.date:
    """The date that a snapshot is named by: a date, an instant's date, or ISO text."""
    if isinstance(snapshot, dt.datetime):
        return snapshot.date()
    if isinstance(snapshot, dt.date):
        return snapshot
    return dt.date.fromisoformat(str(snapshot))


#: Stores where moving a folder copies its objects, one by one, from the driver.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "oss", "cosn", "obs", "wasb", "wasbs", "r2")


def _replaced(base: str, key: str, day: dt.date) -> str:
    return f"{base}/_replaced-{key}={day.isoformat()}-"


def _publish(fs, staged: str, base: str, key: str, day: dt.date) -> None:
    """Put the folder ``staged`` in the place of the date's, which waits under a name that says
    what it is; a crash in between is mended by ``recover_snapshots`` or the date's next write."""
    target, old = f"{base}/{key}={day.isoformat()}", None
    if fs.exists(target):
        old = _replaced(base, key, day) + uuid.uuid4().hex[:12]
        fs.rename(target, old)
    try:
        fs.rename(staged, target)
    except Exception:
        if old is not None:
            fs.rename(old, target)
        raise
    if old is not None:
        fs.delete(old)


def recover_snapshots(spark: SparkSession, base: str, key: str = SNAPSHOT_KEY,
                      snapshot=None) -> list[str]:
    """Finish or undo publishing that a crash cut short; returns the dates put back.

    A date whose old rows were set aside, but not replaced, gets them back; where the new
    rows are in place, the old ones go. Run it when no write to these dates is under way.
    """
    fs, base, restored = _fs(spark), base.rstrip("/"), []
    day = "" if snapshot is None else snapshot_day(snapshot).isoformat()
    for name in fs.folders(base):
        found = re.fullmatch(rf"_replaced-{re.escape(key)}=(\d{{4}}-\d\d-\d\d)-\w+", name)
        if not found or (day and found[1] != day):
            continue
        target = f"{base}/{key}={found[1]}"
        if fs.exists(target):
            fs.delete(f"{base}/{name}")
        else:
            fs.rename(f"{base}/{name}", target)
            restored.append(found[1])
    return sorted(restored)


def _overwrite_date(spark: SparkSession, staged: DataFrame, base: str, key: str, day: dt.date,
                    fmt: str, partition_by: Sequence[str], options: dict) -> None:
    """Write checked rows over one date through Spark's committer; no folder is moved here."""
    fs, folder = _fs(spark), f"{base}/{key}={day.isoformat()}"
    before = _leaves(fs, folder, len(partition_by))
    out = staged.withColumn(key, F.lit(day))
    out = out.hint("rebalance", *partition_by) if partition_by else out
    write_table(out, base, fmt, "overwrite", [key, *partition_by],
                **{**options, "partitionOverwriteMode": "dynamic"})
    if before:  # dynamic overwrite leaves value partitions that the date no longer has
        names = [f"v{i}" for i in range(len(partition_by))]
        olds = spark.createDataFrame(before, ", ".join(f"{n} string" for n in [*names, "path"]))
        now = staged.select(*[F.col(f"`{c}`").cast("string").alias(f"w{i}")
                              for i, c in enumerate(partition_by)]).distinct()
        same = F.lit(True)
        for i, n in enumerate(names):
            same = same & F.col(n).eqNullSafe(F.col(f"w{i}"))
        gone = olds.join(now, same, "left_anti")
        _delete_all(fs, [r["path"] for r in gone.collect()])


def _leaves(fs, folder: str, depth: int, values: tuple = ()) -> list[tuple]:
    """(value, …, path) of the value partitions ``depth`` levels below a date."""
    if depth == len(values):
        return [(*values, folder)] if values else []
    return [leaf for name in fs.folders(folder) if "=" in name and name[0] not in "_."
            for leaf in _leaves(fs, f"{folder}/{name}", depth, (*values, partition_value(name)))]


def write_snapshot(df: DataFrame, base: str, snapshot, key: str = SNAPSHOT_KEY,
                   fmt: str = "parquet", metrics: Observation | None = None,
                   partition_by: Sequence[str] = (), on_empty: str = "clear",
                   check: Callable[[DataFrame, int], None] | None = None,
                   publish: str = "auto", **options) -> int:
    """Write ``df`` as the ``key=snapshot`` partition of ``base``; idempotent per date.

    The rows are staged first. When that is complete, and ``check(written rows, count)`` has
    not raised, they replace the whole date, value partitions it no longer has included;
    every other date stays, and a failed write or check leaves the old snapshot as it was. So
    ``df`` may itself read the snapshot it replaces. The row count is observed during the write
    (no second job). An empty result removes the date (``on_empty="clear"``) or leaves it
    as it is (``"keep"``). ``partition_by`` adds value partitions below the date
    (``key=<date>/<col>=<value>``); rows are then rebalanced on those columns so each
    value gets few files and a hot value is split. Returns the number of rows written.

    ``publish="move"`` stages in a hidden folder of ``base`` and moves that folder into place
    (no second write: right where moving is a change of names). ``"overwrite"`` stages in the
    shared scratch folder and lets the executors write the checked rows by Spark's committer,
    as a dynamic overwrite of this one date: right on object stores, where a move copies
    every object from the driver. ``"auto"`` decides by the scheme of ``base``.
    """
    if on_empty not in ("clear", "keep"):
        raise ValueError(f"on_empty is 'clear' or 'keep', not {on_empty!r}")
    if publish not in ("auto", "move", "overwrite"):
        raise ValueError(f"publish is 'auto', 'move' or 'overwrite', not {publish!r}")
    spark, base, day = df.sparkSession, base.rstrip("/"), snapshot_day(snapshot)
    if publish == "auto":
        publish = "overwrite" if base.partition(":")[0] in OBJECT_STORES else "move"
    obs, fs = metrics or Observation(), _fs(spark)
    hidden = (f"{base}/_staged-{uuid.uuid4().hex[:12]}" if publish == "move"
              else scratch_path(spark, "snapshot"))
    staged = f"{hidden}/rows"
    out = df.drop(key)
    schema = out.schema
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if publish == "move" and partition_by:
        out = out.hint("rebalance", *partition_by)
    by = partition_by if publish == "move" else ()
    try:
        write_table(out, staged, fmt, "error", by, **options)
        rows = int(obs.get.get("rows", 0))
        written = spark.read.format(fmt).schema(schema).load(staged)
        if check is not None:
            check(written, rows)
        recover_snapshots(spark, base, key, day)
        target = f"{base}/{key}={day.isoformat()}"
        if rows and publish == "move":
            _publish(fs, staged, base, key, day)
        elif rows:
            _overwrite_date(spark, written, base, key, day, fmt, partition_by, options)
        elif on_empty == "clear" and fs.exists(target):
            fs.delete(target)
    finally:
        if fs.exists(hidden):
            fs.delete(hidden)
    return rows


def write_snapshots(df: DataFrame, base: str, key: str = SNAPSHOT_KEY, fmt: str = "parquet",
                    **options) -> None:
    """Backfill: write every date present in ``df[key]`` in ONE job.

    Dynamic overwrite replaces exactly those dates; dates absent from ``df`` are
    untouched. Rows are rebalanced by date so each date gets a few files, and
    AQE splits a date that holds most of the rows.
    """
    write_partitioned(df, base, [key], fmt, "overwrite", dynamic=True, **options)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a layer or partition directory exists."""
    return _fs(spark).exists(path)


def delete_layer(spark: SparkSession, base: str) -> bool:
    """Delete a whole layer (every snapshot of it); False when there was none."""
    fs = _fs(spark)
    if not fs.exists(base):
        return False
    fs.delete(base)
    return True


#: Deletions under way at once, and attempts at each.
DELETERS, DELETE_TRIES = 16, 3


def _delete_all(fs, paths: Sequence[str]) -> None:
    """Delete folders side by side; every one is tried, and those left are named in the error."""
    def delete(path: str) -> Exception | None:
        for attempt in range(DELETE_TRIES):
            try:
                fs.delete(path)
                return None
            except Exception as exc:  # noqa: BLE001 - reported below, once all were tried
                failure = exc
                time.sleep(0.1 * 2 ** attempt)
        return failure

    if not paths:
        return
    with ThreadPoolExecutor(min(DELETERS, len(paths))) as pool:
        left = [(p, e) for p, e in zip(paths, pool.map(delete, paths)) if e is not None]
    if left:
        raise OSError(f"{len(left)} of {len(paths)} folders were not deleted: "
                      + "; ".join(f"{p} ({e})" for p, e in left[:10])) from left[0][1]


def drop_partitions(spark: SparkSession, base: str, key: str, values: Iterable) -> list[str]:
    """Delete the ``key=value`` folders of ``base``, side by side; return the values dropped.

    Values are compared with the unescaped folder names, as text (dates in ISO form;
    None is the null partition); a value without a folder is not in the result. If some
    cannot be deleted after ``DELETE_TRIES`` attempts, the others are, and an ``OSError`` names them.
    """
    fs = _fs(spark)
    wanted = {None if v is None else str(v) for v in values}
    found = [(p, v) for p, v in partition_folders(fs, base, key) if v in wanted]
    _delete_all(fs, [p for p, _ in found])
    return [str(v) for _, v in found]


def retain_snapshots(spark: SparkSession, base: str, keep_from, key: str = SNAPSHOT_KEY,
                     fmt: str = "parquet", key_type: T.DataType | None = None) -> list[str]:
    """Drop every partition whose value is below ``keep_from``; return the dropped values.

    Folder names are listed and compared as ``key_type``; the very folders found are
    deleted, side by side, so zero-padded and escaped names are met. Null partitions stay.
    Failures are reported as by ``drop_partitions``.
    """
    fs = _fs(spark)
    found = partition_folders(fs, base, key)
    if not found:
        return []
    as_type = key_type or default_key_type(key)
    names = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(found)], "i int, v string")
    old = sorted(r["i"] for r in
                 names.filter(F.col("v").cast(as_type) < F.lit(keep_from)).collect())
    _delete_all(fs, [found[i][0] for i in old])
    return [found[i][1] for i in old]


#: What CSV export and import agree on: null has a mark of its own, so '' and null stay
#: apart, quotes are doubled, and outer spaces and line breaks inside a text are kept.
CSV_OPTIONS = {"nullValue": "\\N", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False,
               mode: str = "overwrite", **options) -> None:
    """CSV export with ``CSV_OPTIONS`` (``options`` override them); ``read_csv`` reads it back.

    ``single_file`` is the caller's explicit request for one file, whatever the size: the
    rows are computed in parallel and one task writes them all. Leave it off for large data.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode(mode).options(**{**CSV_OPTIONS, "header": header, **options}).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             **options) -> DataFrame:
    """A CSV folder as ``export_csv`` writes it: line breaks, '' and null come back as they were.

    With ``multiLine`` a file is read by one task, so export large data to many files.
    """
    return (spark.read.schema(schema)
            .options(**{**CSV_OPTIONS, "header": header, "multiLine": True, **options}).csv(path))


def stage(df: DataFrame, name: str = "stage", fmt: str = "parquet") -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage (later failures recompute from the staged files, not from
    the source) and survives executor loss because the files sit on shared
    storage. ``unstage`` deletes them once the results that read them are written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)


def unstage(staged: DataFrame) -> None:
    """Delete the scratch folder behind a ``stage`` result; nothing may read it afterwards."""
    spark = staged.sparkSession
    root = f"{checkpoint_root(spark)}/strata-scratch/"
    folders = {f.rpartition("/")[0] for f in staged.inputFiles()}
    for folder in folders:
        if "/strata-scratch/" in folder and folder.rpartition("/strata-scratch/")[2]:
            _fs(spark).delete(root + folder.rpartition("/strata-scratch/")[2])
