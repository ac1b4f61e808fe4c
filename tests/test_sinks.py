"""Snapshot writes, partition layouts, round trips and retention."""

import datetime as dt
import os

from pyspark.sql import functions as F

from strata.sinks.writes import (
    drop_partitions, export_csv, path_exists, read_csv, retain_snapshots, stage, write_partitioned,
    write_snapshot, write_snapshots, write_table,
)
from strata.sources.scans import list_snapshots, read_snapshot, read_table, union_all
from tests.conftest import rows

D1, D2 = dt.date(2026, 2, 1), dt.date(2026, 2, 2)


def test_json_roundtrip_exists_delete(spark, base):
    df = spark.createDataFrame([("1", "Brewery A"), ("2", "Brewery B")], "id string, name string")
    write_table(df, base, "json")
    back = read_table(spark, base, "json", "id string, name string")
    assert back.columns == ["id", "name"] and back.count() == 2
    write_partitioned(df.withColumn("snapshot_date", F.lit(D1)), base + "/layer", ["snapshot_date"])
    assert path_exists(spark, base + "/layer/snapshot_date=2026-02-01")
    assert drop_partitions(spark, base + "/layer", "snapshot_date", [D1.isoformat()]) == ["2026-02-01"]
    assert not path_exists(spark, base + "/layer/snapshot_date=2026-02-01")
    assert drop_partitions(spark, base + "/layer", "snapshot_date", [D1.isoformat()]) == []


def test_snapshot_rerun_is_idempotent_and_isolated(spark, base):
    day1 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    day2 = spark.createDataFrame([(3, "c")], "id int, v string")
    assert write_snapshot(day1, base, D1) == 2
    assert write_snapshot(day2, base, D2) == 1
    before = rows(read_snapshot(spark, base))
    assert write_snapshot(day1, base, D1) == 2
    assert rows(read_snapshot(spark, base)) == before
    write_snapshot(day1.filter("id = 1"), base, D1)
    assert rows(read_snapshot(spark, base, D1), "id") == [(1,)]
    assert rows(read_snapshot(spark, base, D2), "id") == [(3,)]
    assert sorted(d for d in os.listdir(base) if "=" in d) == ["snapshot_date=2026-02-01",
                                                               "snapshot_date=2026-02-02"]


def test_empty_rerun_clears_the_date(spark, base):
    df = spark.createDataFrame([(1,)], "id int")
    write_snapshot(df, base, D1)
    write_snapshot(df, base, D2)
    assert write_snapshot(df.filter("id < 0"), base, D1) == 0
    assert rows(list_snapshots(spark, base)) == [(D2,)]


def test_snapshot_column_does_not_replace_created_at(spark, base):
    df = spark.createDataFrame([("1", "2023-01-04T04:46:02Z")], "id string, created_at string")
    write_snapshot(df, base, D1)
    back = read_snapshot(spark, base, D1)
    assert back.first()["created_at"] == "2023-01-04T04:46:02Z"
    assert dict(back.dtypes)["snapshot_date"] == "date"


def test_snapshot_read_prunes_partitions(spark, base):
    df = spark.createDataFrame([(1,)], "id int")
    write_snapshot(df, base, D1)
    write_snapshot(df, base, D2)
    plan = read_snapshot(spark, base, D2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "2026-02-02" in plan


def test_list_snapshots_reads_folder_names_only(spark, base):
    write_snapshot(spark.createDataFrame([(1, "x")], "id int, v string"), base, D1)
    df = list_snapshots(spark, base)
    assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == [(D1,)]


def test_retention_drops_older_partitions(spark, base):
    df = spark.createDataFrame([(1,)], "id int")
    for d in (D1, D2, dt.date(2026, 2, 3)):
        write_snapshot(df, base, d)
    assert retain_snapshots(spark, base, D2) == ["2026-02-01"]
    assert rows(list_snapshots(spark, base)) == [(D2,), (dt.date(2026, 2, 3),)]


def test_partition_by_value_layout(spark, base):
    df = spark.createDataFrame([(i, "CA" if i % 3 else "NY") for i in range(30)], "id int, state string")
    write_partitioned(df, base, ["state"])
    assert sorted(d for d in os.listdir(base) if "=" in d) == ["state=CA", "state=NY"]
    back = spark.read.parquet(base)
    assert back.count() == 30


def test_csv_export_single_file_on_request_only(spark, base):
    df = spark.range(100).withColumn("s", F.lit("a,b"))
    export_csv(df.repartition(4), base + "/one", single_file=True)
    assert len([f for f in os.listdir(base + "/one") if f.endswith(".csv")]) == 1
    export_csv(df.repartition(4), base + "/many")
    assert len([f for f in os.listdir(base + "/many") if f.endswith(".csv")]) == 4
    back = read_table(spark, base + "/one", "csv", "id long, s string", header=True)
    assert rows(back) == rows(df)


def test_stage_cuts_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = stage(df, "test")
    assert rows(staged) == rows(df)
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    out = union_all([a, b])
    assert out.columns == ["id", "a", "b"]
    assert rows(out) == [(1, "x", None), (2, None, "y")]


def test_hot_partition_value_is_split_across_tasks(spark, base):
    """A value holding a third of the rows is written by several tasks, not one."""
    df = spark.range(0, 300_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
        .alias("state"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partitioned(df, base, ["state"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(f"{base}/state=hot") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(base).filter("state = 'hot'").count() == 100_000


def test_backfill_several_dates_in_one_job(spark, base):
    D3 = dt.date(2026, 2, 3)
    for d in (D1, D2, D3):
        write_snapshot(spark.createDataFrame([(0,)], "id int"), base, d)
    redo = spark.createDataFrame([(1, D1), (2, D1), (3, D2)], "id int, snapshot_date date")
    write_snapshots(redo, base)
    assert rows(read_snapshot(spark, base), "snapshot_date", "id") == [
        (D1, 1), (D1, 2), (D2, 3), (D3, 0)]


def test_rewriting_a_snapshot_from_itself(spark, base):
    write_snapshot(spark.createDataFrame([(1,), (2,)], "id int"), base, D1)
    write_snapshot(spark.createDataFrame([(9,)], "id int"), base, D2)
    again = read_snapshot(spark, base, D1).drop("snapshot_date").withColumn("id", F.col("id") * 10)
    assert write_snapshot(again, base, D1) == 2
    assert rows(read_snapshot(spark, base), "snapshot_date", "id") == [(D1, 10), (D1, 20), (D2, 9)]


def test_snapshot_read_tolerates_an_unpartitioned_layer(spark, base):
    write_table(spark.createDataFrame([(1,), (2,)], "id int"), base)
    back = read_snapshot(spark, base, D1)
    assert rows(back) == [(1, D1), (2, D1)]


def test_arrow_file_system_fallback(base, tmp_path):
    from strata.sources.files import ArrowFS

    d = tmp_path / "layer" / "snapshot_date=2026-02-01"
    d.mkdir(parents=True)
    (d / "part-0.parquet").write_bytes(b"x")
    fs = ArrowFS()
    assert fs.exists(str(d)) and fs.exists(f"file:{d}")
    fs.delete(str(d))
    assert not fs.exists(str(d))


def test_csv_round_trip_keeps_whole_texts(spark, base):
    """Commas, quotes and line breaks survive (read back with multiLine)."""
    texts = ['plain', 'a, b', 'say "hi"', 'line 1\nline 2', '', None, 'tab\tand \\ slash',
             ' outer ', '"', 'end \\"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    export_csv(df, base + "/texts", single_file=True)
    assert dict(rows(read_csv(spark, base + "/texts", "id long, text string"))) == dict(
        enumerate(texts))
