"""Faults found in review: reruns, raw records, dedup order, scratch folder."""

from types import SimpleNamespace

import pytest

from strata import session
from strata.operators.silver import dedup
from strata.sinks.writes import write_partitioned
from strata.sources.paged import _split_records


def test_page_records_are_kept_as_received():
    lines = '{"a":"x\u2028y"}\n{"b":"z\x85"}\n\n'.encode()
    assert _split_records(lines) == ['{"a":"x\u2028y"}', '{"b":"z\x85"}']
    array = b'[ {"n":12345678901234567.123456789,"m":1E5},\n {"s":"\xc3\xa9",\n"t":[1]} ]'
    assert _split_records(array) == ['{"n":12345678901234567.123456789,"m":1E5}',
                                     '{"s":"\u00e9", "t":[1]}']
    assert _split_records(b"[]") == _split_records(b" \n") == []


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_value_partitioned_overwrite_replaces_the_table(spark, base, mode):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        both = spark.createDataFrame([(1, "CA"), (2, "TX")], "id int, state string")
        write_partitioned(both, base, ["state"])
        write_partitioned(both.filter("state = 'CA'"), base, ["state"])
        assert [tuple(r) for r in spark.read.parquet(base).collect()] == [(1, "CA")]
        write_partitioned(both.filter("state = 'TX'"), base, ["state"], dynamic=True)
        assert spark.read.parquet(base).count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_dedup_ignores_keys_in_the_order(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "k int, v int")
    assert sorted(map(tuple, dedup(df, ["k"], ["k", "v"]).collect())) == [(1, 3), (2, 1)]


def test_a_local_cluster_needs_a_shared_folder():
    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None),
        sparkContext=SimpleNamespace(master="local-cluster[2,1,1024]",
                                     getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        session.checkpoint_root(fake)


DAY = "2026-02-02"


def _records(spark, values):
    return spark.createDataFrame([(v,) for v in values], "record string")


def _layers(spark, base):
    from strata.plans.medallion import DEFAULT_LAYERS

    return {k: sorted(map(str, spark.read.parquet(f"{base}/{p}").collect()))
            for k, p in DEFAULT_LAYERS.items() if k != "quarantine"}


BREWERY = '{"id":"%s","name":"%s","state_province":"CA","brewery_type":"micro","updated_at":"%s"}'


@pytest.mark.parametrize("rerun", [[], ['{"id":"9"}'], ["not json"]])
def test_empty_and_failing_reruns_leave_the_good_layers(spark, base, rerun):
    from strata.plans.medallion import MedallionSpec, run_medallion

    spec = MedallionSpec(on_missing_required="fail")
    run_medallion(spark, _records(spark, [BREWERY % ("1", "Ash", "2024")]), base, DAY, spec)
    before = _layers(spark, base)
    with pytest.raises(ValueError):
        run_medallion(spark, _records(spark, rerun), base, DAY, spec)
    after = _layers(spark, base)
    assert {k: after[k] for k in ("bronze", "silver", "gold")} == {
        k: before[k] for k in ("bronze", "silver", "gold")}
    if not rerun:
        assert after["landing"] == before["landing"]


def test_the_flow_keeps_the_latest_by_default(spark, base):
    from strata.plans.medallion import run_medallion

    run = run_medallion(spark, _records(spark, [BREWERY % ("1", "Zed", "2020"),
                                                BREWERY % ("1", "Ash", "2025")]), base, DAY)
    assert [r["name"] for r in run.read("silver").collect()] == ["Ash"]
    assert run.summary["n_rows"] == 1 and run.summary["total_qty"] == 1


def test_rerun_with_value_partitions_replaces_the_whole_date(spark, base):
    from strata.plans.medallion import MedallionRun, MedallionSpec, run_medallion

    spec = MedallionSpec(silver_partition_by=("state",))
    two = [BREWERY % ("1", "Ash", "2024"), (BREWERY % ("2", "Elm", "2024")).replace("CA", "01")]
    run_medallion(spark, _records(spark, two), base, DAY, spec)
    run = run_medallion(spark, _records(spark, two[1:]), base, DAY, spec)
    assert run.counts["silver"] == 1
    assert [r["state"] for r in run.gold().collect()] == ["01"]
    other = MedallionRun(spark, base, run.snapshot, spec).read("silver")  # another process
    assert other.columns == run.read("silver").columns
    assert [r["state"] for r in other.collect()] == ["01"]


def test_quarantine_counts_violations_and_row_bounds_hold(spark, base):
    from strata.operators.quality import DataQualityError
    from strata.plans.medallion import MedallionSpec, run_medallion

    values = [BREWERY % ("1", "Ash", "2024"), '{"id":"9"}', "not json"]
    spec = MedallionSpec(on_missing_required="quarantine", null_check=("id",))
    run = run_medallion(spark, _records(spark, values), base, DAY, spec)
    assert run.violations == {"missing_required": 1, "malformed": 1}
    assert run.counts["quarantine"] == 2 and run.counts["bronze"] == 1
    with pytest.raises(DataQualityError, match="outside"):
        run_medallion(spark, _records(spark, values[:1]), base, DAY, MedallionSpec(min_rows=2))


def test_retention_and_drop_meet_padded_escaped_and_null_names(spark, base):
    from pyspark.sql import types as T

    from strata.sinks.writes import delete_layer, drop_partitions, retain_snapshots
    from strata.sources.scans import list_snapshots

    df = spark.createDataFrame([(1, "01"), (2, "2"), (3, "2026-02-01 10:00:00"), (4, None)],
                               "id int, k string")
    write_partitioned(df, base, ["k"])
    assert {r["k"] for r in list_snapshots(spark, base, "k").collect()} == {
        "01", "2", "2026-02-01 10:00:00", None}
    assert drop_partitions(spark, base, "k", ["2026-02-01 10:00:00"]) == ["2026-02-01 10:00:00"]
    assert retain_snapshots(spark, base, 2, key="k", key_type=T.IntegerType()) == ["01"]
    assert drop_partitions(spark, base, "k", [None, "7"]) == ["None"]
    assert [r["id"] for r in spark.read.parquet(base).collect()] == [2]
    assert delete_layer(spark, base) and not delete_layer(spark, base)
    assert list_snapshots(spark, base, "k").count() == 0


def test_flat_layer_with_a_schema_and_honest_errors(spark, base, tmp_path):
    from strata.functions.contracts import EmptyInputError
    from strata.sources.scans import read_snapshot

    df = spark.createDataFrame([(1,), (2,)], "id int")
    df.write.parquet(base)
    assert read_snapshot(spark, base, DAY, schema=df.schema).count() == 2
    with pytest.raises(EmptyInputError):
        read_snapshot(spark, f"{base}-none", DAY)
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception) as error:
        read_snapshot(spark, str(broken), DAY)
    assert not isinstance(error.value, EmptyInputError)


def test_pages_after_a_gap_are_read_and_the_gap_reported(spark, tmp_path, base):
    from strata.operators.quality import DataQualityError
    from strata.plans.medallion import MedallionSpec, run_medallion
    from strata.sources.paged import read_pages

    for page in (2, 3, 4, 6, 7, 8):
        folder = tmp_path / "pages" / f"page={page}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(BREWERY % (page, "A sh", "2024"), encoding="utf-8")
    raw = read_pages(spark, path=str(tmp_path / "pages"))
    run = run_medallion(spark, raw, base, DAY)
    assert run.counts["landing"] == 6 and run.pages["missing_pages"] == 2  # pages 1 and 5
    with pytest.raises(DataQualityError, match="pages missing"):
        run_medallion(spark, raw, base, DAY, MedallionSpec(on_missing_required="fail"))


def test_a_url_page_that_comes_back_empty_is_an_error(monkeypatch):
    from strata.sources import paged

    monkeypatch.setattr(paged._HttpPages, "fetch", lambda self, page: [])
    with pytest.raises(RuntimeError, match="page 1 is empty"):
        list(paged.PagedReader({"url": "http://x"}).read(paged.PageRange(1, 1)))


def test_sums_keep_small_values_unless_a_scale_is_given(spark):
    from strata.operators.gold import stats_by

    df = spark.createDataFrame([("a", 0.004), ("a", 0.004)], "k string, v double")
    assert stats_by(df, ["k"], "v").first()["sum_v"] == 0.008
    assert stats_by(df, ["k"], "v", scale=4).first()["sum_v"] == 0.008


def test_distinct_profile_does_not_multiply_rows(spark):
    from strata.operators.quality import distinct_profile

    df = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    out = distinct_profile(df)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert dict(map(tuple, out.collect())) == {"a": 2, "b": 1}


def test_unstage_removes_the_scratch_copy(spark):
    import os

    from strata.sinks.writes import stage, unstage

    staged = stage(spark.range(3).toDF("id"), "gone")
    folder = os.path.dirname(staged.inputFiles()[0].replace("file://", ""))
    assert os.path.isdir(folder)
    unstage(staged)
    assert not os.path.exists(folder)
