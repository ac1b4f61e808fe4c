"""Smaller helpers: layout inspection, metadata, stats with nulls, guards."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.contracts import EmptyInputError, all_strings
from strata.operators.bronze import add_ingest_metadata, normalize_strings
from strata.operators.gold import stats_by
from strata.operators.layout import bucket_skew, key_skew, partition_sizes
from strata.operators.silver import clean_columns, dedup_window
from strata.sources.scans import union_all
from tests.conftest import rows


def test_partition_sizes_cover_all_rows(spark):
    df = spark.range(0, 1000, 1, 4)
    sizes = partition_sizes(df).collect()
    assert sum(r["n_rows"] for r in sizes) == 1000
    assert abs(sum(r["share"] for r in sizes) - 1.0) < 1e-12
    assert len(sizes) == 4


def test_key_skew_shares(spark):
    df = spark.createDataFrame([(k,) for k in [0, 0, 0, 1, 2, 3]], "k long")
    got = {r["bucket"]: (r["n_rows"], r["share"]) for r in key_skew(df, "k", 2).collect()}
    assert got == {0: (4, 4 / 6), 1: (2, 2 / 6)}
    assert rows(bucket_skew(df, F.col("k") > 0, "positive"), "positive", "n_rows") == [
        (False, 3), (True, 3)]


def test_dedup_window_null_keys_collapse(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 5)], "k int, v int")
    assert rows(dedup_window(df, ["k"], ["v"], keep="last")) == [(1, 5), (None, 2)]
    assert rows(dedup_window(df, ["k"], ["v"], keep="first")) == [(1, 5), (None, 1)]


def test_stats_ignore_nulls(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", None), ("a", 2.5), ("b", None)], "k string, x double")
    got = {r["k"]: (r["n"], r["sum_x"], r["avg_x"], r["min_x"]) for r in stats_by(df, ["k"], "x").collect()}
    assert got["a"] == (2, 4.0, 2.0, 1.5)
    assert got["b"] == (0, None, None, None)


def test_run_timestamp_from_datetime_and_default(spark):
    df = spark.range(1)
    r = add_ingest_metadata(df, dt.datetime(2026, 2, 2, 13, 45, 1, 500)).first()
    assert r["ingested_at"] == dt.datetime(2026, 2, 2, 13, 45, 1, 500)
    assert r["ingested_date"] == dt.date(2026, 2, 2)
    now = add_ingest_metadata(df).first()
    assert isinstance(now["ingested_at"], dt.datetime) and now["ingested_date"] is not None


def test_normalize_with_contract_and_without(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "a int, b double, c string")
    assert normalize_strings(df).dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    out = normalize_strings(df, all_strings(["b", "z"]))
    assert out.columns == ["b", "z"] and tuple(out.first()) == ("2.0", None)


def test_union_all_needs_input_and_clean_columns_renames(spark):
    with pytest.raises(EmptyInputError):
        union_all([])
    df = spark.createDataFrame([(" a ", "x")], "s string, t string")
    out = clean_columns(df, trim=["s"], rename={"s": "state"}, keep=["s"])
    assert out.columns == ["state"] and out.first()["state"] == "a"


def test_operators_take_columns_of_any_name(spark):
    from strata.operators import gold, quality
    from strata.operators.enrich import fits_broadcast
    from strata.operators.layout import hot_keys, key_skew
    from strata.operators.silver import clean, dedup, dedup_report, dedup_window
    from strata.operators.sketches import distinct_sketches
    from strata.operators.summary import quantile_sketches, summarize
    from strata.sources.scans import union_all

    df = spark.createDataFrame([("x", 1, 2.5, None), ("x", 2, 1.5, "v"), ("y", 3, 0.5, " v")],
                               "`k.k` string, `n``n` int, `v v` double, `t.t` string")
    got = {r["column_name"]: r["null_count"] for r in quality.null_profile(df).collect()}
    assert got == {"k.k": 0, "n`n": 0, "v v": 0, "t.t": 1}
    assert {r["distinct_count"] for r in quality.distinct_profile(df, ["k.k"]).collect()} == {2}
    assert quality.distinct_profile(df, ["k.k"], exact=False).first()["distinct_count"] == 2
    assert quality.describe_stats(df, ["v v"], scale=1).first()["max"] == 2.5
    assert quality.untrimmed_profile(df, ["t.t"]).first()["untrimmed"] == 1
    for one in (dedup(df, ["k.k"], ["n`n"]), dedup_window(df, ["k.k"], ["n`n"])):
        assert one.columns == df.columns and sorted(r["n`n"] for r in one.collect()) == [2, 3]
    assert dedup_report(df, ["k.k"]).first()["removed"] == 1
    assert gold.count_by(df, ["k.k"], "n`n").collect()[0]["qty"] == 2
    assert gold.count_non_null_keys(df, ["t.t"]).count() == 2
    assert gold.stats_by(df, ["k.k"], "v v").count() == 2
    assert gold.point_lookup(df, **{"t.t": "v"}).count() == 1
    assert fits_broadcast(df) and clean(df, [("t.t", "a.b", True)]).columns == ["a.b"]
    assert hot_keys(df, ["k.k", "t.t"], 0.3).count() == 3 and key_skew(df, "k.k", 4).count() >= 1
    assert distinct_sketches(df).count() == 4 and summarize(df, exact=True).count() == 4
    assert quantile_sketches(df, ["v v"], by=["k.k"]).count() == 2
    assert union_all([df, df.drop("t.t")], widen=True).columns == df.columns
