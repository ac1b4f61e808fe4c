"""Hot keys, quantiles and distinct counts from mergeable sketches."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import sketches, summary
from strata.operators.layout import hot_keys, key_sketch, key_skew
from tests.conftest import rows

D = [dt.date(2026, 1, d) for d in (1, 2, 3)]


def keyed(n=4000, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.random()
        text = "hot" if k < 0.3 else None if k < 0.4 else "1:a" if k < 0.46 else f"cold{i}"
        out.append((text, rnd.choice([1, 1, 1, 2]), i % 3))
    return out


@pytest.mark.parametrize("keys,share", [(["k"], 0.05), (["k", "g"], 0.04), (["g"], 0.5)])
def test_hot_keys_are_all_and_only_those_with_the_share(spark, keys, share):
    data = keyed()
    df = spark.createDataFrame(data, "k string, g int, day int").repartition(6)
    at = ["k", "g"].index
    count = Counter(tuple(r[at(c)] for c in keys) for r in data)
    want = sorted(((*k, n, n / len(data)) for k, n in count.items() if n / len(data) >= share), key=repr)
    assert rows(hot_keys(df, keys, share), *keys, "n_rows", "share") == want and want


def test_hot_keys_from_stored_sketches_and_their_buckets(spark):
    df = spark.createDataFrame(keyed(), "k string, g int, day int")
    made = key_sketch(df, ["k"], 0.05, by=["day"])
    assert made.count() == 3
    assert rows(hot_keys(df, ["k"], 0.05, sketches=made)) == rows(hot_keys(df, ["k"], 0.05))
    # the bucket that skews is the one of its hot key
    inside = {r["k"]: r["bucket"] for r in hot_keys(df, ["k"], 0.05, buckets=64).collect()}
    worst = max(key_skew(df, ["k"], 64).collect(), key=lambda r: r["n_rows"])
    assert worst["bucket"] == inside["hot"]


def test_hot_keys_edges_and_plan(spark):
    df = spark.createDataFrame(keyed(), "k string, g int, day int")
    assert hot_keys(df.filter("false"), ["k"]).count() == 0
    with pytest.raises(ValueError):
        hot_keys(df, ["k"], 0)
    # the packed key keeps parts apart: ("1", "2:x") is not ("12", ":x")
    odd = spark.createDataFrame([("1", "2:x"), ("12", ":x"), ("1", "2:x"), (None, "-")], "a string, b string")
    assert rows(hot_keys(odd, ["a", "b"], 0.5), "a", "b", "n_rows") == [("1", "2:x", 2)]
    plan = hot_keys(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("LeftSemi") > plan.index("Aggregate [k")


def test_key_skew_of_any_type_sums_to_one(spark):
    df = spark.createDataFrame(keyed(), "k string, g int, day int")
    for key in ("k", "g", ["k", "g"]):
        got = key_skew(df, key, 8).collect()
        assert sum(r["n_rows"] for r in got) == 4000 and abs(sum(r["share"] for r in got) - 1) < 1e-9
    plan = key_skew(df, "g", 8)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


# --- quantiles ---------------------------------------------------------------

def disc(values, q):
    a = sorted(values)
    from fractions import Fraction
    return float(a[max(1, math.ceil(Fraction(str(q)) * len(a))) - 1]) if a else None


def number_rows(n=6000, seed=8):
    rnd = random.Random(seed)
    return [(rnd.gauss(0, 1), rnd.choice([0, 5, 5, 5, 7]), rnd.choice([None, -(2.0 ** rnd.randrange(40))]),
             rnd.choice([None, "b", "a", "é"])) for _ in range(n)]


@pytest.mark.parametrize("k,counted", [(8, 3), (64, 50), (1024, 100_000)])
def test_exact_quantiles_match_a_sort_at_any_sketch_size(spark, k, counted):
    data = number_rows()
    df = spark.createDataFrame(data, "x double, dup int, w double, t string").repartition(5)
    quantiles = (0.0, 0.001, 0.1, 0.5, 0.75, 0.999, 1.0)
    got = summary.exact_quantiles(df, ["x", "dup", "w"], quantiles, k=k, counted=counted)
    for i, c in enumerate(["x", "dup", "w"]):
        values = [r[i] for r in data if r[i] is not None]
        assert {q: got[c, q] for q in quantiles} == {q: disc(values, q) for q in quantiles}


def test_summary_of_numbers_texts_and_empty_columns(spark):
    data = number_rows(500)
    df = spark.createDataFrame(data, "x double, dup int, w double, t string").withColumn(
        "none", F.lit(None).cast("long")).withColumn("d", F.lit(dt.date(2026, 1, 2))).withColumn(
        "a.b", F.col("dup"))
    got = {r["column_name"]: r for r in summary.summarize(df, exact=True).collect()}
    assert got["t"]["min_text"] == "a" and got["t"]["max_text"] == "é" and got["t"]["q50"] is None
    assert got["t"]["nulls"] == sum(r[3] is None for r in data)
    assert got["none"]["count"] == 0 and got["none"]["nulls"] == 500 and got["none"]["q25"] is None
    assert got["dup"]["q50"] == disc([r[1] for r in data], 0.5) == got["a.b"]["q50"]
    assert got["d"]["min_text"] == "2026-01-02"
    assert got["dup"]["mean"] == pytest.approx(sum(r[1] for r in data) / 500, abs=1e-4)
    empty = {r["column_name"]: r for r in summary.summarize(df.filter("false"), exact=True).collect()}
    assert empty["x"]["count"] == 0 and empty["x"]["q50"] is None


def test_sketched_quantiles_and_merged_days_keep_the_rank_error(spark):
    data = number_rows(20_000)
    df = spark.createDataFrame([(*r, i % 4) for i, r in enumerate(data)],
                               "x double, dup int, w double, t string, day int")
    error = 2 * summary.rank_error(256)
    whole = summary.summarize(df, ["x", "w"], k=256).collect()
    days = summary.merged_quantiles(summary.quantile_sketches(df, ["x", "w"], ["day"], k=256)).collect()
    for r in [*whole, *days]:
        for q in summary.QUARTILES:
            below, upto = summary.rank_bounds(df, r["column_name"], r[f"q{q * 100:g}"])
            assert below <= q + error and upto >= q - error
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "x double")
    row = summary.summarize(nan, exact=True).first()
    assert (row["count"], row["nulls"], row["q50"]) == (3, 1, 1.0)


# --- distinct counts over snapshots ------------------------------------------

def test_merged_distinct_counts_rescan_nothing(spark, base):
    def day(a, b):
        return spark.range(a, b).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "even").alias("g"))

    for snapshot, (a, b) in zip(D, ((0, 3000), (2000, 5000), (4000, 9000))):
        sketches.write_distinct_sketches(day(a, b), base, snapshot)
    got = {r["column_name"]: r for r in sketches.merged_distinct(spark, base).collect()}
    assert abs(got["k"]["distinct_estimate"] - 9000) <= 9000 * sketches.relative_error()
    assert (got["k"]["snapshots"], got["k"]["rows"], got["g"]["non_null"], got["g"]["distinct_estimate"]) \
        == (3, 11000, 5500, 1)
    two = {r["column_name"]: r for r in sketches.merged_distinct(spark, base, D[0], D[1]).collect()}
    assert abs(two["k"]["distinct_estimate"] - 5000) <= 5000 * sketches.relative_error()
    # a rerun of a date replaces its sketch, and types may drift over time
    sketches.write_distinct_sketches(day(0, 10).withColumn("k", F.col("k").cast("string")), base, D[2])
    again = {r["column_name"]: r for r in sketches.merged_distinct(spark, base).collect()}
    assert abs(again["k"]["distinct_estimate"] - 5000) <= 5000 * sketches.relative_error()
    plan = sketches.merged_distinct(spark, base, D[1])
    files = plan.inputFiles()
    assert files and all(f"{base}/" in f.replace("file://", "") for f in files)
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan._jdf.queryExecution().toString()


def test_sketches_of_empty_snapshots(spark, base):
    sketches.write_distinct_sketches(spark.range(0).toDF("k"), base, D[0])
    row = sketches.merged_distinct(spark, base).first()
    assert (row["rows"], row["non_null"], row["distinct_estimate"]) == (0, 0, 0)
