"""Layer validation by bucket checksums."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import validate
from strata.operators.quality import DataQualityError
from strata.operators.validate import Layer
from tests.conftest import rows

SCHEMA = "k string, g int, v string, x double"


def good_rows(n=400, seed=1):
    rnd = random.Random(seed)
    return [(f"k{i}", rnd.choice([1, 2, None]), rnd.choice(["a", "b", None, ""]),
             rnd.choice([0.5, None, float("nan"), -1.0])) for i in range(n)]


def report(layer, **kw):
    return {r["column_name"]: r for r in validate.validate_layers([layer], **kw).collect()}


def test_equal_layers_do_not_drift_whatever_their_order(spark):
    data = good_rows()
    shuffled = data[:]
    random.Random(2).shuffle(shuffled)
    got = report(Layer("silver", spark.createDataFrame(shuffled, SCHEMA).repartition(7), ["k"],
                       expected=spark.createDataFrame(data, SCHEMA).coalesce(1)))
    assert {r["buckets_differ"] for r in got.values()} == {0}
    assert {r["rows"] for r in got.values()} == {400}
    assert got["g"]["nulls"] == sum(r[1] is None for r in data)


@pytest.mark.parametrize("change,columns", [
    (lambda d: d[:-1], {"k", "g", "v", "x"}),                       # a row is lost
    (lambda d: d + [d[5]], {"k", "g", "v", "x"}),                   # a row is repeated
    (lambda d: d + [d[5], d[5]], {"k", "g", "v", "x"}),             # twice: nothing cancels out
    (lambda d: [("k0", d[0][1], "changed", d[0][3])] + d[1:], {"v"}),
    (lambda d: [(d[0][0], d[0][1], d[0][2], 7.25)] + d[1:], {"x"}),
])
def test_each_fault_is_found_in_its_columns(spark, change, columns):
    data = good_rows()
    layer = Layer("silver", spark.createDataFrame(change(data), SCHEMA), ["k"],
                  expected=spark.createDataFrame(data, SCHEMA))
    got = report(layer)
    assert {c for c, r in got.items() if r["buckets_differ"]} == columns
    drifted = validate.drifted_buckets(layer).collect()
    assert len(drifted) == 1 and set(drifted[0]["columns"]) == columns
    diff = validate.drifted_rows(layer).collect()
    want = Counter(map(repr, change(data)))
    want.subtract(map(repr, data))
    got = {repr(tuple(r)[:4]): r["surplus"] for r in diff}
    assert got == {k: n for k, n in want.items() if n}


def test_swapped_values_and_moved_nulls_are_found(spark):
    schema = "k string, a string, b string"
    good = [("1", "x", "y"), ("2", "p", "q"), ("3", None, "n")]
    swapped = [("1", "p", "y"), ("2", "x", "q"), ("3", "n", None)]
    got = report(Layer("l", spark.createDataFrame(swapped, schema), ["k"],
                       expected=spark.createDataFrame(good, schema)), buckets=1)
    assert got["a"]["buckets_differ"] == 1 and got["b"]["buckets_differ"] == 1
    assert got["k"]["buckets_differ"] == 0


def test_types_may_differ_between_layers_and_null_keys_count(spark):
    good = spark.createDataFrame([(1, 2.5), (None, 1.0), (None, 1.0)], "k long, v double")
    text = good.select(F.col("k").cast("string"), F.col("v").cast("string"))
    assert {r["buckets_differ"] for r in report(
        Layer("l", text, ["k"], expected=good)).values()} == {0}
    fewer = text.filter("k is not null").unionByName(text.filter("k is null").limit(1))
    layer = Layer("l", fewer, ["k"], expected=good)
    assert report(layer)["v"]["buckets_differ"] == 1
    assert [tuple(r) for r in validate.drifted_rows(layer).collect()] == [(None, "1.0", -1)]


def test_report_names_absent_columns_and_layers_in_order(spark):
    bronze = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    silver = bronze.select("id")
    out = validate.validate_layers([
        Layer("bronze", bronze, ["id"], ["id", "name", "extra"]),
        Layer("silver", silver, ["id"], ["id"], bronze)])
    assert rows(out, "step", "layer", "column_name", "present", "rows", "nulls",
                "buckets_differ") == sorted([
        (0, "bronze", "id", True, 2, 0, None), (0, "bronze", "name", True, 2, 1, None),
        (0, "bronze", "extra", False, 2, None, None), (1, "silver", "id", True, 2, 0, 0),
        (1, "silver", "name", False, 2, None, None)], key=repr)
    with pytest.raises(DataQualityError, match="bronze.extra: absent; silver.name: absent"):
        validate.enforce_layers(out)
    with pytest.raises(ValueError):
        validate.drifted_buckets(Layer("x", bronze, ["id"]))
    with pytest.raises(ValueError):
        validate.validate_layers([])


def test_empty_layers_and_odd_column_names(spark):
    none = spark.createDataFrame([], "`a.b` int, `c``d` string")
    some = spark.createDataFrame([(1, "x")], "`a.b` int, `c``d` string")
    assert {r["rows"] for r in report(Layer("l", none, ["a.b"], expected=none)).values()} == {0}
    layer = Layer("l", none, ["a.b"], expected=some)
    assert {r["buckets_differ"] for r in report(layer).values()} == {1}
    assert [tuple(r) for r in validate.drifted_rows(layer).collect()] == [(1, "x", -1)]
    with pytest.raises(DataQualityError, match="l: empty"):
        validate.enforce_layers(validate.validate_layers([layer]))


def test_sides_are_reduced_before_the_shuffle(spark):
    """Few keys, many rows: each side shuffles its buckets, not its rows."""
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    layer = Layer("l", df, ["k"], expected=df)
    plan = validate.drifted_buckets(layer, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 3
    assert validate.drifted_buckets(layer, 16).count() == 0


def test_a_finished_run_validates_its_layers(spark, base):
    from strata.plans.medallion import MedallionRun, MedallionSpec, run_medallion

    source = spark.createDataFrame([
        (f'{{"id": "{i % 9}", "name": " n{i} ", "state_province": "s{i % 2}", '
         f'"brewery_type": "t", "updated_at": "2026-01-{i + 1:02d}"}}',) for i in range(20)],
        "record string")
    run = run_medallion(spark, source, base, "2026-02-02")
    assert validate.enforce_layers(run.validate())
    # another session finds a layer that was tampered with
    path = run.path("silver") + "/snapshot_date=2026-02-02"
    late = MedallionRun(spark, base, dt.date(2026, 2, 2), MedallionSpec())
    whole = spark.read.parquet(path)
    bad = spark.createDataFrame(whole.withColumn("city", F.lit("x")).collect(), whole.schema)
    bad.write.mode("overwrite").parquet(path)
    found = {(r["layer"], r["column_name"]) for r in late.validate().collect() if r["buckets_differ"]}
    assert found == {("silver", "city")}
