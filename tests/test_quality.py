"""One-pass quality rules, profiles and reconciliation."""

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import (
    DataQualityError, Rule, assert_row_bounds, check, check_gold, describe_stats,
    distinct_profile, enforce, gold_summary, null_profile, null_total, reconcile, row_bounds,
    untrimmed_profile,
)
from tests.conftest import rows


@pytest.fixture()
def gold(spark):
    return spark.createDataFrame([("CA", "micro", 2), ("NY", "micro", 2), ("NY", "nano", 1)],
                                 "state string, brewery_type string, qty bigint")


def test_gold_checks_pass(gold):
    report = check_gold(gold)
    assert {r["rule"]: r["passed"] for r in report.collect()} == {
        "required_columns": True, "row_count": True, "no_null_keys": True,
        "positive_measure": True}
    enforce(report)


def test_gold_checks_fail(spark):
    bad = spark.createDataFrame([("CA", None, 0)], "state string, brewery_type string, qty bigint")
    with pytest.raises(DataQualityError, match="no_null_keys.*positive_measure"):
        enforce(check_gold(bad))
    empty = spark.createDataFrame([], "state string, brewery_type string, qty bigint")
    with pytest.raises(DataQualityError, match="row_count"):
        enforce(check_gold(empty))
    missing = spark.createDataFrame([("CA",)], "state string")
    with pytest.raises(DataQualityError, match=r"required_columns failed \(2\)"):
        enforce(check_gold(missing))


def test_warn_rules_do_not_raise(spark, gold):
    report = check(gold, [Rule("small", F.col("qty") < 2, severity="warn")])
    rows_ = enforce(report)
    assert [r["failed"] for r in rows_] == [1]


def test_summary(gold):
    r = gold_summary(gold).first()
    assert (r["n_rows"], r["distinct_state"], r["distinct_brewery_type"], r["total_qty"]) == (3, 2, 2, 5)


def test_null_profile_counts_only_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, None), (4, "b")], "a int, b string")
    assert rows(null_profile(df)) == [("a", 2), ("b", 2)]
    assert null_total(df, ["a", "b"]) == 4
    with pytest.raises(DataQualityError):
        null_total(df, ["a"], severity="error")


def test_distinct_profiles(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "a int, b string")
    assert rows(distinct_profile(df)) == [("a", 2), ("b", 2)]
    assert rows(distinct_profile(df, exact=False)) == [("a", 2), ("b", 2)]


def test_row_bounds_zero_max_is_a_bound(spark):
    df = spark.createDataFrame([("1",)], "id string")
    assert assert_row_bounds(df, 1, 10) == 1
    assert row_bounds(df, 1, 0).first()["passed"] is False
    with pytest.raises(DataQualityError):
        assert_row_bounds(df, 2)


def test_describe_and_trim_profile(spark):
    df = spark.createDataFrame([(1.0, " a"), (2.0, "b"), (4.0, "c ")], "x double, s string")
    r = describe_stats(df, ["x"]).first()
    assert (r["count"], r["min"], r["max"], r["mean"]) == (3, 1.0, 4.0, round(7 / 3, 4))
    assert r["stddev"] == pytest.approx(1.5275, abs=1e-4)
    assert rows(untrimmed_profile(df, ["s"])) == [("s", 2)]


def test_reconcile(spark):
    a = spark.range(10)
    b = spark.range(4)
    c = spark.range(0)
    got = [tuple(r) for r in reconcile([("bronze", a), ("silver", b), ("gold", c)]).orderBy("step").collect()]
    assert got == [(0, "bronze", 10, None, None, None), (1, "silver", 4, 10, 6, 60.0),
                   (2, "gold", 0, 4, 4, 100.0)]
    zero = [tuple(r) for r in reconcile([("a", c), ("b", c)]).orderBy("step").collect()]
    assert zero[1][-1] == 0.0
