"""Backfill of many dates in one plan, the metrics table, Gold rules before publishing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.functions.contracts import EmptyInputError
from strata.operators.quality import DataQualityError
from strata.plans.backfill import run_backfill
from strata.plans.medallion import MedallionRun, MedallionSpec, gold_stage, run_medallion
from strata.plans.run_metrics import layer_metrics, read_metrics, write_metrics
from strata.sources.scans import read_snapshot
from tests.conftest import rows

DAYS = [dt.date(2026, 5, d) for d in (1, 2, 3)]


def record(i, day, **more):
    out = {"id": str(i), "name": f" n{i} ", "state_province": f"s{i % 3}", "brewery_type": "micro",
           "updated_at": f"2026-01-{day:02d}", **more}
    return json.dumps({k: v for k, v in out.items() if v is not None})


def dated(spark, per_day, page=False):
    data = [(DAYS[d], i // 4 + 1, r) for d, recs in enumerate(per_day) for i, r in enumerate(recs)]
    df = spark.createDataFrame(data, "snapshot_date date, page int, record string")
    return df if page else df.drop("page")


def layers(spark, base, spec, names=("landing", "bronze", "silver", "gold")):
    out = {}
    for name in names:
        df = read_snapshot(spark, f"{base}/{spec.layers[name]}", require=False)
        out[name] = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    return out


GOOD = [[record(i % 7, i + 1) for i in range(10)], [record(i, 2) for i in range(6)],
        [record(i % 2, i + 1) for i in range(5)]]


@pytest.mark.parametrize("policy", ["warn", "quarantine"])
def test_dates_in_one_run_equal_single_runs(spark, tmp_path, policy):
    broken = ['{"id": "x"'] if policy == "quarantine" else []
    days = [GOOD[0] + broken + [record(99, 1, name=None)], GOOD[1], GOOD[2]]
    spec = MedallionSpec(on_missing_required=policy)
    names = ("landing", "bronze", "silver", "gold") + (("quarantine",) if policy == "quarantine" else ())
    many, single = str(tmp_path / "many"), str(tmp_path / "single")
    run = run_backfill(spark, dated(spark, days, page=True), many, DAYS, spec)
    assert run.rejected == {}
    for d, day in enumerate(DAYS):
        one = dated(spark, days, page=True).filter(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")
        run_medallion(spark, one, single, day, spec)
    assert layers(spark, many, spec, names) == layers(spark, single, spec, names)
    assert run.accepted == DAYS
    got = {r["snapshot_date"]: (r["accepted"], r["silver"], r["gold"]) for r in run.report().collect()}
    assert got[DAYS[1]] == (True, 6, 3) and got[DAYS[2]][1] == 2
    assert run.run_of(DAYS[1]).read("silver").count() == 6


def test_a_bad_date_keeps_its_snapshots_and_the_others_are_replaced(spark, base):
    spec = MedallionSpec(on_missing_required="fail")
    run_backfill(spark, dated(spark, GOOD), base, DAYS, spec)
    before = layers(spark, base, spec)
    again = [[record(1, 1)], ['{"broken'] + GOOD[1], []]
    run = run_backfill(spark, dated(spark, again), base, DAYS, spec)
    assert run.accepted == [DAYS[0]]
    assert "malformed" in run.rejected[DAYS[1]][0] and "no records" in run.rejected[DAYS[2]][0]
    after = layers(spark, base, spec)
    for name in before:
        days_of = lambda part: [r for r in part if DAYS[0] not in r]
        assert days_of(after[name]) == days_of(before[name])
        assert after[name] != before[name]
    assert read_snapshot(spark, f"{base}/{spec.layers['silver']}", DAYS[0]).count() == 1


def test_gold_rules_and_row_bounds_reject_dates(spark, base):
    no_state = [record(i, 1, state_province=None) for i in range(3)]
    run = run_backfill(spark, dated(spark, [GOOD[0], no_state, GOOD[2][:1]]), base, DAYS,
                       MedallionSpec(min_rows=2))
    assert run.accepted == [DAYS[0]]
    assert "no_null_keys" in run.rejected[DAYS[1]][0] and "rows outside" in run.rejected[DAYS[2]][0]


def test_other_dates_are_left_out_and_value_partitions_replaced(spark, base):
    spec = MedallionSpec(silver_partition_by=("state",))
    run_backfill(spark, dated(spark, GOOD), base, DAYS[:2], spec)
    assert {r[0] for r in rows(read_snapshot(spark, f"{base}/{spec.layers['gold']}"), "snapshot_date")} \
        == set(DAYS[:2])
    run_backfill(spark, dated(spark, [[record(0, 1), record(3, 1)], GOOD[1]]), base, DAYS[:2], spec)
    silver = read_snapshot(spark, f"{base}/{spec.layers['silver']}", DAYS[0])
    assert {r["state"] for r in silver.collect()} == {"s0"}
    with pytest.raises(EmptyInputError):
        run_backfill(spark, dated(spark, GOOD), base, [], spec)


def test_typed_rows_and_a_date_that_clashes(spark, base):
    typed = spark.createDataFrame([(DAYS[0], 1, "a", "s", "t"), (DAYS[1], 1, "b", "s", "t")],
                                  "snapshot_date date, id int, name string, state_province string, "
                                  "brewery_type string")
    run = run_backfill(spark, typed, base, DAYS[:2], MedallionSpec())
    assert run.accepted == DAYS[:2] and run.of(DAYS[0], "bronze")["rows"] == 1
    from strata.functions.contracts import all_strings

    with pytest.raises(ValueError, match="clashes"):
        run_backfill(spark, typed, base, DAYS[:1],
                     MedallionSpec(contract=all_strings(["snapshot_date", "name"])))


def test_failed_gold_rules_leave_the_published_gold(spark, base):
    good = spark.createDataFrame([(r,) for r in GOOD[0]], "record string")
    run_medallion(spark, good, base, DAYS[0])
    spec = MedallionSpec()
    before = rows(spark.read.parquet(f"{base}/{spec.layers['gold']}"))
    bad = spark.createDataFrame([(record(1, 1, state_province=None),)], "record string")
    with pytest.raises(DataQualityError, match="no_null_keys"):
        run_medallion(spark, bad, base, DAYS[0])
    assert rows(spark.read.parquet(f"{base}/{spec.layers['gold']}")) == before


def test_an_empty_silver_leaves_the_date(spark, base):
    good = spark.createDataFrame([(r,) for r in GOOD[0]], "record string")
    run_medallion(spark, good, base, DAYS[0])
    none = MedallionSpec(silver_transforms=(lambda df: df.filter("false"),))
    with pytest.raises(EmptyInputError):
        run_medallion(spark, good, base, DAYS[0], none)
    assert spark.read.parquet(f"{base}/{none.layers['silver']}").count() == 7


def test_metrics_outlive_the_run_and_a_rerun_replaces_them(spark, base):
    source = spark.createDataFrame([(r,) for r in GOOD[0]], "record string")
    run = run_medallion(spark, source, base, DAYS[0])
    want = rows(run.metrics(), "step", "layer", "rows", "removed")
    assert rows(layer_metrics(spark, base, DAYS[0]), "step", "layer", "rows", "removed") == want
    run_medallion(spark, source.limit(1), base, DAYS[0])
    latest = {(r["stage"], r["metric"]): r["value"] for r in read_metrics(spark, base, DAYS[0]).collect()}
    assert latest["silver", "rows"] == 1 and latest["bronze", "malformed"] == 0
    assert latest["quality", "failed_positive_measure"] == 0
    history = read_metrics(spark, base, latest=False).filter("stage = 'silver' and metric = 'rows'")
    assert rows(history, "value") == [(1,), (7,)]
    # the same run id again replaces its own rows
    late = MedallionRun(spark, base, DAYS[0], MedallionSpec(), run_id=run.run_id)
    gold_stage(late)
    assert read_metrics(spark, base, latest=False).filter(
        (F.col("run") == run.run_id) & (F.col("stage") == "gold")).count() == 1
    assert read_metrics(spark, base + "-none").count() == 0


def test_metrics_of_dates_written_at_the_same_time(spark, base):
    from concurrent.futures import ThreadPoolExecutor

    def note(k):
        write_metrics(spark, base, DAYS[k % 3], "silver", 2, {"rows": k}, f"run{k}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(note, range(24)))
    assert sorted(r["value"] for r in read_metrics(spark, base, latest=False).collect()) == list(range(24))
    assert read_metrics(spark, base).count() == 3


def test_command_line_validates_and_prints_metrics(spark, base, capsys):
    from strata.__main__ import main

    run_medallion(spark, spark.createDataFrame([(r,) for r in GOOD[0]], "record string"), base, DAYS[0])
    assert main(["validate", "--base", base, "--date", DAYS[0].isoformat()]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {
        "valid": True, "rows": {"bronze": 10, "silver": 7, "gold": 3}}
    assert main(["metrics", "--base", base]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {"snapshot_date": "2026-05-01", "stage": "gold", "metric": "rows", "value": 3}.items() <= next(
        x for x in lines if x["stage"] == "gold" and x["metric"] == "rows").items()
    gold = f"{base}/gold/breweries_stats/snapshot_date={DAYS[0].isoformat()}"
    short = spark.createDataFrame(spark.read.parquet(gold).limit(1).collect(),
                                  "state string, brewery_type string, qty bigint")
    short.write.mode("overwrite").parquet(gold)
    assert main(["validate", "--base", base, "--date", DAYS[0].isoformat()]) == 1
    assert "gold.qty" in json.loads(capsys.readouterr().out.splitlines()[-1])["reason"]
