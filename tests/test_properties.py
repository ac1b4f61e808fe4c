"""Property tests from the test plan: invariants that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.gold import count_by
from strata.operators.silver import clean_columns, dedup
from strata.sinks.writes import write_partitioned
from tests.conftest import rows

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])
text = st.one_of(st.none(), st.text(alphabet=" \tabAB", max_size=5))


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                               st.sampled_from(["CA", "NY", None]),
                               st.sampled_from(["micro", "nano"])), max_size=40))
def test_gold_total_equals_non_null_ids(spark, data):
    df = spark.createDataFrame(data, "id int, state string, brewery_type string")
    gold = count_by(df)
    total = gold.agg(F.sum("qty")).first()[0] or 0
    assert total == sum(1 for r in data if r[0] is not None)
    assert gold.count() == len({(r[1], r[2]) for r in data})


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(text, text), max_size=20))
def test_trim_is_idempotent_and_spaces_only(spark, data):
    df = spark.createDataFrame(data, "a string, b string")
    once = clean_columns(df, trim=["a", "b"])
    twice = clean_columns(once, trim=["a", "b"])
    assert rows(once) == rows(twice)
    expected = sorted(((None if a is None else a.strip(" "), None if b is None else b.strip(" "))
                       for a, b in data), key=repr)
    assert rows(once) == expected


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=30))
def test_dedup_output_keys_are_unique_and_complete(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    out = dedup(df, ["k"], ["v"])
    keys = [r["k"] for r in out.collect()]
    assert len(keys) == len(set(keys)) == len({k for k, _ in data})


def test_partition_values_edge_cases(spark, tmp_path):
    """'' and null land in the default partition and read back null; '01' keeps its text
    when the partition column is read with an explicit string type."""
    base = str(tmp_path / "by_state")
    df = spark.createDataFrame([(1, "CA"), (2, ""), (3, None), (4, "01"), (5, "\tCA ")],
                               "id int, state string")
    write_partitioned(df, base, ["state"])
    back = spark.read.schema("id int, state string").parquet(base)
    assert rows(back) == sorted([(1, "CA"), (2, None), (3, None), (4, "01"), (5, "\tCA ")], key=repr)
    inferred = spark.read.parquet(base)
    assert dict(inferred.dtypes)["state"] == "string"  # '\tCA ' keeps inference on string


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)),
                     max_size=40))
def test_dedup_report_matches_brute_force(spark, data):
    from strata.operators.silver import dedup_report

    df = spark.createDataFrame(data, "k int, l int")
    r = dedup_report(df, ["k", "l"]).first()
    keys = {}
    for row in data:
        keys[row] = keys.get(row, 0) + 1
    assert (r["n_in"], r["n_out"], r["removed"], r["dup_keys"]) == (
        len(data), len(keys), len(data) - len(keys), sum(1 for n in keys.values() if n > 1))


@settings(**SETTINGS)
@given(facts=st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b"]),
                                st.decimals(min_value=-100, max_value=100, places=2)),
                      max_size=40))
def test_join_then_group_paths_agree(spark, facts):
    from strata.operators.enrich import enrich_and_aggregate, enrich_and_aggregate_plain

    fact = spark.createDataFrame([(k, s, float(v)) for k, s, v in facts], "key int, seg string, v double")
    dim = spark.createDataFrame([(k, f"n{k % 3}") for k in range(5)], "key int, name string")
    broadcast = rows(enrich_and_aggregate(fact, dim, "key", ["seg"], ["name"], value="v", scale=2))
    shuffled = rows(enrich_and_aggregate(fact, dim, "key", ["seg"], ["name"], value="v", scale=2,
                                         max_broadcast_rows=1))
    plain = rows(enrich_and_aggregate_plain(fact, dim, "key", ["seg"], ["name"], value="v", scale=2))
    assert broadcast == shuffled == plain
    expected = {}
    for k, s, v in facts:
        if k < 5:
            n, total = expected.get((f"n{k % 3}", s), (0, 0))
            expected[(f"n{k % 3}", s)] = (n + 1, total + v)
    assert {(a, b): (n, t) for a, b, n, t in plain} == {
        key: (n, float(t)) for key, (n, t) in expected.items()}


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), text), max_size=30))
def test_null_profile_and_rules_match_python(spark, data):
    from strata.operators.quality import Rule, check, null_profile

    df = spark.createDataFrame(data, "a int, b string")
    assert rows(null_profile(df)) == [("a", sum(r[0] is None for r in data)),
                                      ("b", sum(r[1] is None for r in data))]
    report = {r["rule"]: r["failed"] for r in check(
        df, [Rule("neg", F.col("a") < 0), Rule("blank", F.trim("b") == "")],
        min_rows=1).collect()}
    assert report == {"row_count": int(len(data) < 1),
                      "neg": sum(1 for a, _ in data if a is not None and a < 0),
                      "blank": sum(1 for _, b in data if b is not None and b.strip(" ") == "")}


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(writes=st.lists(st.tuples(st.sampled_from([1, 2, 3]),
                                 st.lists(st.integers(0, 9), max_size=4)), min_size=1, max_size=4))
def test_snapshot_writes_behave_like_a_dict_of_dates(spark, tmp_path_factory, writes):
    """Any sequence of per-date writes (including empty ones) leaves exactly the last
    write of each date, and never touches another date."""
    import datetime as dt

    from strata.sinks.writes import write_snapshot
    from strata.sources.scans import read_snapshot

    base = str(tmp_path_factory.mktemp("snap") / "layer")
    model = {}
    for day, ids in writes:
        date = dt.date(2026, 2, day)
        write_snapshot(spark.createDataFrame([(i,) for i in ids], "id int"), base, date)
        if ids:
            model[date] = sorted(ids)
        else:
            model.pop(date, None)
    expected = sorted((d, i) for d, ids in model.items() for i in ids)
    if not expected:
        return
    got = rows(read_snapshot(spark, base, require=False), "snapshot_date", "id")
    assert got == expected


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.sampled_from(["CA", "NY", "TX", None]),
                               st.sampled_from(["micro", "nano"]), st.integers(0, 5)),
                     unique_by=lambda t: (t[0], t[1]), max_size=8),
       n=st.integers(1, 5))
def test_top_n_equals_sorted_slice(spark, data, n):
    from strata.operators.gold import gold_top_n

    df = spark.createDataFrame(data, "state string, brewery_type string, qty long")
    got = [tuple(r) for r in gold_top_n(df, n).collect()]
    order = sorted(data, key=lambda t: (-t[2], t[0] is not None, t[0] or "", t[1]))
    assert got == [tuple(t) for t in order[:n]]
