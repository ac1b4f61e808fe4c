"""Type merging, scoped caches, publishing without moves, recovery and deletion."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.contracts import SchemaMismatchError
from strata.functions.merge_types import common_schema, common_type, widen
from strata.operators.reuse import cached, write_all
from strata.sinks import writes
from strata.sinks.writes import drop_partitions, recover_snapshots, retain_snapshots, write_snapshot
from strata.sources.scans import read_snapshot, union_all
from tests.conftest import rows

D1, D2 = dt.date(2026, 2, 2), dt.date(2026, 2, 3)


def parse(ddl):
    return T._parse_datatype_string(ddl)


@pytest.mark.parametrize("a,b,want", [
    ("tinyint", "smallint", "smallint"), ("int", "bigint", "bigint"), ("int", "void", "int"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(30,4)", "decimal(30,4)"),
    ("bigint", "decimal(38,20)", "string"), ("decimal(5,2)", "decimal(8,4)", "decimal(8,4)"),
    ("int", "double", "double"), ("int", "float", "double"), ("float", "double", "double"),
    ("bigint", "double", "string"), ("decimal(10,2)", "double", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", "string"),
    ("boolean", "int", "string"), ("int", "string", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "int", "string"),
    ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>")])
def test_common_type_is_symmetric_and_keeps_every_value(spark, a, b, want):
    x, y = parse(a), parse(b)
    for got in (common_type(x, y), common_type(y, x)):
        assert got.simpleString() == parse(want).simpleString()
    assert common_type(x, common_type(x, y)) == common_type(x, y)


def test_union_of_int_double_and_text_versions_of_a_column(spark):
    frames = [spark.createDataFrame([(1, 2 ** 31 - 1)], "id int, v int"),
              spark.createDataFrame([(2, 0.1)], "id bigint, v double"),
              spark.createDataFrame([("x3", "text")], "id string, v string"),
              spark.createDataFrame([(Decimal("4.50"),)], "id decimal(6,2)")]
    out = union_all(frames[:2], widen=True)
    assert out.schema.simpleString() == "struct<id:bigint,v:double>"
    assert rows(out) == [(1, 2147483647.0), (2, 0.1)]
    out = union_all(frames, widen=True)
    assert rows(out, "id", "v") == [("1", "2147483647"), ("2", "0.1"), ("4.50", None), ("x3", "text")]


def test_nested_values_merge_by_field_and_element(spark):
    a = spark.sql("select named_struct('x', 1, 'l', array(1, 2)) s, map('k', 1) m, array(1) t")
    b = spark.sql("select named_struct('l', array(3L), 'y', 'q') s, map('k', 1.5D) m, 'plain' t")
    out = union_all([a, b], widen=True)
    assert out.schema.simpleString() == ("struct<s:struct<x:int,l:array<bigint>,y:string>,"
                                         "m:map<string,double>,t:string>")
    got = [r.asDict(True) for r in out.collect()]
    assert got[0] == {"s": {"x": 1, "l": [1, 2], "y": None}, "m": {"k": 1.0}, "t": "[1]"}
    assert got[1] == {"s": {"x": None, "l": [3], "y": "q"}, "m": {"k": 1.5}, "t": "plain"}
    none = widen(a.select(F.lit(None).cast(a.schema["s"].dataType).alias("s")), out.schema)
    assert none.first()["s"] is None
    with pytest.raises(SchemaMismatchError):
        common_schema([parse("a int"), parse("A int")])


def test_cache_is_used_inside_and_given_back(spark):
    df = spark.range(1000).withColumn("x", F.rand(1))
    persisted = spark.sparkContext._jsc.getPersistentRDDs
    before = persisted().size()
    with cached(df, eager=True) as held:
        assert "InMemoryTableScan" in held.filter("x > 0.5")._jdf.queryExecution().executedPlan().toString()
        assert persisted().size() == before + 1
    assert persisted().size() == before and not df.is_cached
    with pytest.raises(RuntimeError, match="boom"):
        with cached(df):
            raise RuntimeError("boom")
    assert persisted().size() == before and not df.is_cached
    df.persist()
    with cached(df):
        pass
    assert df.is_cached  # someone else's cache stays
    df.unpersist(True)


def test_write_all_computes_an_intermediate_once(spark, base):
    runs = spark.sparkContext.accumulator(0)

    def tag(batches):
        runs.add(1)
        yield from batches

    df = spark.range(10).coalesce(1).mapInArrow(tag, "id long")
    out = write_all(df, [lambda d: d.write.parquet(f"{base}/a"), lambda d: d.write.parquet(f"{base}/b"),
                         lambda d: d.count()])
    assert out == [None, None, 10] and runs.value == 1
    assert spark.read.parquet(f"{base}/b").count() == 10


# --- publishing --------------------------------------------------------------

def version(spark, n, segments="AB"):
    return spark.createDataFrame([(i, segments[i % len(segments)], i * i) for i in range(n)],
                                 "id int, seg string, v int")


@pytest.mark.parametrize("by", [(), ("seg",), ("seg", "id")])
def test_overwrite_publishes_like_a_move(spark, tmp_path, by):
    lakes = {}
    for mode in ("move", "overwrite"):
        base = str(tmp_path / mode)
        write_snapshot(version(spark, 6), base, D2, partition_by=by, publish=mode)
        for df in (version(spark, 5, "ABC"), version(spark, 2, "CD")):
            n = write_snapshot(df, base, D1, partition_by=by, publish=mode)
        again = read_snapshot(spark, base, D1, schema=version(spark, 0).schema)  # reads what it replaces
        write_snapshot(again.withColumn("id", F.col("id") + 1), base, D1, partition_by=by, publish=mode)
        lakes[mode] = (n, rows(read_snapshot(spark, base, schema=version(spark, 0).schema),
                               "snapshot_date", "id", "seg"))
    assert lakes["move"] == lakes["overwrite"]
    assert len([r for r in lakes["move"][1] if r[0] == D1]) == 2


@pytest.mark.parametrize("mode", ["move", "overwrite"])
def test_a_failed_check_or_empty_result_leaves_the_date(spark, base, mode):
    write_snapshot(version(spark, 3), base, D1, publish=mode)

    def refuse(df, n):
        assert df.count() == n == 1
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        write_snapshot(version(spark, 1), base, D1, publish=mode, check=refuse)
    assert write_snapshot(version(spark, 0), base, D1, publish=mode, on_empty="keep") == 0
    assert read_snapshot(spark, base, D1).count() == 3
    write_snapshot(version(spark, 0), base, D1, publish=mode)
    assert not writes.path_exists(spark, f"{base}/snapshot_date=2026-02-02")


class Crash(BaseException):
    """A process that dies: nothing of the code after it runs."""


@pytest.mark.parametrize("step", [1, 2, 3])
def test_a_crash_while_publishing_leaves_the_old_or_the_new_rows(spark, base, monkeypatch, step):
    write_snapshot(version(spark, 3), base, D1)
    real, calls = writes._fs, []

    class Dying:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if calls and calls[-1] == "dead":
                    raise Crash()
                if name in ("rename", "delete") and "_staged" in args[0] + args[-1] or "_replaced" in args[-1]:
                    if name != "exists":
                        calls.append(name)
                if len(calls) == step and name in ("rename", "delete"):
                    calls.append("dead")
                    raise Crash()
                return getattr(self.fs, name)(*args)
            return call

    monkeypatch.setattr(writes, "_fs", lambda spark: Dying(real(spark)))
    with pytest.raises(Crash):
        write_snapshot(version(spark, 5), base, D1)
    monkeypatch.setattr(writes, "_fs", real)
    recover_snapshots(spark, base)
    assert read_snapshot(spark, base, D1).count() in (3, 5)
    assert not [n for n in real(spark).folders(base) if n.startswith("_replaced")]
    write_snapshot(version(spark, 7), base, D1)
    assert read_snapshot(spark, base, D1).count() == 7


def test_a_lost_date_is_put_back_by_its_next_write_or_by_hand(spark, base):
    write_snapshot(version(spark, 3), base, D1)
    fs = writes._fs(spark)
    aside = writes._replaced(base, "snapshot_date", D1) + "abc"
    fs.rename(f"{base}/snapshot_date=2026-02-02", aside)
    assert write_snapshot(version(spark, 0), base, D1, on_empty="keep") == 0
    assert read_snapshot(spark, base, D1).count() == 3
    fs.rename(f"{base}/snapshot_date=2026-02-02", aside)
    assert recover_snapshots(spark, base) == ["2026-02-02"]
    assert recover_snapshots(spark, base) == []


def test_deletions_try_every_folder_and_name_those_left(spark, base, monkeypatch):
    for d in (1, 2, 3, 4):
        write_snapshot(version(spark, 1), base, dt.date(2026, 1, d))
    real = writes._fs(spark)

    class Stuck:
        tries = []

        def __getattr__(self, name):
            return getattr(real, name)

        def delete(self, path):
            self.tries.append(path)
            if path.endswith("02"):
                raise OSError("stuck")
            if path.endswith("01") and self.tries.count(path) == 1:
                raise OSError("once")
            real.delete(path)

    monkeypatch.setattr(writes, "_fs", lambda spark: Stuck())
    with pytest.raises(OSError, match="1 of 3 folders.*2026-01-02.*stuck"):
        retain_snapshots(spark, base, dt.date(2026, 1, 4))
    monkeypatch.undo()
    assert {str(r[0]) for r in rows(read_snapshot(spark, base), "snapshot_date")} == {"2026-01-02", "2026-01-04"}
    assert drop_partitions(spark, base, "snapshot_date", ["2026-01-02", "2020-01-01"]) == ["2026-01-02"]
