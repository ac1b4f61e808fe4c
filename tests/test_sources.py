"""The paged record source (S1, S2, S7; F1 fixtures)."""

import json
import os

import pytest

from strata.functions.contracts import BRONZE_CONTRACT
from strata.plans.catalog import q_src_paged
from strata.sinks.writes import write_partitioned
from strata.sources.paged import (
    _split_records, discover_page_count, pack_pages, page_report, read_paged, read_pages,
)


def write_pages(root, pages, as_array=True):
    for i, recs in enumerate(pages, start=1):
        if not recs:
            continue
        d = os.path.join(root, f"page={i}")
        os.makedirs(d)
        with open(os.path.join(d, "data.json"), "w") as f:
            if as_array:
                json.dump(recs, f)
            else:
                f.write("\n".join(json.dumps(r) for r in recs))


def test_success(spark, tmp_path):
    root = str(tmp_path / "api")
    write_pages(root, [[{"id": 1, "name": "Brewery 1", "state": "CA"},
                        {"id": 2, "name": "Brewery 2", "state": "NY"}], []])
    df = read_paged(spark, BRONZE_CONTRACT, path=root)
    got = sorted((r["id"], r["name"]) for r in df.collect())
    assert got == [("1", "Brewery 1"), ("2", "Brewery 2")]
    assert df.columns == ["page", *BRONZE_CONTRACT.fieldNames(), "_corrupt_record"]
    assert df.filter("_corrupt_record is not null").count() == 0


def test_pagination_stops_at_first_empty_page(spark, tmp_path):
    root = str(tmp_path / "api")
    write_pages(root, [[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}], [{"id": 3, "name": "c"}]],
                as_array=False)
    df = read_paged(spark, BRONZE_CONTRACT, path=root, pages_per_partition=1)
    assert sorted(r["id"] for r in df.collect()) == ["1", "2", "3"]
    assert sorted({r["page"] for r in df.collect()}) == [1, 2]


def test_error_propagates(spark):
    with pytest.raises(Exception):
        read_pages(spark, pages=1).collect()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100, 1025])
def test_discover_page_count(n):
    calls = []

    def fetch(p):
        calls.append(p)
        return ["x"] if 1 <= p <= n else []

    assert discover_page_count(fetch) == n
    assert len(calls) <= 2 * (n.bit_length() + 2)


def test_split_records():
    assert _split_records(b'[{"a": 1}, {"a": 2.0}]') == ['{"a": 1}', '{"a": 2.0}']
    assert _split_records(b'{"a": 1}\n\n{"a": 2}\n') == ['{"a": 1}', '{"a": 2}']
    assert _split_records(b"  ") == []


def test_raw_landing_file_with_one_json_array(spark, tmp_path):
    from strata.sources.scans import read_json_records

    root = tmp_path / "landing" / "snapshot_date=2026-02-02"
    root.mkdir(parents=True)
    (root / "data.json").write_text(json.dumps([{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]))
    df = read_json_records(spark, str(tmp_path / "landing"), BRONZE_CONTRACT, multiline=True)
    assert sorted(r["name"] for r in df.collect()) == ["a", "b"]


def test_page_report_and_drift(spark, tmp_path):
    from strata.operators.silver import dedup_report

    root = str(tmp_path / "api")
    write_pages(root, [[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}],
                       [{"id": 2, "name": "b"}, {"id": 3, "name": "c"}], [{"id": 4, "name": "d"}]])
    raw = read_pages(spark, path=root)
    r = page_report(raw, per_page=2).first()
    assert (r["pages"], r["first_page"], r["last_page"], r["missing_pages"], r["short_pages"],
            r["records"]) == (3, 1, 3, 0, 1, 5)
    drift = dedup_report(read_paged(spark, BRONZE_CONTRACT, path=root), ["id"]).first()
    assert drift["dup_keys"] == 1 and drift["removed"] == 1
    gap = raw.filter("page <> 2")
    assert page_report(gap, 2).first()["missing_pages"] == 1


def test_check_without_rules_is_an_empty_report(spark):
    from strata.operators.quality import check

    assert check(spark.range(3)).count() == 0


class _Resp:
    def __init__(self, body):
        self.body = body

    def read(self):
        return self.body

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        return False


def test_http_fetcher_pages_and_per_page_retries(monkeypatch):
    """The HTTP fetcher (no server: urlopen is replaced) asks ?page=&per_page= and
    retries each page on its own budget."""
    import urllib.parse
    import urllib.request

    from strata.sources import paged

    calls, failures = [], {"left": 2}
    pages = {1: [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}], 2: [{"id": 3, "name": "c"}]}

    def fake_urlopen(url, timeout):
        q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(url).query))
        calls.append(q)
        if q["page"] == "2" and failures["left"]:
            failures["left"] -= 1
            raise OSError("connection reset")
        return _Resp(json.dumps(pages.get(int(q["page"]), [])).encode())

    monkeypatch.setattr(urllib.request, "urlopen", fake_urlopen)
    monkeypatch.setattr(paged.time, "sleep", lambda s: None)
    http = paged._HttpPages("http://api.test/items?x=1", per_page=2, retries=3, timeout=5)
    assert http.fetch(1) == ['{"id": 1, "name": "a"}', '{"id": 2, "name": "b"}']
    assert calls[0] == {"x": "1", "page": "1", "per_page": "2"}
    assert http.fetch(2) == ['{"id": 3, "name": "c"}']  # two failures, then success
    assert discover_page_count(http.fetch) == 2
    failures["left"] = 10
    with pytest.raises(OSError):
        http.fetch(2)


def test_http_fetcher_rate_limit(monkeypatch):
    import urllib.request

    from strata.sources import paged

    clock = {"t": 0.0}
    slept = []
    monkeypatch.setattr(paged.time, "monotonic", lambda: clock["t"])
    monkeypatch.setattr(paged.time, "sleep", lambda s: (slept.append(s), clock.update(t=clock["t"] + s)))
    monkeypatch.setattr(urllib.request, "urlopen", lambda url, timeout: _Resp(b"[]"))
    http = paged._HttpPages("http://api.test/items", 200, 0, 5, min_interval=0.2)
    for page in (1, 2, 3):
        http.fetch(page)
        clock["t"] += 0.05  # each response takes 50 ms
    assert slept == pytest.approx([0.15, 0.15])


def test_packed_pages_are_read_like_page_folders(spark, tmp_path):
    lines = [(n // 3 + 1 if n < 4000 else None, '{"id":%d,"name":"é\\n %d"}' % (n, n))
             for n in range(5000)] + [(1, '{"id":1,\r\n"name":null}'), (-7, "{}"), (2001, "not json")]
    spark.createDataFrame(lines, "page bigint, record string").write.parquet(str(tmp_path / "in"))
    packed = pack_pages(spark.read.parquet(str(tmp_path / "in")))
    write_partitioned(packed, str(tmp_path / "out"), ["first_page"], fmt="json")
    df = read_pages(spark, path=str(tmp_path / "out"), packed=True)
    want = [(p, r.replace("\r", " ").replace("\n", " ")) for p, r in lines]
    assert df.dtypes == [("page", "int"), ("record", "string")]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    few = read_pages(spark, path=str(tmp_path / "out"), packed=True, pages=2)
    assert sorted(map(tuple, few.collect()), key=repr) == sorted(
        (w for w in want if w[0] is not None and w[0] <= 2), key=repr)
    bad = read_paged(spark, BRONZE_CONTRACT, path=str(tmp_path / "out"), packed=True)
    assert [r["_corrupt_record"] for r in bad.filter("_corrupt_record is not null").collect()] == [
        "not json"]


def test_a_page_of_any_size_is_packed_in_bounded_payloads(spark, tmp_path):
    spark.range(30000).selectExpr("cast(null as bigint) page", "concat('{\"id\":', id, '}') record") \
        .coalesce(1).write.parquet(str(tmp_path / "in"))
    packed = pack_pages(spark.read.parquet(str(tmp_path / "in"))).cache()
    try:
        assert packed.selectExpr("max(size(split(payload, '\\n')))").first()[0] <= 1024
        assert packed.selectExpr("sum(size(split(payload, '\\n')))").first()[0] == 30000
    finally:
        packed.unpersist()


def test_the_paged_query_writes_no_file_per_page(spark, tmp_path):
    spark.range(1500).selectExpr(
        "if(id % 100 = 99, null, id * 200 + 7) o_orderkey", "if(id % 9 = 0, null, id) o_custkey",
        "if(id % 5 = 0, null, 'ü\"\n') o_orderstatus", "id / 7 o_totalprice",
        "timestamp_ntz'1995-01-02 03:04:05.678' o_orderdate", "'1-URGENT' o_orderpriority") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    orders = spark.read.parquet(str(tmp_path / "orders.parquet"))
    twice = orders.unionByName(orders.filter("o_orderkey < 100000"))
    twice.write.parquet(str(tmp_path / "sf" / "orders.parquet"))
    got = q_src_paged(spark, str(tmp_path / "sf"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
    assert len(got.inputFiles()) < 50  # 1,486 pages
