"""Mixing, packing and the pipeline: exact bookkeeping on small inputs."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import mixing, packing
from strata.llm.tokens import Encoder
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, shard string"


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + (
        [None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    t = dict.fromkeys(order, 0.0)
    left = 1.5 * sum(sizes.values())
    while left > 1e-9:
        free = [s for s in order if t[s] < 2 * sizes[s] - 1e-9]
        if not free:
            break
        total, more = sum(w[s] for s in free), 0.0
        for s in free:
            t[s] += left * w[s] / total
            more += max(0.0, t[s] - 2 * sizes[s])
            t[s] = min(t[s], 2 * sizes[s])
        left = more
    return t


def test_mixing_meets_targets_and_repeats(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), "en", ["a", "b", "c", None, "Z"][
        min(4, int((i * 13 % 97) ** 0.5))], None) for i in range(600)]
    rows += [(700, None, None, "a", None), (701, " \n", None, None, None), (None, "x y", None,
             "only", None), (705, "dup dup", None, "b", None), (705, "dup dup", None, "b", None)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mixture(spark, df).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (r[0], len((r[1] or "").split())) for r in rows)
    taken, target = defaultdict(int), {}
    for r in got:
        assert r.taken == r.copies * r.size <= 2 * r.size and len(r.shards) == r.copies
        target[r.source_size] = r.target
    by_id = {r.doc_id: r for r in got}
    for r in rows:
        assert by_id[r[0]].target == pytest.approx(want[r[3]])
    source_of = {(r[0], len((r[1] or "").split())): r[3] for r in rows}
    for r in got:
        taken[source_of[(r.doc_id, r.size)]] += r.taken
    for s, t in want.items():
        assert taken[s] <= t + 1e-6 and t - taken[s] <= max(2, 0.02 * sizes[s]), (s, t, taken[s])
    again = mixing.mixture(spark, df.repartition(7)).collect()
    key = lambda r: (repr(r.doc_id), r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_shards_split_quotas_exactly():
    quotas = np.array([17, 0, 1000, 3])
    parts = [mixing.shard_quotas(quotas, 7, k) for k in range(7)]
    assert (sum(parts) == quotas).all()
    assert max(p.sum() for p in parts) - min(p.sum() for p in parts) <= 3
    assert all((a == b).all() for a, b in zip(parts, [mixing.shard_quotas(quotas, 7, k)
                                                      for k in range(7)]))


def test_mix_keeps_columns_over_many_shards(spark):
    rows = [(i, "one two three four", "en", f"s{i % 4}", str(i)) for i in range(80)]
    df = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mixture(spark, df, shard_words=64)
    assert mixed.selectExpr("explode(shards) s").distinct().count() > 3
    out = mixing.mix(spark, df, shard_words=64)
    assert out.columns == df.columns
    assert out.count() == mixed.selectExpr("sum(copies)").first()[0]
    assert mixing.mixture(spark, df.limit(0)).count() == mixing.mix(spark, df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def encoder():
    return Encoder(packing.tokenizer_path())


def test_encoder_equals_the_tokenizer(spark, encoder):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts += ["", " ", "don't we'll 'S X'T", "É́ é İ ß µ ª º ² ½ 日本", "a\x1cb\x85c\xa0d",
              "“quoted” – text…", "<|endoftext|> <| x", "a" * 500, " x y", "1234 12,5%%"]
    for t in texts:
        got = np.frombuffer(encoder.encode(t), "<u4").tolist()
        assert got == encoder.whole.encode(t, add_special_tokens=False).ids, t


def test_encoder_property(encoder):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.characters(max_codepoint=0x2100, exclude_categories=["Cs"]), max_size=40))
    def check(text):
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == encoder.whole.encode(text, add_special_tokens=False).ids

    check()


@pytest.mark.parametrize("scale", [1, 40, 5000])
def test_plan_uses_each_length_and_packs_tightly(scale):
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(6.3, 1.2, 1500).astype(int) + 1, 4096)
    histogram = {int(k): int(n) * scale for k, n in zip(*np.unique(lengths, return_counts=True))}
    plan = packing.plan(histogram)
    used = Counter()
    for pattern, times in plan:
        assert sum(k * a for k, a in pattern.items()) <= 4096 and times > 0
        for k, a in pattern.items():
            used[k] += a * times
    assert used == histogram
    least = -(-sum(k * n for k, n in histogram.items()) // 4096)
    full = histogram.get(4096, 0)
    big = sum(n for k, n in histogram.items() if 2048 < k < 4096)
    assert sum(t for _, t in plan) <= max(1.01 * least, full + big) + 1


def test_packing_is_gapless_and_whole(spark, encoder):
    long = " ".join(f"word{i}" for i in range(6000))
    rows = [(i, f"some text {i} " * (i % 50), None, None, None) for i in range(300)]
    rows += [(400, long, None, None, None), (401, None, None, None, None), (402, "", None, None,
             None), (402, "", None, None, None), (None, "no id", None, None, None)]
    got = packing.pack(spark, spark.createDataFrame(rows, DOCS)).collect()
    places, whole = defaultdict(list), defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id].append(r)
    for inside in places.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    for i, text, *_ in rows:
        ids = encoder.encode(text or "") + (1).to_bytes(4, "little")
        if i == 402:
            continue
        own = sorted(whole[i], key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids) // 4
        for r in own:
            assert r.start == 4096 * r.piece
            assert r.ids_crc32 == zlib.crc32(ids[4 * r.start:4 * (r.start + r.length)])
    assert [r.length for r in whole[402]] == [1, 1]
    assert packing.pack(spark, spark.createDataFrame([], DOCS)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs.withColumn("rid", docs.source).union(docs.selectExpr(
        "null", "null", "null", "null", "null", "'x'").limit(3))
    columns, sizes = extra.columns, [extra.count()]
    now = extra
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF_SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert now.columns == columns, name
        sizes.append(now.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0 and sizes[5] >= sizes[4]
    assert now.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                           "offset"]
    empty = extra.limit(0)
    for _, stage in corpus_pipeline.STAGES[:4]:
        empty = stage(spark, empty, SF_SMALL)
        assert empty.columns == columns and empty.count() == 0


def test_stages_carry_columns_of_any_name(spark):
    """Dots, backticks, spaces and names that differ from the operators' own in case only."""
    names = ["a.b", "c`d", "e f", "RID", "Q", "row.x", "*"]
    rows = [(i, f"word{i % 7} and some more words {i} " * (20 + i % 5), "en", f"s{i % 3}", i,
             *[f"{n}{i}" for n in names]) for i in range(120)]
    rows += [(None, None, None, None, None, *[None] * len(names)), (3, "", None, "s1", 0, *names)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        "`" + n.replace("`", "``") + "` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name == "packing":
            assert out.count() > 0
            continue
        assert out.columns == docs.columns, name
        kept = {r["doc_id"]: r for r in out.collect()}
        assert all(r[n] == f"{n}{i}" for i, r in kept.items() if i not in (None, 3) for n in names), name


def test_packing_takes_ids_of_any_type(spark):
    docs = spark.createDataFrame([("id-a", "some words"), (None, "more"), ("id-a", "some words")],
                                 "doc_id string, text string")
    got = packing.pack(spark, docs).collect()
    assert sorted((r.doc_id or "") for r in got) == ["", "id-a", "id-a"]
