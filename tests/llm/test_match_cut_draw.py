"""Decontamination, fill-in-the-middle and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, fim, importance
from strata.llm.common import Scratch
from strata.llm.words import words_of

DOCS = "doc_id long, text string"
EXTRA = "doc_id long, text string, `a.b` string, segment long, rid long, Term string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- decontamination ---------------------------------------------------------

def brute_matches(docs, items, size, slop):
    """Per document: (n_words, n_hit, items hit, items near)."""
    cut = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            cut.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found, near = set(), set(), set()
        for terms, names in cut.items():
            n = len(terms)
            at = [i for i in range(len(w) - n + 1) if tuple(w[i:i + n]) == terms]
            hit.update(p for i in at for p in range(i, i + n))
            found |= names if at else set()
            if any(set(terms) <= set(w[i:i + n + slop]) for i in range(len(w))):
                near |= names
        out.append((doc_id, len(w), len(hit), sorted(found), len(near)))
    return sorted(out, key=repr)


def planted():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(40)] + ["the"] * 30 + ["É", "naïve", "日本"]
    passage = [rnd.choice(vocab) for _ in range(24)]
    items = [(1, " ".join(passage)), (2, "The, THE the!"), (3, None), (4, " .\n"), (5, "日本"),
             (6, " ".join(passage[3:14])), (None, "w1 w2"), (1, "w7 w7 w8"),
             (20, " ".join(rnd.choice(vocab) for _ in range(15)))]
    docs = [(0, None), (1, ""), (2, " ".join(passage)), (2, " ".join(passage)),
            (3, "x " + "-".join(passage[:12]).upper()), (4, " ".join(passage[:9])),
            (5, " ".join(passage[9:])), (None, "the the the the"), (6, "日本,日本 w7 W7 w8")]
    for i in range(60):
        body = [rnd.choice(vocab) for _ in range(rnd.randrange(1, 60))]
        if i % 3 == 0:
            a = rnd.randrange(0, 10)
            part = passage[a:a + rnd.randrange(5, 14)]
            rnd.shuffle(part) if i % 2 else None
            body[len(body) // 2:len(body) // 2] = part
        docs.append((100 + i, " ".join(body)))
    return docs, items


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.n_near)
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("size,slop", [(10, 2), (4, 3)])
def test_contamination_matches_brute_force(spark, size, slop):
    docs, items = planted()
    out = decontaminate.contamination(
        spark, spark.createDataFrame(docs, DOCS).repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), size=size, slop=slop)
    assert result(out) == brute_matches(docs, items, size, slop)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"])
               for r in out.collect())


def test_segments_and_blocks_of_any_size_agree(spark):
    docs, items = planted()
    scratch = Scratch(spark, "test")
    frame = spark.createDataFrame(docs, DOCS).coalesce(1)
    known, _ = decontaminate.windows(scratch, spark.createDataFrame(
        items, "item_id long, text string"))
    found = []
    for segment, block in ((1, 5), (300, 1000), (1 << 20, 7)):
        index = decontaminate.build_index(scratch, frame, segment=segment)
        ids = (index.filter("term = ''")
               .select("segment", F.posexplode("ids").alias("doc", "doc_id")))
        rows = decontaminate.match(scratch, index, known, block=block).join(
            ids, ["segment", "doc"]).select("doc_id", "wid", "near", "start", "n").collect()
        found.append(sorted(map(tuple, rows), key=repr))
    assert found[0] == found[1] == found[2] and found[0]
    exact = decontaminate.match(scratch, index, known, slop=None)
    assert exact.filter("near").isEmpty() and not exact.isEmpty()


def test_phrases_do_not_run_across_documents(spark):
    docs = [(1, "a b c d e"), (2, "f g h i j"), (3, "x a b c d e f g h i j")]
    items = [(1, "a b c d e f g h i j")]
    out = decontaminate.contamination(
        spark, spark.createDataFrame(docs, DOCS).coalesce(1),
        spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: (r.n_hit, r.n_near) for r in out.collect()} == {
        1: (0, 0), 2: (0, 0), 3: (10, 1)}


def test_one_long_text_and_a_passage_in_every_document(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"{i} {passage} tail") for i in range(500)]
    docs.append((999, " ".join(["the"] * 30_000) + " " + passage))
    items = [(i, f"{passage} {i}") for i in range(40)] + [(77, "the")]
    out = decontaminate.contamination(spark, spark.createDataFrame(docs, DOCS),
                                      spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_hit, r.n_items) for r in out.collect()}
    assert got[3] == (12, 40) and got[999] == (30_012, 41)
    assert set(got.values()) == {(12, 40), (30_012, 41)}


def test_contamination_of_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(spark, none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b", "x", 3, 4, "t"), (None,) * 6], EXTRA)
    got = {r.doc_id: r.n_hit for r in decontaminate.contamination(spark, docs, items).collect()}
    assert got == {1: 2, None: 0}
    no_items = items.filter("false")
    assert [(r.n_hit, r["items"]) for r in
            decontaminate.contamination(spark, docs, no_items).collect()] == [(0, []), (0, [])]
    texts = spark.createDataFrame([("id-a", "q a b")], "doc_id string, text string")
    assert decontaminate.contamination(spark, texts, items).first().doc_id == "id-a"


def test_words_are_the_same_in_spark_and_arrow(spark):
    import pyarrow as pa

    from strata.llm.words import split_words

    texts = [None, "", "A-b_c\x7f\x00d", "É É", "ß9 ' `{}~", " lead", "trail ", "日本x", "ſK"]
    flat, counts = split_words(pa.array(texts))
    flat, at, got = flat.to_pylist(), 0, []
    for n in counts:
        got.append(flat[at:at + n])
        at += n
    assert got == [words(t) for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert [r.w for r in rows.select("i", words_of(F.col("text")).alias("w")).orderBy("i")
            .collect()] == got


# --- fill-in-the-middle ------------------------------------------------------

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute_fim(doc_id, text):
    text = text or ""
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def fim_texts():
    rnd = random.Random(9)
    chars = "abcXYZ   \n,.<>PSM/0123é😀日"
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(0, 90))) for _ in range(150)]
    return texts + [None, "", "a", "😀", "<<<", "has <P> inside", "<S>", "x<M", " \n\t",
                    "word " * 40_000, "a" * 100_000, "é" * 5000]


def test_fill_in_middle_matches_brute_force_and_restores(spark):
    docs = [(i, t) for i, t in enumerate(fim_texts())] + [(3, "twice"), (3, "twice"), (None, "no id x")]
    out = fim.transform(spark.createDataFrame(docs, DOCS)).withColumn(
        "back", fim.restore(F.col("output"), F.col("form")))
    want = Counter(brute_fim(*d) + (d[1] or "",) for d in docs)
    got = Counter(tuple(r) for r in out.collect())
    assert got == want
    assert {k[2] for k in got} == {"plain", "psm", "spm"}


def test_skip_list_reaches_every_rank():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 2, 31, 32, 33, 1024, 1025, 5000):
        widths = rnd.integers(1, 9, n)
        before = np.concatenate(([0], np.cumsum(widths)))
        for fan in (2, 32):
            lanes = fim.SkipList(widths, fan)
            ranks = range(n + 1) if n < 1100 else rnd.integers(0, n + 1, 200)
            assert all(lanes.reach(int(r)) == before[r] for r in ranks)
            assert len(lanes.lanes[-1][0]) <= fan


def test_fill_in_middle_other_settings_and_shapes(spark):
    docs = spark.createDataFrame([(i, f"text {i} of words") for i in range(40)], DOCS)
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    out = fim.transform(docs, seed=7, rate=100, spm_rate=50, sentinels=marks).withColumn(
        "back", fim.restore(F.col("output"), F.col("form"), marks)).collect()
    assert {r.form for r in out} == {"psm", "spm"}
    assert all(r.back == f"text {r.doc_id} of words" for r in out)
    with pytest.raises(ValueError):
        fim.transform(docs, sentinels=("<P>", "<P>x", "<M>"))
    with pytest.raises(ValueError):
        fim.transform(docs, sentinels=("aba", "c", "d"))
    assert fim.transform(docs.filter("false")).count() == 0
    extra = spark.createDataFrame([(1, "a b", "x", 3, 4, "t"), (None,) * 6], EXTRA)
    assert {r.doc_id: r.n for r in fim.transform(extra).collect()} == {1: 3, None: 0}


# --- importance resampling ---------------------------------------------------

def features(text, order):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, order=1, buckets=10_000, seed=2024, share=10, min_words=20):
    key = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(key(f) for _, t in docs for f in features(t, order))
    t = Counter(key(f) for _, x in target for f in features(x, order))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
            for b in range(buckets)]
    rows = []
    for i, text in docs:
        f = features(text, order)
        weight = sum(gain[key(x)] for x in f) // len(f) if f else 0
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(
            -1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= min_words))
    drawn = sum(r[4] for r in rows) * share // 100
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = Counter()
    ranks = {}
    for k, r in enumerate(able[:drawn]):
        ranks.setdefault(r[0], []).append(k + 1)
    out = []
    for r in rows:
        mine = ranks.get(r[0], []) if r[4] else []
        rank = mine[place[r[0]]] if place[r[0]] < len(mine) else None
        place[r[0]] += bool(r[4])
        out.append((*r[:4], rank))
    return sorted(out, key=repr)


def resample_rows():
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(300)] + ["É", "zz"]
    docs = [(i, " ".join(rnd.choice(vocab[:30 + i]) for _ in range(rnd.randrange(0, 60))))
            for i in range(200)]
    docs += [(500, None), (501, ""), (502, " .,"), (None, "a b " * 15), (503, "same word " * 20),
             (503, "same word " * 20), (504, "long " * 50_000)]
    return docs, [(1, " ".join(vocab[:60])), (2, None), (3, "v1 V1 v2"), (4, "")]


@pytest.mark.parametrize("kw", [{}, {"order": 3, "buckets": 97, "share": 50, "min_words": 0,
                                     "seed": 5}])
def test_resampling_matches_brute_force(spark, kw):
    docs, target = resample_rows()
    out = importance.resample(spark, spark.createDataFrame(docs, DOCS).repartition(5),
                              spark.createDataFrame(target, "item_id long, text string"), **kw)
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == brute_resample(docs, target, **kw)
    assert out.schema.simpleString() == ("struct<doc_id:bigint,n_features:bigint,weight:bigint,"
                                         "score:bigint,rank:bigint>")


def test_resampling_slices_do_not_change_features():
    import pyarrow as pa

    docs, _ = resample_rows()
    texts = pa.array([t for _, t in docs], pa.string())
    whole = list(importance.feature_buckets(texts, 2, 1000))
    parts = [list(importance.feature_buckets(texts.slice(a, 10), 2, 1000))
             for a in range(0, len(texts), 10)]
    for k in range(2):
        assert np.array_equal(whole[k][0], np.concatenate([p[k][0] for p in parts]))
        assert np.array_equal(whole[k][1], np.concatenate([p[k][1] for p in parts]))


def test_resampling_of_empty_tables_and_clashing_names(spark):
    docs, target = resample_rows()
    frame = spark.createDataFrame(docs, DOCS)
    items = spark.createDataFrame(target, "item_id long, text string")
    assert importance.resample(spark, frame.filter("false"), items).count() == 0
    lone = importance.resample(spark, frame, items.filter("false"))
    assert sorted(map(tuple, lone.collect()), key=repr) == brute_resample(docs, [])
    extra = spark.createDataFrame([(1, "a b", "x", 3, 4, "t"), (None,) * 6], EXTRA)
    assert {r.doc_id: r.n_features for r in importance.resample(spark, extra, items).collect()} == {
        1: 2, None: 0}


def test_ranks_hold_over_many_partitions_and_ties(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3).alias("score"))
    out = importance.with_rank(Scratch(spark, "test"), rows.repartition(7),
                               [F.col("score").desc(), F.col("id")])
    got = [(r.score, r.id) for r in out.orderBy("rank").collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1]))
    assert [r["rank"] for r in out.orderBy("rank").collect()] == list(range(1, 5001))
