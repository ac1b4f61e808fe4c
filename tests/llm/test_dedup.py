"""Exact and near duplicates, components and line dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import common, exact, linededup, simhash
from strata.llm.common import Scratch
from strata.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def awkward(n_words=4000):
    long = " ".join(f"w{i}" for i in range(n_words))
    return [(1, "Same TEXT"), (2, "same text"), (3, "same text "), (4, None), (5, ""),
            (6, long), (7, long), (8, long + "x"), (9, long[:-1] + "y"), (9, "dup id"),
            (9, "dup id"), (None, "no id"), (None, "no id"), (10, "no id"), (11, "É"),
            (12, "é"), (13, " \n\t ")]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_matches_brute_force(spark):
    rows = awkward()
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    want = sorted(((i, max((x for x in groups[lower(t)] if x is not None), default=None),
                    len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
                   for i, t in rows), key=repr)
    got = exact.exact_duplicates(spark, frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got),
                  key=repr) == want
    assert sum(r.kept for r in got) == len(groups)  # of repeated rows, too, one stays
    assert all(r.kept is False or r.doc_id == r.keep_id for r in got)


def test_exact_rounds_split_late_differences(spark):
    base = "a" * 40_000
    rows = [(i, base + str(i % 3)) for i in range(9)] + [(20, base), (21, base[:-1])]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in
           exact.exact_duplicates(spark, frame(spark, rows)).collect()}
    assert got[0] == got[3] == (6, 3) and got[20] == (20, 1) and got[21] == (21, 1)


def test_exact_shuffles_when_groups_are_many(spark, monkeypatch):
    monkeypatch.setattr("strata.llm.common.BROADCAST_ROWS", 0)
    monkeypatch.setattr("strata.llm.exact.small", lambda df: df.hint("shuffle_merge"))
    rows = [(i, f"text {i % 5}") for i in range(40)]
    got = exact.exact_duplicates(spark, frame(spark, rows)).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(35 + k, 8) for k in range(5)}


def test_broadcasts_are_bounded_by_bytes_too(spark, monkeypatch):
    wide, nested = ([(k, "x" * 400) for k in range(4)], [(k, ["x" * 400]) for k in range(4)])
    frames = [frame(spark, wide), frame(spark, nested, "doc_id long, text array<string>")]
    hint = lambda df: common.small(df)._jdf.queryExecution().logical().toString()
    assert all("broadcast" in hint(df).lower() for df in frames)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1000)
    assert all("shuffle_merge" in hint(df).lower() for df in frames)
    rows = [(k, "y" * 5000 + str(k % 5)) for k in range(15)]
    got = exact.exact_duplicates(spark, frame(spark, rows)).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(10 + k, 3) for k in range(5)}


def test_drop_exact_keeps_columns_even_clashing_ones(spark):
    df = frame(spark, [(1, "a", "x"), (2, "A", "y"), (3, "b", None)],
               "doc_id long, text string, rid string")
    out = exact.drop_exact_duplicates(spark, df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(2, "A", "y"), (3, "b", None)]


def brute_print(text, shingle=3):
    import xxhash

    w = lower(text).encode().split()
    if not w:
        return 0
    runs = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, prints):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    first = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        first[r] = min((x for x in (first.get(r), i) if x is not None), default=None)
    return [first[find(k)] for k in range(len(rows))]


def test_simhash_matches_brute_force(spark):
    rng = random.Random(1)
    rows = list(awkward(300))
    for i in range(60):
        words = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(400)]
        rows.append((100 + 3 * i, " ".join(words)))
        words[7] = "Changed"
        rows += [(101 + 3 * i, " ".join(words)), (102 + 3 * i, " ".join(words[:399]))]
    prints = [brute_print(t) for _, t in rows]
    comp = brute_components(rows, prints)
    got = simhash.near_duplicates(spark, frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == sorted(
        ((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, comp)), key=repr)
    out = simhash.drop_near_duplicates(spark, frame(spark, rows))
    assert out.count() == len(set(comp))


@pytest.mark.parametrize("dense", [0, 2, 256])
def test_links_find_every_pair_however_dense(spark, dense):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(20)}
    for v in list(values):  # families that share one segment or differ across both
        for _ in range(15):
            w = v
            for b in rng.sample(range(64), rng.randint(1, 4)):
                w ^= 1 << b
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = {frozenset((a, b)) for a in signed for b in signed
            if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    scratch = Scratch(spark, "t")
    got = simhash.links(scratch, spark.createDataFrame([(v,) for v in signed], "fp long"),
                        dense=dense).collect()
    assert {frozenset((r.u, r.v)) for r in got} == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    links = spark.createDataFrame(path + star + [(7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(Scratch(spark, "t"), links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}


def test_patience_aligns_moved_and_repeated_lines():
    assert linededup.patience(list("abcd"), list("xbcy")) == [(1, 1), (2, 2)]
    assert linededup.patience(list("aab"), list("aab")) == [(0, 0), (1, 1), (2, 2)]
    assert linededup.patience([], list("a")) == []
    pairs = linededup.patience(list("pqabcz"), list("abcpqz"))
    assert [i for i, _ in pairs] == sorted(i for i, _ in pairs)
    assert all("pqabcz"[i] == "abcpqz"[j] for i, j in pairs) and len(pairs) >= 4


@pytest.mark.parametrize("rare", [100, 1])
def test_line_dedup_removes_blocks_from_the_later_document(spark, rare):
    rows = [(1, "one\nshared block\nsecond shared\ntwo"), (2, "three\n shared block \n"
            "second shared\nfour\n\n"), (3, None), (4, ""), (5, "five\nsix"), (5, "five\nsix")]
    got = linededup.dedup_lines(spark, frame(spark, rows), rare=rare).collect()
    one = {r.doc_id: r for r in got if r.doc_id != 5}
    assert (one[1].text, one[1].n_removed) == (rows[0][1], 0)
    assert (one[2].text, one[2].n_lines, one[2].n_removed) == ("three\nfour\n\n", 6, 2)
    assert one[3].text is None and one[4].text == "" and len(got) == len(rows)
    assert sorted(r.n_removed for r in got if r.doc_id == 5) == [0, 2]


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("masks", [0, 1 << 25])
def test_ranges_without_unique_lines_are_aligned_whole(monkeypatch, masks):
    monkeypatch.setattr(linededup, "_MASKS", masks)
    assert linededup.patience(list("axbxc"), list("dxexf")) == [(1, 1), (3, 3)]
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.choice("xyz") for _ in range(rng.randint(1, 20))] * 2
        b = [rng.choice("xyzw") for _ in range(rng.randint(1, 20))] * 2
        got = sorted(linededup._longest(a, b, 0, len(a), 0, len(b)))
        assert len(got) == brute_lcs(a, b) and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_line_dedup_of_repeated_and_crossing_lines_by_rare(spark):
    rows = [(1, "a\nx\nb\nx\nc"), (2, "d\nx\ne\nx\nf"), (3, "p\nm\nq"), (4, "r\nq\ns\np\nt")]
    left = {rare: {r.doc_id: r.text for r in linededup.dedup_lines(
        spark, frame(spark, rows), rare=rare).collect()} for rare in (1, 100)}
    assert left[1][2] == left[100][2] == "d\ne\nf"
    assert left[1][4] == "r\ns\nt"  # common lines need no partner, so their order is no matter
    assert left[100][4] in ("r\nq\ns\nt", "r\ns\np\nt")  # one of a crossing pair has no partner


def test_line_dedup_tries_every_earlier_holder(spark):
    crossed = [(i, f"a{i}\nq\nb{i}\np\nc{i}") for i in range(2, 9)]
    rows = [(1, "p\nm\nq"), *crossed, (20, "r\nz\np\ns\nq\nt"), (21, "z\nk\nq\nl\np\nw"),
            (30, "u\nmine\nv"), (31, "mine\nu\nx"), (32, "mine\ny\nu")]
    got = {r.doc_id: r for r in linededup.dedup_lines(spark, frame(spark, rows)).collect()}
    assert got[2].n_removed == 1 and all(got[i].n_removed == 2 for i in range(3, 9))
    assert got[3].partners == [1, 2]  # the owner has them crossed, document 2 does not
    assert got[21].text == "k\nl\nw" and got[32].text == "y"
    assert all(p < i for i, r in got.items() for p in r.partners)


@pytest.mark.parametrize("run", [exact.exact_duplicates, simhash.near_duplicates,
                                 linededup.dedup_lines, exact.drop_exact_duplicates,
                                 simhash.drop_near_duplicates])
def test_empty_tables(spark, run):
    assert run(spark, frame(spark, [], DOCS)).count() == 0


def test_hot_group_is_not_gathered(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("the hot text")).otherwise(
            F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = exact.exact_duplicates(spark, df).filter("group_size > 1")
    assert got.select("keep_id", "group_size").distinct().collect() == [(2997, 1000)]
