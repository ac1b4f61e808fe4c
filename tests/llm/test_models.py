"""Language ID, personal data, quality, toxicity and licences against brute force."""

import re
import zlib

import numpy as np
import pytest

from strata.llm import langid, licenses, pii, quality, toxicity
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

DOCS = "doc_id long, text string, lang string, source string"


def docs_of(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_filters_agree_with_exact_sets():
    rng = np.random.default_rng(0)
    own = {n: rng.integers(0, 2**63, 2000, dtype=np.uint64) for n in ("aa", "bb", "cc")}
    model = langid.Filters(own)
    assert (model.false < 0.02).all()
    for i, name in enumerate(model.languages):
        for k in range(langid.HASHES):
            at = langid._slots(own[name], k, model.bits)
            assert (model.masks[0, at] >> i & 1).all()  # no false negatives


def test_language_id_on_held_out_rows(spark):
    df = docs_of(spark)
    got = langid.identify(spark, df).collect()
    want = {r.doc_id: r.lang for r in df.collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(got) == len(want) and len(held) > 20
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_counting_in_small_parts_learns_the_same_filters(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(i, f"the cat sat on the mat {i % 7}" if i % 2 else "der hund lief in den wald", lang)
         for i, lang in enumerate(["en" if i % 2 else "de" for i in range(60)])],
        "doc_id long, text string, lang string")
    whole = langid.train(rows)
    monkeypatch.setattr(langid, "_HELD", 40)
    parts = langid.train(rows)
    assert whole.languages == parts.languages == ["de", "en"]
    assert (whole.masks == parts.masks).all() and whole.masks.any()


def test_sample_shares_of_large_languages_are_never_empty(spark):
    for n in (1, 5_000, 5_001, 10**6, 5 * 10**9 + 1, 10**11, 10**15):
        share = langid._share(n, langid.SAMPLE) / langid._DEALT
        assert share * n == pytest.approx(min(n, langid.SAMPLE), rel=1e-3)
    assert langid._share(10**30, 1) == 1
    rows = [(i, "the cat sat on the mat", "en", None) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    dealt = df.filter(langid.slot(df.doc_id, "langid", langid._DEALT) < langid._share(3000, 300))
    assert 200 < dealt.count() < 400


def test_language_id_edge_rows(spark):
    train = [(i, "der die das und nicht mit", "de", "s") for i in range(30)] + [
        (100 + i, "the and of with that this", "en", "s") for i in range(30)]
    odd = [(1000, None, "de", None), (1001, "", None, None), (1002, "12 3!", "en", None),
           (None, "the and with that", None, None), (1003, "the and of with " * 60_000, None, "x"),
           (1004, "日本語", None, None)]
    got = {r.doc_id: r for r in langid.identify(
        spark, spark.createDataFrame(train + odd, DOCS)).collect()}
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert got[None].lang_pred == "en" and got[None].held_out is False
    assert got[1003].lang_pred == "en" and got[1004].lang_pred in ("de", "en")
    none = langid.identify(spark, spark.createDataFrame(odd[:1], DOCS)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert langid.identify(spark, spark.createDataFrame([], DOCS)).count() == 0


BASE = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    def ok(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == 1:
            return all(int(p) <= 255 for p in s.split("."))
        if kind == 2:
            luhn = sum(n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
                       for i, n in enumerate(map(int, reversed(d))))
            return 13 <= len(d) <= 19 and luhn % 10 == 0
        return kind == 0 or 9 <= len(d) <= 15

    return [(k, *m.span()) for k, rx in enumerate(BASE) for m in rx.finditer(text)
            if ok(k, m.group())]


def test_base_spans_match_the_patterns():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=400, deadline=None)
    @given(st.text("a1@.+- ()0é%", max_size=60))
    def check(text):
        assert pii.base_spans(text) == brute_spans(text)

    check()
    texts = ["a@b.c@d.e x@y.zz", "1.2.3.4.5.6.7.8 256.1.1.1 010.1.1.1", "4111 1111 1111 1111",
             "+1 (274) 555-9629 ...", "4111-1111-1111-1111-1", "@a.b a@@b.c", "+1((((((((", ""]
    for t in texts:
        assert pii.base_spans(t) == brute_spans(t)


def test_contexts_discover_unseen_identifiers(spark):
    card = "4111111111111111"
    rows = [(i, f"words here pan: {4000000000000000 + i * 10} and more", None, None)
            for i in range(1, 2)]
    rows = [(i, f"zoo account no {n} was closed", None, None) for i, n in enumerate(
        x for x in range(4000000000000000, 4000000000000300) if pii._luhn(str(x)))]
    rows += [(900, "zoo account no 4000000000000001 was closed", None, None),
             (901, f"once 99887766 and {card}", None, None), (902, None, None, None),
             (902, None, None, None), (None, "", None, None)]
    got = {r.doc_id: r for r in pii.find_pii(spark, spark.createDataFrame(rows, DOCS)).collect()}
    assert got[900].n_card == 0 and got[900].spans == "card:15:31"  # found by its context
    assert got[901].spans == "card:18:34"  # another number, in no known context, is left alone
    assert got[902].spans == "" and got[None].n_email == 0
    assert pii.find_pii(spark, spark.createDataFrame([], DOCS)).count() == 0


def brute_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i]
              for i, x in enumerate(lines))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside))


def test_quality_counts_match_brute_force(spark):
    texts = [None, "", "a b c", "a a a a", "a b c a b c d", "x\n\nx\nx \n x", "é# *é|\x85 y\xa0z",
             "one two three four " * 30, "q\x0bw\x0ce\rr\tt y"]
    texts += [r.text for r in docs_of(spark).limit(60).collect() if len(r.text) < 3000]
    for t in texts:
        assert quality.base_counts(t) == brute_quality(t)


def test_quality_keeps_trusted_and_rejects_junk(spark):
    df, labels = docs_of(spark), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = quality.judge_quality(spark, df, labels)
    both = got.join(labels, "doc_id").filter("not base_failed").collect()
    assert got.count() == df.count()
    assert all(r.kept for r in both if r.quality == 1)
    assert not any(r.kept for r in both if r.quality == 0)
    kept = quality.keep_quality(spark, df.withColumnRenamed("source", "q"), labels)
    assert kept.columns == ["doc_id", "text", "lang", "q", "n_chars"]
    assert kept.count() == got.filter("kept").count()
    none = quality.judge_quality(spark, df, labels.limit(0))
    assert none.filter("kept = base_failed or score <> 0").count() == 0
    assert quality.judge_quality(spark, df.limit(0), labels).count() == 0


def test_quality_score_by_hand():
    raw, good = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    grams = np.concatenate(list(quality.buckets("abcdefgh")))
    raw[grams] += 3
    good[grams[:2]] += 1
    w = quality.weights(raw, good)
    k = quality.BUCKETS
    up = np.log(2 / (2 + k)) - np.log(4 / (15 + k))
    down = np.log(1 / (2 + k)) - np.log(4 / (15 + k))
    assert quality.score("abcdefgh", w) == pytest.approx((2 * up + 3 * down) / 5)
    assert quality.score("abc", w) == 0.0
    assert len(np.concatenate(list(quality.buckets("x" * (quality._BLOCK + 100))))) == \
        quality._BLOCK + 97


def test_toxicity_finds_toxic_words_and_spares_groups(spark):
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        group = "muslim" if bad and i % 8 == 0 else ("christian" if i % 16 == 1 else "")
        rows.append((i, f"some text {group} number w{i % 7} {'awful' if bad else 'fine'}", None,
                     None))
        marks.append((i, 1, int(bad)))
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels)
    assert model.score("text awful") > 0.5 > model.score("text fine")
    swapped = [model.score(f"some {g} text") for g in ("muslim", "christian", "hindu")]
    data = toxicity.features(toxicity.training_rows(df, labels, "doc_id", "text", 10**6),
                             vocab := toxicity.vocabulary(toxicity.training_rows(
                                 df, labels, "doc_id", "text", 10**6))[0])
    free = toxicity.fit(data, len(vocab), swap_penalty=0.0)
    gap = abs(free[vocab.index("muslim")] - free[vocab.index("hindu")])
    held = abs(model.weight["muslim"] - model.weight["hindu"])
    assert held < gap / 2 and max(swapped) < 0.5
    odd = spark.createDataFrame([(1, None, None, None), (None, "", None, None)], DOCS)
    got = toxicity.score_toxicity(spark, odd, labels, model=model).collect()
    assert all(r.predicted == 0 and 0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(spark, df, labels.limit(0)).filter("predicted = 0").count() == 0


def test_toxicity_fit_is_the_minimum_of_a_dense_objective():
    """The fit against a dense Newton solve of the same loss, by explicit texts and swaps."""
    import pandas as pd

    rng, families = np.random.default_rng(3), (("g0", "g1", "g2"), ("h0", "h1"))
    vocab = ["bad", "ok", "g0", "g1", "g2", "h0", "h1"]
    docs = []
    for _ in range(300):
        own = {w for w, p in zip(vocab, (0.3, 0.6, 0.3, 0.2, 0.0, 0.3, 0.1)) if rng.random() < p}
        docs.append((own, int(rng.random() < (0.8 if "bad" in own else 0.1) + 0.1 * ("g0" in own))))
    index = {w: i for i, w in enumerate(vocab)}
    text = lambda ws: ",".join(str(index[w]) for w in sorted(ws))
    rows = [(y, text(own), None, 1) for own, y in docs]
    rows += [(-1, text({a}), text({b} if b else set()), 1) for own, _ in docs
             for a, b in toxicity.swaps(own, families)]
    got = toxicity.fit(pd.DataFrame(rows, columns=["toxic", "own", "swapped", "n"]), len(vocab))

    hot = lambda ws: np.array([float(w in ws) for w in vocab] + [1.0])
    x, y = np.array([hot(own) for own, _ in docs]), np.array([m for _, m in docs], float)
    moves = np.array([hot(own) - hot(own - {a} | {b}) for own, _ in docs for f in families
                      for a in f if a in own for b in f if b != a])
    hold = np.diag([toxicity.RIDGE] * len(vocab) + [1e-6]) + toxicity.SWAP_PENALTY * moves.T @ moves
    w = np.zeros(len(vocab) + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + hold, x.T @ (p - y) + hold @ w)
    assert np.allclose(got, w, atol=1e-4)


def test_toxicity_spares_plurals_and_other_languages(spark):
    """A group that only toxic texts name, in four languages and in the plural."""
    named = ["muslims", "jüdisch", "musulmans", "inmigrantes"]
    other = ["christians", "christlich", "chrétiens", "refugiados"]
    rows, marks = [], []
    for i in range(800):
        bad, k = i % 4 == 0, (i // 4) % 4
        group = named[k] if bad and i % 3 else ""
        rows.append((i, f"some text {group} number w{i % 7} {'awful' if bad else 'fine'}", None, None))
        marks.append((i, 1, int(bad)))
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels)
    free = toxicity.train(df, labels, families=())
    for a, b in zip(named, other):
        assert model.score(f"some {a} text") < 0.5 and model.score(f"{a} awful") > 0.5
        assert abs(model.weight[a] - model.weight[b]) < abs(free.weight[a]) / 2
    flat = [t for family in toxicity.IDENTITIES for t in family]
    assert len(flat) == len(set(flat)) and all(toxicity.words(t) == {t} for t in flat)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    df, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(spark, df, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) >= 0.95
    assert not any(r.predicted for r in got if r.toxic == 0)


def test_license_scan(spark):
    rows = [(1, "x\nReleased under the MIT License.\nAll rights reserved.", None, None),
            (2, "Licensed under the Apache License, Version 2.0. More! text", None, None),
            (3, None, None, None), (4, "", None, None), (4, "", None, None),
            (None, "You may not use this file except in compliance with the License. "
             "Unless so. You may obtain a copy of the License at "
             "http://www.apache.org/licenses/LICENSE-2.0", None, None),
            (6, "the mit license released under", None, None)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(((r.doc_id, r.sentence_ids, r.licenses, r.n_rules) for r in
                  licenses.scan_licenses(df).collect()), key=repr)
    assert got == sorted([
        (1, ",6,1,", "all-rights-reserved,mit", 2), (2, ",2,", "apache-2.0", 1),
        (3, ",", "", 0), (4, ",", "", 0), (4, ",", "", 0), (None, ",4,5,", "apache-2.0", 1),
        (6, ",", "", 0)], key=repr)
    assert licenses.scan_licenses(df.limit(0)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
BSD = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_license_scan_of_genuine_notices(spark):
    want = {MIT: ",8,9,", APACHE: ",3,4,5,", GPL: ",11,12,", BSD: ",1,17,18,19,",
            BSD3: ",1,17,18,19,20,",
            "x\nThis file is licensed under the MIT License.\ny": ",7,",
            "Not so.\nLicensed under the MIT License\nAll rights reserved\nend": ",7,1,",
            "Licensed under the Apache License, Version 2.0\nThe license is long": ",2,",
            "It is not licensed under the MIT License. Unlicensed under the MIT Licenses": ","}
    name = {MIT: "mit", APACHE: "apache-2.0", GPL: "gpl-3.0",
            BSD: "all-rights-reserved,bsd-2-clause", BSD3: "all-rights-reserved,bsd-3-clause"}
    forms = [(" ".join(t.split()), t) for t in name] + [
        ("# " + t.replace("\n", "\n# "), t) for t in name] + [(t, t) for t in want]
    df = spark.createDataFrame([(i, t, None, None) for i, (t, _) in enumerate(forms)], DOCS)
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    for i, (_, t) in enumerate(forms):
        assert got[i].sentence_ids == want[t], (forms[i], got[i])
        assert t not in name or got[i].licenses == name[t], got[i]


def test_license_scan_of_other_licences_and_negations(spark):
    gpl2 = GPL.replace("version 3", "version 2")
    texts = {
        "// SPDX-License-Identifier: MIT\nint x;": "mit", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
        "# SPDX-License-Identifier: LGPL-2.1-or-later\n#\n# text": "lgpl-2.1", gpl2: "gpl-2.0",
        GPL.replace("General", "Lesser General"): "lgpl-3.0",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without "
        "fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear "
        "in all copies.": "isc",
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.": "mpl-2.0",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "The library is licensed under CC BY 4.0.": "cc-by-4.0",
        "It is no longer licensed under the MIT license.": "", "never released under the MIT License": "",
        "This file is not licensed under the MIT License.": "", "mit\nmit": ""}
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())
    assert all(any(t in s for t in licenses.TRIGGERS) for s in licenses.SENTENCES)
    assert len(set(licenses.SENTENCES)) == len(licenses.SENTENCES)


def test_license_oracle_reads_genuine_notices_like_the_query(spark):
    """The SQL and the query agree on wrapped, commented, one-line, broken and odd texts."""
    import duckdb
    import pandas as pd

    notices = [MIT, APACHE, GPL, BSD, BSD3, "x\nThis file is licensed under the MIT License.\ny"]
    forms = notices + [" ".join(t.split()) for t in notices]
    forms += ["# " + t.replace("\n", "\n# ") for t in notices] + ["\n\n".join(notices), "|a|" + MIT]
    forms += [t[:len(t) // 2] for t in notices] + [t.upper() for t in notices]
    forms += [None, "", "É licensed under CC BY 4.0.", "SPDX-License-Identifier: ISC\n*/", "a" * 100_000,
              "All rights reserved.\n" * 3000]
    want = [(i, t) for i, t in enumerate(forms)] + [(0, MIT), (None, MIT)]
    con = duckdb.connect()
    con.register("given", pd.DataFrame(want, columns=["doc_id", "text"], dtype="object"))
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text FROM given")
    sql = sorted(con.execute(licenses.ORACLE).fetchall(), key=repr)
    df = spark.createDataFrame(want, "doc_id long, text string")
    assert sorted((tuple(r) for r in licenses.scan_licenses(df).collect()), key=repr) == sql
    assert sum(r[2] != "" for r in sql) > 20


def test_oracles_of_this_folder(spark):
    from strata.llm.catalog import ORACLES, QUERIES

    con = duck(SF_SMALL)
    for key, sql in ORACLES.items():
        ok, n, _, detail = compare(spark, con, key, QUERIES[key], sql, SF_SMALL)
        assert ok and n > 0, (key, detail)
    plan = QUERIES["op8_license_scan"](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.toString())
