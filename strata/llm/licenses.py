"""Licence scans by sentence rules, with DataFrame functions only.

A text is cut into sentences: after ``.``, ``!``, ``?``, ``:`` or ``;`` before white space, after
a link, and at empty lines (an empty comment line is one), unless a link follows after
"at". So a notice may be wrapped and stand behind comment marks. A sentence is normalised to
its ASCII letters and digits in lower case with single spaces between; lead-ins that vary
("this file is", "copyright … all rights reserved", "neither the name of …") go. A normalised
sentence that is known becomes its identifier (place in ``SENTENCES``, from 1); one that is not
is looked up line by line instead, for notices on a line of their own in a text without
stops. A sentence that only holds a known one ("not licensed under …") is another sentence.
The identifiers of a text, in order, are matched against the rules, each an ordered run of
identifiers of one licence. No shuffle, no Python: each row is worked on alone, so hot
sources and copies cost nothing extra.

Null and empty texts have no sentences and no licence. Texts are cut whole, whatever their
length. Repeated rows give repeated results, an empty table an empty one; other columns are
ignored. The sentence table is fixed and small. ``ORACLE`` is the same rule in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import LOWER, UPPER, ascii_lower, documents

#: Licence sentences, normalised.
SENTENCES = (
    "all rights reserved",
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "released under the mit license",
    "licensed under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files the software to deal in the software without "
    "restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom "
    "the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the software",
    "licensed under the gnu general public license version 3",
    "you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or "
    "at your option any later version",
    "you should have received a copy of the gnu general public license along with this program",
    "licensed under cc by nc 4 0",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "licensed under a creative commons attribution 4 0 international license",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution",
    "nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission",
    "licensed under the gnu general public license version 2",
    "you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 2 of the license or "
    "at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public "
    "license as published by the free software foundation either version 2 1 of the license "
    "or at your option any later version",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public "
    "license as published by the free software foundation either version 3 of the license or "
    "at your option any later version",
    "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted provided that the above copyright notice and this "
    "permission notice appear in all copies",
    "this source code form is subject to the terms of the mozilla public license v",
    "this is free and unencumbered software released into the public domain",
    "spdx license identifier mit",
    "spdx license identifier apache 2 0",
    "spdx license identifier gpl 2 0 only",
    "spdx license identifier gpl 2 0 or later",
    "spdx license identifier gpl 3 0 only",
    "spdx license identifier gpl 3 0 or later",
    "spdx license identifier lgpl 2 1 or later",
    "spdx license identifier lgpl 3 0 or later",
    "spdx license identifier bsd 2 clause",
    "spdx license identifier bsd 3 clause",
    "spdx license identifier isc",
    "spdx license identifier mpl 2 0",
    "spdx license identifier unlicense",
    "spdx license identifier cc by 4 0",
)

#: Licence, and the identifiers that state it when they follow one another.
RULES = (
    ("all-rights-reserved", (1,)),
    ("apache-2.0", (2,)),
    ("apache-2.0", (3, 4)),
    ("apache-2.0", (4, 5)),
    ("mit", (6,)),
    ("mit", (7,)),
    ("mit", (8, 9)),
    ("gpl-3.0", (10,)),
    ("gpl-3.0", (11,)),
    ("gpl-3.0", (11, 12)),
    ("cc-by-nc-4.0", (13,)),
    ("cc-by-4.0", (14,)),
    ("cc-by-sa-4.0", (15,)),
    ("cc-by-4.0", (16,)),
    ("bsd-2-clause", (17, 18, 19)),
    ("bsd-3-clause", (17, 18, 19, 20)),
    ("gpl-2.0", (21,)),
    ("gpl-2.0", (22,)),
    ("lgpl-2.1", (23,)),
    ("lgpl-3.0", (24,)),
    ("isc", (25,)),
    ("mpl-2.0", (26,)),
    ("unlicense", (27,)),
    ("mit", (28,)),
    ("apache-2.0", (29,)),
    ("gpl-2.0", (30,)),
    ("gpl-2.0", (31,)),
    ("gpl-3.0", (32,)),
    ("gpl-3.0", (33,)),
    ("lgpl-2.1", (34,)),
    ("lgpl-3.0", (35,)),
    ("bsd-2-clause", (36,)),
    ("bsd-3-clause", (37,)),
    ("isc", (38,)),
    ("mpl-2.0", (39,)),
    ("unlicense", (40,)),
    ("cc-by-4.0", (41,)),
)

#: Every known sentence has one of these words in it.
TRIGGERS = ("licen", "redistribut", "permission", "reserved", "unencumbered", "mozilla")

#: Patterns that Java and RE2 read alike, in the order they are applied, and what they become.
_SPACE = "[ \\t\\r\\n\\x0b\\x0c]"
_EMPTY = "\\n[ \\t\\r#*/%;-]*\\n"
CUTS = (
    ("license-identifier:", "license identifier"),  # the name belongs to the line's sentence
    (f" at{_EMPTY}", " at "),  # a link on a line of its own goes on
    (f"(https?://[^ \\t\\r\\n\\x0b\\x0c]+){_SPACE}+", "{1}|"),
    (f"[.!?:;]{_SPACE}+|{_EMPTY}", "|"),
)
_THINGS = ("file|work|software|program|project|code|source code|library|package|module|document|"
           "repository|website")
LEADS = (
    (f"^(this|the) ({_THINGS}) (is|are) ", ""),
    ("^copyright .* (all rights reserved)$", "{1}"),
    ("^neither the name of .* (nor the names of its contributors)", "{1}"),
)


def _norm(sentence: Column) -> Column:
    """ASCII letters and digits with single spaces between, without a lead-in."""
    out = F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))
    for pattern, to in LEADS:
        out = F.regexp_replace(out, pattern, to.replace("{1}", "$1"))
    return out


def sentences(text: Column) -> Column:
    """The sentences of a text, in order, in lower case and with their line ends."""
    cut = F.translate(ascii_lower(text), "|", " ")
    for pattern, to in CUTS:
        cut = F.regexp_replace(cut, pattern, to.replace("{1}", "$1"))
    return F.split(cut, "[|]")


def sentence_ids(text: Column, known: tuple[str, ...] = SENTENCES,
                 triggers: tuple[str, ...] = TRIGGERS) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table, lower, some = F.array(*map(F.lit, known)), F.lower(text), F.lit(False)
    for word in triggers:  # plain searches, which spare most texts the rest
        some = some | lower.contains(word)

    def place(sentence: Column) -> Column:
        return F.array_position(table, _norm(sentence)).cast("int")

    ids = F.flatten(F.transform(sentences(text), lambda s: F.when(place(s) > 0, F.array(place(s)))
                                .otherwise(F.transform(F.split(s, "\n"), place))))
    return F.when(some, F.filter(ids, lambda i: i > 0)).otherwise(F.array().cast("array<int>"))


def _wrapped(ids) -> str:
    return "," + "".join(f"{i}," for i in ids)


def _states(found: str, name: str, ids, rules) -> Column:
    """Whether the identifiers hold a rule's run other than as the head of another licence's."""
    left = F.col(found)
    for other, run in rules:
        if other != name and len(run) > len(ids) and run[:len(ids)] == ids:
            left = F.replace(left, F.lit(_wrapped(run)), F.lit(",,"))
    return left.contains(_wrapped(ids))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  known: tuple[str, ...] = SENTENCES, rules=RULES,
                  triggers: tuple[str, ...] = TRIGGERS) -> DataFrame:
    """One row per row of ``df``: doc_id, sentence_ids ("," before and after each), licenses
    (matched ones in order of name, comma-joined), n_rules (rules that match)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = df.select(F.col(id_col).alias("doc_id"), F.concat(F.lit(","), F.array_join(
        F.transform(sentence_ids(text, known, triggers),
                    lambda i: F.concat(i.cast("string"), F.lit(","))), "")).alias("sentence_ids"))
    hits = F.array_compact(F.array(*[
        F.when(_states("sentence_ids", name, ids, rules), F.lit(name)) for name, ids in rules]))
    return found.withColumn("hits", hits).select(
        "doc_id", "sentence_ids",
        F.array_join(F.array_sort(F.array_distinct("hits")), ",").alias("licenses"),
        F.size("hits").cast("long").alias("n_rules"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _oracle(table: str = "documents") -> str:
    """The scan in SQL; a rule's run inside a longer run of another licence does not count."""
    def replaced(value: str, steps) -> str:
        for pattern, to in steps:
            value = f"regexp_replace({value}, '{pattern}', '{to.replace('{1}', chr(92) + '1')}', 'g')"
        return value

    known = ", ".join(f"'{s}'" for s in SENTENCES)
    cut = replaced(f"translate(coalesce(text, ''), '{UPPER}|', '{LOWER} ')", CUTS)
    norm = replaced("trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))", LEADS)
    parts = []
    for name, ids in RULES:
        left = "sentence_ids"
        for other, run in RULES:
            if other != name and len(run) > len(ids) and run[:len(ids)] == ids:
                left = f"replace({left}, '{_wrapped(run)}', ',,')"
        parts.append(f"SELECT rowid_, '{name}' AS name FROM found WHERE contains({left}, "
                     f"'{_wrapped(ids)}')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rowid_, doc_id, text FROM {table}),
s AS (SELECT rowid_, unnest(p) AS part, generate_subscripts(p, 1) AS nth
      FROM (SELECT rowid_, string_split({cut}, '|') AS p FROM d)),
known AS (SELECT unnest([{known}]) AS sentence, unnest(range(1, {len(SENTENCES) + 1})) AS id),
whole AS (SELECT rowid_, nth, 0 AS line, id FROM (SELECT rowid_, nth, {norm.replace("(x,", "(part,")}
          AS sentence FROM s) JOIN known USING (sentence)),
l AS (SELECT rowid_, nth, unnest(p) AS x, generate_subscripts(p, 1) AS line
      FROM (SELECT rowid_, nth, string_split(part, chr(10)) AS p FROM s ANTI JOIN whole
            USING (rowid_, nth))),
ids AS (SELECT * FROM whole UNION ALL
        SELECT rowid_, nth, line, id FROM (SELECT rowid_, nth, line, {norm} AS sentence FROM l)
        JOIN known USING (sentence)),
found AS (SELECT rowid_, ',' || string_agg(id || ',', '' ORDER BY nth, line) AS sentence_ids
          FROM ids GROUP BY rowid_),
hits AS ({' UNION ALL '.join(parts)}),
named AS (SELECT rowid_, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
                 count(*) AS n_rules FROM hits GROUP BY rowid_)
SELECT doc_id, coalesce(sentence_ids, ',') AS sentence_ids, coalesce(licenses, '') AS licenses,
       coalesce(n_rules, 0)::BIGINT AS n_rules
FROM d LEFT JOIN found USING (rowid_) LEFT JOIN named USING (rowid_)"""


ORACLE = _oracle()
