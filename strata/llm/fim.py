"""Fill-in-the-middle: whole texts cut at two token ranks, found through indexable skip lists.

A text's units are the runs of A-Z and a-z and each other code point. Over a text's units stands a
skip list: every link of a lane carries how many units and how many code points it passes,
and a link of an express lane passes ``FAN`` links of the lane below. A cut rank is reached
from the top lane down, by links while the accumulated units do not pass the rank; the code
points passed on the way are the cut. Both ranks and the form are drawn from a hash of the
document's id, so reruns agree. Python finds the two cuts; Spark's own string functions build the
output and take it apart again.

Null text counts as empty; an empty text, and one that holds a sentinel, stays plain. A null
id draws as an empty one; repeated rows get equal results. Texts are cut whole, whatever
their length; memory is a small multiple of one text and a batch of rows. Empty tables
give empty results, other columns are ignored (``transform`` takes only id and text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents

SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM_RATE = 1, 90, 20
FAN = 32


class SkipList:
    """Lanes of links over units; a link is (units passed, code points passed)."""

    def __init__(self, widths: np.ndarray, fan: int = FAN):
        self.fan, self.lanes = fan, [(np.ones(len(widths), np.int64), widths)]
        while len(self.lanes[-1][0]) > fan:
            units, chars = self.lanes[-1]
            at = np.arange(0, len(units), fan)
            self.lanes.append((np.add.reduceat(units, at), np.add.reduceat(chars, at)))

    def reach(self, rank: int) -> int:
        """Code points before the unit of that rank (all of them for the number of units)."""
        at = units = chars = 0
        for lane_units, lane_chars in reversed(self.lanes):
            at *= self.fan
            passed = np.cumsum(lane_units[at:at + self.fan])
            links = int(np.searchsorted(passed, rank - units, "right"))
            if links:
                units += int(passed[links - 1])
                chars += int(lane_chars[at:at + links].sum())
            at += links
        return chars


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit of a text, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = points | 0x20
    letter = (folded >= 0x61) & (folded <= 0x7A)
    first = ~letter
    first[1:] |= ~letter[:-1]
    first[:1] = True
    return np.diff(np.append(np.flatnonzero(first), len(points))).astype(np.int64)


def cut(text: str, h1: int, h2: int) -> tuple[int, int, int]:
    """(units, code points of the prefix, code points of the middle) of a text."""
    widths = unit_widths(text)
    n = len(widths)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    lanes = SkipList(widths)
    a = lanes.reach(low)
    return n, a, lanes.reach(high) - a


def _cuts():
    """A column function: text and two draws to the struct of :func:`cut`."""

    @F.pandas_udf("n long, prefix_chars long, middle_chars long")
    def cuts(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([cut(*row) for row in zip(*part)],
                               columns=["n", "prefix_chars", "middle_chars"], dtype="int64")

    return cuts


def _draw(digest: Column, k: int) -> Column:
    """The ``k``-th group of eight hex digits, as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must not overlap one another, or an output could be read in two ways."""
    for a in sentinels:
        for b in sentinels:
            if not a or (a != b and a in b) or any(
                    a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels {sentinels} overlap")
    if len(set(sentinels)) < 3:
        raise ValueError(f"sentinels {sentinels} are not three")


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              rate: int = RATE, spm_rate: int = SPM_RATE,
              sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """One row per row of ``df``: doc_id, n, form, prefix_chars, middle_chars, output.

    ``rate`` of 100 documents are cut, ``spm_rate`` of 100 of those suffix first.
    """
    _check(sentinels)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    known = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"),
                     F.sha2(F.concat(F.lit(f"{seed}:"), known), 256).alias("digest"))
    rows = rows.withColumn("cuts", _cuts()("text", _draw(F.col("digest"), 0),
                                           _draw(F.col("digest"), 1)))
    held = F.lit(False)
    for s in sentinels:
        held = held | F.contains("text", F.lit(s))
    form = (F.when((F.col("text") == "") | held | (_draw(F.col("digest"), 2) % 100 >= rate), "plain")
            .when(_draw(F.col("digest"), 3) % 100 < spm_rate, "spm").otherwise("psm"))
    p, s, m = (F.lit(x) for x in sentinels)
    a, b = F.col("cuts.prefix_chars").cast("int"), F.col("cuts.middle_chars").cast("int")
    prefix, middle = F.substring("text", F.lit(1), a), F.substring("text", a + 1, b)
    suffix = F.substring("text", a + b + 1, F.char_length("text"))
    output = (F.when(F.col("form") == "plain", F.col("text"))
              .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
              .otherwise(F.concat(p, prefix, s, suffix, m, middle)))
    cut_only = lambda c: F.when(F.col("form") != "plain", F.col(f"cuts.{c}"))
    return rows.withColumn("form", form).select(
        "doc_id", F.col("cuts.n").alias("n"), "form",
        cut_only("prefix_chars").alias("prefix_chars"),
        cut_only("middle_chars").alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column,
            sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made from."""
    p, s, m = sentinels
    end = F.char_length(output)

    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows the sentinel at the head, the second one, and the last one."""
        i, j = F.instr(output, second), F.instr(output, m)
        return (F.substring(output, F.lit(len(first) + 1), i - len(first) - 1),
                F.substring(output, i + len(second), j - i - len(second)),
                F.substring(output, j + len(m), end))

    prefix, suffix, middle = between(p, s)
    suffix2, prefix2, middle2 = between(s, p)
    return (F.when(form == "plain", output)
            .when(form == "spm", F.concat(prefix2, middle2, suffix2))
            .otherwise(F.concat(prefix, middle, suffix)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transform(documents(spark, sf_dir))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256)
                      .alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
             ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
      FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                       OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
             array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
           AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
