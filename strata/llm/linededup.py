"""Line deduplication by pairwise alignment of overlapping documents.

Lines are compared by two 64-bit hashes of their text without outer white space; lines
without a word match nothing. Of the documents that hold a line, the earliest (smallest
id) owns it. A rare line (in ``RARE`` documents at most) links each later document with
its owner. Where the line stays, as it does not align there, the document is linked with
the 2, 4, 8, ... next earliest holders that it has not been compared with, round by round
until the line goes or no earlier holder is left: so links follow the lines that stay, and
are all pairs of a line's documents only if it aligns in none of them. Each linked pair is aligned whole by patience diff: lines unique in both documents, in their
longest increasing order, are anchors, between which equal lines are aligned again; a range
without such lines is aligned by a longest common subsequence, in linear space. The
aligned common blocks go from the later document. A line in more documents than that is
no evidence that two documents overlap and needs no partner to compare with: each such
line is a block by itself, aligned with its first place in its owner, and goes from all
later documents directly. So no line's group is ever gathered, and none is left out; but a
rare line whose order crosses in every pair stays, which a common line does not.

Null and empty texts have no lines to lose and stay as they are (null as null). Null ids
come last; rows of equal ids are ordered by their texts' hash, so of repeated rows one
keeps its lines. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, documents, small

RARE = 100
_MASKS = 1 << 25
_BLANK = " \\t\\n\\x0b\\f\\r"


def _masks(b: list) -> Callable[[object], int]:
    """The places in ``b`` of a line as the bits of an integer; at most ``_MASKS`` bytes are kept."""
    where, wide = defaultdict(list), len(b) // 8 + 1
    for j, x in enumerate(b):
        where[x].append(j)

    def mask(x) -> int:
        bits = bytearray(wide)
        for j in where.get(x, ()):
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    often = sorted(where, key=lambda x: -len(where[x]))[:_MASKS // wide]
    kept = {x: mask(x) for x in often}
    return lambda x: kept[x] if x in kept else mask(x)


def _steps(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` with each prefix of ``b``, by bits."""
    mask, ones = _masks(b), (1 << len(b)) - 1
    v = ones
    for x in a:
        u = v & mask(x)
        v = ((v + u) | (v - u)) & ones
    grow = np.frombuffer((ones ^ v).to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    return np.append(0, np.cumsum(np.unpackbits(grow, bitorder="little")[:len(b)], dtype=np.int64))


def _longest(a: list, b: list, alo: int, ahi: int, blo: int, bhi: int) -> list[tuple[int, int]]:
    """A longest common subsequence of two ranges, halved in linear space (Hirschberg)."""
    in_a, in_b = set(a[alo:ahi]), set(b[blo:bhi])
    at_a = [i for i in range(alo, ahi) if a[i] in in_b]
    at_b = [j for j in range(blo, bhi) if b[j] in in_a]
    a, b = [a[i] for i in at_a], [b[j] for j in at_b]
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        if alo == ahi or blo == bhi:
            continue
        if ahi - alo == 1:
            j = next((j for j in range(blo, bhi) if b[j] == a[alo]), None)
            if j is not None:
                out.append((at_a[alo], at_b[j]))
            continue
        mid = (alo + ahi) // 2
        head = _steps(a[alo:mid], b[blo:bhi])
        tail = _steps(a[mid:ahi][::-1], b[blo:bhi][::-1])[::-1]
        cut = blo + int((head + tail).argmax())
        todo += [(alo, mid, blo, cut), (mid, ahi, cut, bhi)]
    return out


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned (place in a, place in b) of equal lines, in order in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        ones_a, ones_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
        where = {x: j for j, x in enumerate(b[blo:bhi], blo) if ones_b[x] == 1}
        both = [(i, where[x]) for i, x in enumerate(a[alo:ahi], alo)
                if ones_a[x] == 1 and x in where]
        if not both:
            out += _longest(a, b, alo, ahi, blo, bhi)
            continue
        tops, piles, back = [], [], []
        for i, j in both:  # the longest increasing run of places in b
            k = bisect_left(tops, j)
            back.append(piles[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                piles.append(len(back) - 1)
            else:
                tops[k], piles[k] = j, len(back) - 1
        at, anchors = piles[-1], []
        while at is not None:
            anchors.append(both[at])
            at = back[at]
        anchors.reverse()
        edge = (alo, blo)
        for i, j in anchors:
            out.append((i, j))
            todo.append((edge[0], i, edge[1], j))
            edge = (i + 1, j + 1)
        todo.append((edge[0], ahi, edge[1], bhi))
    return sorted(out)


def _align(batches):
    for batch in batches:
        rids, mine, theirs = (batch.column(i).to_pylist() for i in range(3))
        out_rid, out_at = [], []
        for rid, a, b in zip(rids, mine, theirs):
            a = [(x["h1"], x["h2"]) if x["word"] else (k, None) for k, x in enumerate(a)]
            b = [(x["h1"], x["h2"]) if x["word"] else (k, "") for k, x in enumerate(b)]
            for i, _ in patience(a, b):
                out_rid.append(rid)
                out_at.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(out_rid, pa.int64()),
                                          pa.array(out_at, pa.int32())], names=["rid", "at"])


def _aligned(pairs: DataFrame, hashed: DataFrame) -> DataFrame:
    """(rid, at): places of the later documents that align with the other one of their pair."""
    return (pairs.join(hashed.select("rid", F.col("lines").alias("mine")), "rid")
            .join(hashed.select(F.col("rid").alias("owner"), F.col("lines").alias("theirs")),
                  "owner").select("rid", "mine", "theirs")
            .mapInArrow(_align, "rid long, at int"))


def _next_links(left: DataFrame, held: DataFrame, pairs: DataFrame, reach: int) -> DataFrame:
    """(rid, owner, owner_id): for each line that stays in a document, the ``reach`` earliest of
    its earlier holders that the document has not been compared with."""
    lines = left.select("h1", "h2", "rid", "rank").distinct()
    others = held.select("h1", "h2", F.col("rid").alias("owner"), F.col("rank").alias("other"))
    nearest = Window.partitionBy("h1", "h2", "rid").orderBy("other")
    return (others.join(small(lines), ["h1", "h2"]).filter("other < rank")
            .join(small(pairs.select("rid", "owner")), ["rid", "owner"], "left_anti")
            .withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= reach)
            .select("rid", "owner", F.col("other.doc_id").alias("owner_id")))


def dedup_lines(spark: SparkSession, df: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", rare: int = RARE) -> DataFrame:
    """One row per row of ``df``: doc_id, text (without the lines), n_lines, n_removed,
    partners (ids of the earlier documents it was aligned with, ascending)."""
    scratch = Scratch(spark, "lines")
    text = F.col(text_col).cast("string")
    rows = scratch.stage(df.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn(
        "rid", F.monotonically_increasing_id()), "rows")
    line = lambda s: F.regexp_replace(s, f"^[{_BLANK}]+|[{_BLANK}]+$", "")
    cut = F.transform(F.split("text", "\n"), line)
    hashed = rows.filter("text is not null").select("rid", "doc_id", F.transform(
        cut, lambda s: F.struct(F.xxhash64(s).alias("h1"), F.xxhash64(F.lit(1), s).alias("h2"),
                                (F.length(s) > 0).alias("word"))).alias("lines"),
        F.xxhash64(F.lit(7), "text").alias("body"))
    hashed = scratch.stage(hashed.withColumn("rank", F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("body"), F.col("rid"))),
        "hashed")
    lines = (hashed.select("rid", "rank", F.posexplode("lines").alias("at", "x"))
             .filter("x.word").select("rid", "rank", "at", "x.h1", "x.h2"))
    held = scratch.stage(lines.groupBy("h1", "h2", "rid").agg(
        F.min("rank").alias("rank"), F.collect_list("at").alias("at")), "held")
    shared = scratch.stage(
        held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("owner"))
        .filter("n > 1"), "shared")
    later = scratch.stage(held.join(small(shared), ["h1", "h2"]).filter("rid <> owner.rid"),
                          "later")
    common = later.filter(F.col("n") > rare).select("rid", F.explode("at").alias("at"))
    links = later.filter(F.col("n") <= rare).select(
        "rid", F.col("owner.rid").alias("owner"), F.col("owner.doc_id").alias("owner_id"))
    left = later.filter(F.col("n") <= rare).select("h1", "h2", "rid", "rank",
                                                   F.explode("at").alias("at"))
    pairs = aligned = None
    reach = 1
    while True:
        new = scratch.stage(links.distinct(), "pairs")
        if pairs is not None and new.isEmpty():
            break
        cut = scratch.stage(_aligned(new, hashed), "aligned")
        pairs = new if pairs is None else pairs.unionByName(new)
        aligned = cut if aligned is None else aligned.unionByName(cut)
        left = scratch.stage(left.join(small(cut), ["rid", "at"], "left_anti"), "left")
        reach *= 2
        links = _next_links(left, held, pairs, reach)
    at_type = pairs.schema["owner_id"].dataType
    marks = (aligned.unionByName(common).distinct()
             .select("rid", "at", F.lit(None).cast(at_type).alias("owner_id"))
             .unionByName(pairs.select("rid", F.lit(None).cast("int").alias("at"), "owner_id")))
    changes = scratch.stage(marks.groupBy("rid").agg(
        F.array_sort(F.collect_list("at")).alias("gone"),
        F.array_sort(F.collect_list("owner_id")).alias("partners")), "changes")
    kept = F.array_join(F.filter(F.split("text", "\n"),
                                 lambda s, i: ~F.array_contains("gone", i)), "\n")
    none = F.array().cast(changes.schema["partners"].dataType)
    # Most documents can lose lines, so this one join of texts is a shuffle at every size.
    return rows.join(changes.hint("shuffle_merge"), "rid", "left").select(
        "doc_id", F.when(F.size("gone") > 0, kept).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("partners", none).alias("partners"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spark, documents(spark, sf_dir))
