"""Benchmark decontamination with a distributed positional inverted index.

The index stores every training word's postings: documents are dealt into segments of whole
texts, and a row holds one term of one segment with its sorted positions there; a segment's
words are numbered through, with a free number after each document. Test items are cut into
windows of words. Of each segment only the lists of test terms are read and brought together.
There, every window starts from the list of its rarest term in the segment, shifted by the
term's offset in the window, and intersects it with the shifted lists of its other terms, next rarest
first, by binary search, until no start is left or all terms agree: an exact phrase match.
A proximity match asks that some stretch of ``slop`` words more than the window holds all
its words, in any order; it starts from the rarest term as well.

Distinct windows are matched once, in blocks of ``BLOCK`` (a test set of any size is met by
all of the index, block by block). A segment holds ``SEGMENT`` bytes of text, or one longer
text; nothing else bounds a list, so a word or passage in every document is met like any other.

Null text has no words; a document or item without words has no match (an item with fewer
words than a window is one window). Items count by their id: rows that repeat an id are one
item, and a null id counts as one item with an empty name. Repeated documents get equal rows.
Empty tables give empty results or no matches; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents, slot, small
from strata.llm.words import slices, split_words, words_of

WINDOW, SLOP = 10, 2
SEGMENT, BLOCK = 4 << 20, 100_000
#: The term of a segment's directory row: its positions are its documents' numbers of words.
DIRECTORY = ""


def build_index(scratch: Scratch, df: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The staged index: (segment, term, positions, ids); ``ids`` on directory rows only."""

    def postings(batches):
        made = itertools.count(TaskContext.get().partitionId() << 33)
        for part in slices(batches, "text", segment):
            ids, texts = part.column(0), part.column(1)
            words, counts = split_words(texts)
            coded = pc.dictionary_encode(words)
            code = coded.indices.to_numpy(zero_copy_only=False)
            # a free number after each document: no phrase runs from one into the next
            at = np.arange(len(code)) + np.repeat(np.arange(len(counts)), counts)
            order = np.argsort(code, kind="stable")
            ends = np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))
            n = len(ends) + 1
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], [len(counts)], len(counts) + ends)), pa.int32()),
                pa.array(np.concatenate((counts, at[order])), pa.int32()))
            no_ids = np.full(n + 1, len(ids), np.int32)
            no_ids[0] = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, next(made)), pa.int64()),
                 pa.concat_arrays([pa.array([DIRECTORY], pa.string()),
                                   coded.dictionary.cast(pa.string())]),
                 lists, pa.ListArray.from_arrays(pa.array(no_ids), ids)],
                names=["segment", "term", "positions", "ids"])

    rows = df.select(F.col(f"`{id_col}`").alias("id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("segment", T.LongType()), T.StructField("term", T.StringType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType))])
    return scratch.stage(rows.mapInArrow(postings, schema), "index")


def windows(scratch: Scratch, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
            size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, terms), and which items (wid, item) have them."""
    cut = (items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
                        words_of(F.col(f"`{text_col}`")).alias("words"))
           .filter(F.size("words") > 0)
           .select("item", "words", F.explode(F.sequence(
               F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))).alias("first"))
           .select("item", F.slice("words", F.col("first"), F.lit(size)).alias("terms"))
           .distinct())
    cut = scratch.stage(cut, "cut")
    known = scratch.stage(cut.select("terms").distinct()
                          .withColumn("wid", F.monotonically_increasing_id()), "windows")
    return known, scratch.stage(cut.join(known, "terms").select("wid", "item"), "items")


class _Lists:
    """The test terms' posting lists of one segment."""

    def __init__(self, table: pa.Table, vocabulary: pa.Array):
        terms = table.column("term").combine_chunks()
        lists = table.column("positions").combine_chunks()
        where = pc.index_in(terms, vocabulary).to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        head = pc.equal(terms, DIRECTORY).to_numpy(zero_copy_only=False)
        self.counts = flat[np.repeat(head, sizes)]
        term = where[~head].astype(np.int64)
        self.size = np.zeros(len(vocabulary), np.int64)
        self.size[term] = sizes[~head]
        keys = (np.repeat(term, sizes[~head]) << 32) | flat[~np.repeat(head, sizes)]
        self.keys = np.sort(keys)  # lists one after another, each sorted
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        self.ends = np.cumsum(self.counts + 1) - 1  # the free number after each document

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All postings of several terms: (which of ``terms``, position)."""
        sizes = self.size[terms]
        which = np.repeat(np.arange(len(terms)), sizes)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return which, self.keys[self.first[terms][which] + inner] & 0xFFFFFFFF

    def next(self, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The first posting of each term at or after its position, or a far number."""
        asked = (terms << 32) | at
        found = np.searchsorted(self.keys, asked)
        key = self.keys[np.minimum(found, len(self.keys) - 1)]
        return np.where((found < len(self.keys)) & (key >> 32 == terms), key & 0xFFFFFFFF, 1 << 40)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")


def _by_rarity(lists: _Lists, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows whose terms the segment has all, and their offsets from the rarest term on."""
    sizes = np.where(matrix >= 0, lists.size[matrix], 1 << 60)
    able = np.flatnonzero((sizes > 0).all(1))
    return able, np.argsort(sizes[able], axis=1, kind="stable")


def phrase_starts(lists: _Lists, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every exact occurrence; ``matrix`` has a row of term numbers for
    each window, filled up with -1."""
    able, order = _by_rarity(lists, matrix)
    if not len(able):
        return able, able
    which, at = lists.of(matrix[able, order[:, 0]])
    start = at - order[which, 0]
    for k in range(1, matrix.shape[1]):
        live = start >= 0
        which, start = which[live], start[live]
        offset = order[which, k]
        term = matrix[able[which], offset]
        seek = start + offset
        same = (term < 0) | (lists.next(np.maximum(term, 0), seek) == seek)
        which, start = which[same], start[same]
    live = start >= 0
    return able[which[live]], start[live]


def near_starts(lists: _Lists, matrix: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of stretches, ``slop`` words longer than the window, that begin with
    one of its words and hold all of them in any order (repeated words count once)."""
    able, order = _by_rarity(lists, matrix)
    if not len(able):
        return able, able
    span = (matrix >= 0).sum(1) + slop
    which, at = lists.of(matrix[able, order[:, 0]])
    for k in range(1, matrix.shape[1]):  # each word within reach of the rarest one
        term = matrix[able[which], order[which, k]]
        reach = span[able[which]] - 1
        low = np.maximum(at - reach, 0)
        some = (term < 0) | (lists.next(np.maximum(term, 0), low) <= at + reach)
        which, at = which[some], at[some]
    wid, found = [], []
    for back in range(int(span.max())):  # each stretch that holds the rarest word's posting
        start = at - back
        live = (start >= 0) & (back < span[able[which]])
        w, s = able[which[live]], start[live]
        first = np.full(len(s), 1 << 40)
        last = s.copy()
        for k in range(matrix.shape[1]):
            term = matrix[w, k]
            seen = lists.next(np.maximum(term, 0), s)
            first = np.where(term >= 0, np.minimum(first, seen), first)
            last = np.where(term >= 0, np.maximum(last, seen), last)
        whole = (first == s) & (last < s + span[w])
        whole[whole] &= lists.document(s[whole]) == lists.document(last[whole])
        wid.append(w[whole])
        found.append(s[whole])
    pairs = np.unique(np.stack([np.concatenate(wid), np.concatenate(found)]), axis=1)
    return pairs[0], pairs[1]


def _seeker(vocabulary: pa.Array, matrix: np.ndarray, wids: np.ndarray, slop: int | None):
    """The function that matches a block's windows in one segment's lists."""

    def seek(table: pa.Table) -> pa.Table:
        lists = _Lists(table, vocabulary)
        kinds = [(False, *phrase_starts(lists, matrix))]
        if slop is not None:
            kinds.append((True, *near_starts(lists, matrix, slop)))
        w = np.concatenate([k[1] for k in kinds]).astype(np.int64)
        at = np.concatenate([k[2] for k in kinds]).astype(np.int64)
        near = np.repeat([k[0] for k in kinds], [len(k[1]) for k in kinds])
        doc = lists.document(at)
        begins = np.concatenate(([0], lists.ends + 1))
        segment = table.column("segment")[0].as_py()
        return pa.table([
            pa.array(np.full(len(w), segment), pa.int64()), pa.array(doc, pa.int32()),
            pa.array(wids[w], pa.int64()), pa.array(near), pa.array(at - begins[doc], pa.int32()),
            pa.array((matrix[w] >= 0).sum(1), pa.int32())],
            names=["segment", "doc", "wid", "near", "start", "n"])

    return seek


MATCHES = "segment long, doc int, wid long, near boolean, start int, n int"


def match(scratch: Scratch, index: DataFrame, known: DataFrame, slop: int | None = SLOP,
          block: int = BLOCK) -> DataFrame:
    """Staged exact matches, and proximity matches unless ``slop`` is None:
    (segment, doc, wid, near, start, n), ``doc`` being the place in the segment and ``n`` the
    window's words; ``start`` counts words of the document."""
    blocks = -(-known.count() // block)
    out = None
    for b in range(blocks):
        part = known.filter(slot(F.col("wid"), "block", blocks) == b).orderBy("wid")
        table = part.select("wid", "terms").toArrow()
        vocabulary = pc.unique(table.column("terms").combine_chunks().flatten())
        sizes = pc.list_value_length(table.column("terms")).to_numpy()
        code = pc.index_in(table.column("terms").combine_chunks().flatten(), vocabulary)
        matrix = np.full((len(sizes), max(sizes, default=1)), -1, np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = \
            code.to_numpy(zero_copy_only=False)
        wids = table.column("wid").to_numpy()
        spread = F.explode("terms").alias("term")
        wanted = scratch.stage(part.select(spread).union(known.sparkSession.createDataFrame(
            [(DIRECTORY,)], "term string")).distinct(), "vocabulary")

        found = (index.select("segment", "term", "positions")
                 .join(small(wanted), "term", "left_semi")
                 .groupBy("segment").applyInArrow(_seeker(vocabulary, matrix, wids, slop), MATCHES))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = known.sparkSession.createDataFrame([], MATCHES)
    return scratch.stage(out, "matches")


def contamination(spark: SparkSession, df: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", size: int = WINDOW,
                  slop: int = SLOP) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, n_hit, n_items, items (ids as sorted
    strings), contaminated, n_near (items of which the document holds a proximity match)."""
    scratch = Scratch(spark, "decontaminate")
    index = build_index(scratch, df, id_col, text_col)
    known, owners = windows(scratch, items, item_id_col, item_text_col, size)
    found = match(scratch, index, known, slop)

    exact = found.filter("not near")
    inside = Window.partitionBy("segment", "doc").orderBy("start", "n")
    before = F.max(F.col("start") + F.col("n")).over(
        inside.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("n")
                       - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    hit = (exact.select("segment", "doc", fresh.alias("fresh"))
           .groupBy("segment", "doc").agg(F.sum("fresh").alias("n_hit")))
    by_item = (found.select("segment", "doc", "wid", "near").distinct()
               .join(small(owners), "wid").select("segment", "doc", "near", "item").distinct()
               .groupBy("segment", "doc").agg(
                   F.sort_array(F.collect_list(F.when(~F.col("near"), F.col("item"))))
                   .alias("items"),
                   F.count_if("near").alias("n_near")))
    marks = scratch.stage(by_item.join(hit, ["segment", "doc"], "left"), "marks")

    directory = (index.filter(F.col("term") == DIRECTORY)
                 .select("segment", F.posexplode(F.arrays_zip("ids", "positions"))
                         .alias("doc", "d"))
                 .select("segment", "doc", F.col("d.ids").alias("doc_id"),
                         F.col("d.positions").cast("long").alias("n_words")))
    return (directory.join(small(marks), ["segment", "doc"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(spark, documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      "contaminated", "n_near")


#: Exact phrases by text comparison of all 10-word runs, and proximity by positions.
ORACLE = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
bw AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item, words[i:i + 9] AS terms
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
        FROM bw WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT len(terms) AS n FROM win),
runs AS (
  SELECT doc_id, i AS start, n, words[i:i + n - 1] AS terms
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM dw, sizes
        WHERE len(words) >= n)),
hits AS (
  SELECT doc_id, start, n, item FROM runs JOIN win USING (terms)),
words_hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + n)) AS place FROM hits) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id),
stretch AS (
  SELECT DISTINCT doc_id, i AS start, words[i:i + 11] AS held
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM dw)),
near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near FROM (
    SELECT s.doc_id, w.item
    FROM (SELECT doc_id, start, held, unnest(list_distinct(held)) AS word FROM stretch) s
    JOIN (SELECT item, terms, unnest(list_distinct(terms)) AS word FROM win) w USING (word)
    WHERE len(w.terms) = 10
    GROUP BY s.doc_id, s.start, w.item, w.terms
    HAVING count(*) = len(list_distinct(w.terms))) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM dw LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
        LEFT JOIN near USING (doc_id)
"""
