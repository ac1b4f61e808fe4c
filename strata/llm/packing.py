"""Best-fit packing of token sequences by a configuration linear program.

Documents become pieces (only longer ones than a sequence are cut), whose lengths make a
histogram of at most ``CAPACITY`` rows: all that the driver sees. Over it, the
configuration LP (fewest patterns that cover every length's count) is solved by
multiplicative weights: lengths that lag behind weigh more, and a knapsack dynamic program
prices patterns, giving for each length the best pattern that holds it. The fractional
solution is rounded systematically, never above a length's count; what is left goes
through the LP again while it is large, and then best-fit decreasing. The plan says for
each length which ranks go to which pattern and place, so its size depends on lengths
and patterns alone; pieces are ranked among those of their length by counts per
partition and length, and each finds its sequence and offset by its rank.

Null text is empty: one end token. Ids keep their type; a null id is an id like any other.
Repeated rows are packed as often as they stand. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents, small, texts
from strata.llm.tokens import Encoder

CAPACITY, END = 4096, 1
EPOCHS, STEP, SLACK, RATE, TRIES = 40, 0.25, 0.01, 0.5, 4
#: Pieces that best-fit decreasing may place on the driver after rounding.
REST = 200_000
#: Columns of a piece beside its document's id, in Spark's types and in Arrow's.
_PIECE = {"piece": (T.IntegerType(), pa.int32()), "start": (T.LongType(), pa.int64()),
          "length": (T.LongType(), pa.int64()), "ids_crc32": (T.LongType(), pa.int64()),
          "part": (T.IntegerType(), pa.int32()), "nth": (T.LongType(), pa.int64())}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- the plan, on the histogram of lengths ---------------------------------

def price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack: the best value of each capacity, and the last item put there (-1: a gap)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            worth = best[c - lengths[:k]] + value[:k]
            i = int(worth.argmax())
            if worth[i] > best[c]:
                best[c], last[c] = worth[i], i
    return best, last


def _patterns(lengths, value, demand, capacity, draw):
    """(pattern, item) pairs of one pattern per length, each within ``SLACK`` of the best.

    A pattern starts with its length. Then items are drawn by the demand that is left and
    taken if the table says that the best of the remaining capacity can still be had; after
    ``TRIES`` misses the table's own item is taken. So patterns differ, as all good ones must.
    """
    best, last = price(lengths, value, capacity)
    ends = np.maximum.accumulate(np.where(last >= 0, np.arange(capacity + 1), 0))
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    chance = np.concatenate(([0.0], np.cumsum(demand)))
    who, free = np.arange(len(lengths)), ends[capacity - lengths]
    pairs = [(who, who)]
    loss = np.zeros(len(lengths))
    while True:
        on = free > 0
        who, free = who[on], free[on]
        if not len(who):
            break
        item = last[free]
        open_ = np.arange(len(who))
        for _ in range(TRIES):
            room = free[open_]
            pick = np.searchsorted(chance, draw.random(len(room)) * chance[upto[room]],
                                   side="right") - 1
            pick = np.minimum(pick, upto[room] - 1)
            miss = loss[who[open_]] + best[room] - value[pick] - best[room - lengths[pick]]
            hit = miss <= SLACK * best[capacity]
            item[open_[hit]] = pick[hit]
            open_ = open_[~hit]
        left = free - lengths[item]
        loss[who] += best[free] - value[item] - best[left]
        pairs.append((who, item))
        free = ends[left]
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _fractional(lengths, counts, capacity) -> list[tuple[tuple, float]]:
    """Multiplicative weights: patterns as ((item, times), ...) with their shares.

    The more of a length's count is covered, the less it is worth. An epoch's patterns are
    near the best price and cover no length by more than ``STEP`` of its count.
    """
    covered, found = np.zeros(len(lengths)), []
    draw = np.random.default_rng(0)
    for _ in range(EPOCHS):
        lag = covered.min()
        if lag >= 1:
            break
        value = lengths * np.exp(-RATE * np.minimum(covered - lag, 1.0))
        who, item = _patterns(lengths, value, counts * np.maximum(1 - covered, 1e-9), capacity,
                              draw)
        good = covered < 1
        keep = good[who]
        who, item = who[keep], item[keep]
        use = np.bincount(item, minlength=len(lengths))
        share = np.full(len(lengths), np.inf)
        np.minimum.at(share, who, STEP * counts[item] / use[item])
        covered += np.bincount(item, share[who], minlength=len(lengths)) / counts
        order = np.lexsort((item, who))
        who, item = who[order], item[order]
        start = np.flatnonzero(np.diff(who * len(lengths) + item, prepend=-1))
        times = np.diff(start, append=len(who))
        rows = list(zip(item[start].tolist(), times.tolist()))
        cut = np.flatnonzero(np.diff(who[start], prepend=-1)).tolist()
        for lo, hi in zip(cut, [*cut[1:], len(rows)]):
            found.append((tuple(rows[lo:hi]), float(share[who[start[lo]]])))
    return found


def _best_fit(lengths, counts, capacity) -> list[tuple[dict, int]]:
    """Best-fit decreasing; equal bins are one entry."""
    free, bins, heap = [], {}, {}
    for length, n in sorted(zip(lengths, counts), reverse=True):
        for _ in range(n):
            k = bisect.bisect_left(free, length)
            if k == len(free):
                left, inside = capacity, ()
            else:
                left = free[k]
                inside = heap[left].pop()
                if not heap[left]:
                    free.pop(k)
            left, inside = left - length, (*inside, length)
            if left in heap and heap[left]:
                heap[left].append(inside)
            else:
                heap[left] = [inside]
                bisect.insort(free, left)
    for stack in heap.values():
        for inside in stack:
            bins[inside] = bins.get(inside, 0) + 1
    return [({x: inside.count(x) for x in inside}, n) for inside, n in bins.items()]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict, int]]:
    """[(pattern as length -> times, sequences)], each length used exactly as often as it is."""
    out, left = [], {k: n for k, n in histogram.items() if n > 0}
    if capacity in left:
        out.append(({capacity: 1}, left.pop(capacity)))
    while left:
        lengths = np.array(sorted(left), np.int64)
        counts = np.array([left[int(k)] for k in lengths], np.int64)
        before, total = int(counts.sum()), 0.0
        shares = _fractional(lengths, counts.astype(float), capacity)
        shares.sort(key=lambda s: (-sum(int(lengths[i]) * a for i, a in s[0]), s[0]))
        for pattern, share in shares:
            times, total = int(total + share + 0.5) - int(total + 0.5), total + share
            times = min([times, *(int(counts[i]) // a for i, a in pattern)])
            if times > 0:
                for i, a in pattern:
                    counts[i] -= a * times
                out.append(({int(lengths[i]): a for i, a in pattern}, times))
        left = {int(k): int(n) for k, n in zip(lengths, counts) if n}
        rest = int(counts.sum())
        if rest <= REST or rest == before:
            out += _best_fit([int(k) for k in left], [left[k] for k in left], capacity)
            break
    return out


class Places:
    """(length, rank) -> (sequence, offset) by a plan."""

    def __init__(self, patterns: list[tuple[dict, int]]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for pattern, times in patterns:
            offset = 0
            for length, a in sorted(pattern.items(), reverse=True):
                lo = used.get(length, 0)
                rows.append((length, lo, a, sequence, offset))
                used[length] = lo + a * times
                offset += a * length
            sequence += times
        rows.sort()
        t = np.array(rows, np.int64).reshape(-1, 5)
        self.key = (t[:, 0] << 44) + t[:, 1]
        self.lo, self.times, self.sequence, self.offset = t[:, 1], t[:, 2], t[:, 3], t[:, 4]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        k = rank - self.lo[at]
        return (self.sequence[at] + k // self.times[at],
                self.offset[at] + (k % self.times[at]) * length)


# --- the distributed part ---------------------------------------------------

def pieces(df: DataFrame, path: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """One row per piece, with its place among its partition's pieces of that length."""

    def cut(batches):
        encoder, seen, part = Encoder(path), np.zeros(capacity + 1, np.int64), -1
        for batch, bodies in texts(batches, "text"):
            part = TaskContext.get().partitionId()
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), bodies):
                ids = encoder.encode(text) + END.to_bytes(4, "little")
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc, k, at // 4, n, zlib.crc32(own), part, int(seen[n])))
                    seen[n] += 1
            values = zip(*out) if out else [[] for _ in range(1 + len(_PIECE))]
            types = (batch.column(0).type, *(t for _, t in _PIECE.values()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(values, types)],
                                             names=["doc_id", *_PIECE])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"],
                           *(T.StructField(c, t) for c, (t, _) in _PIECE.items())])
    return rows.mapInArrow(cut, schema)


def pack(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = Scratch(spark, "packing")
    rows = scratch.stage(pieces(df, path or tokenizer_path(), id_col, text_col, capacity),
                         "pieces")
    counts = scratch.stage(rows.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")),
                           "counts")
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    base = scratch.stage(counts.select("part", "length", F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("base")), "base")

    @F.pandas_udf("sequence_id long, offset long")
    def place(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, rank in parts:
            sequence, offset = places.find(length.to_numpy(), rank.to_numpy())
            yield pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (rows.join(small(base), ["part", "length"])
            .withColumn("at", place("length", F.col("base") + F.col("nth")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id",
                    "at.offset"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, documents(spark, sf_dir))
