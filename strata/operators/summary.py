"""Typed summaries of any columns, with quantiles from mergeable sketches.

One pass gives counts, nulls, bounds and moments of every column, text included, and a KLL
quantile sketch of every number: bounded size, partial per task, merged on the way. A sketch's quantile
has a rank error of ``rank_error(k)``. Where exact quantiles are wanted, the sketch only says
between which two values each one lies; a second pass counts the rows below that bracket and
sketches inside it, and so on until a bracket has few distinct values, which are counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import col

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
QUARTILES = (0.25, 0.5, 0.75)
SKETCH_K = 1024
#: Distinct values of a bracket that are counted one by one rather than sketched again.
COUNTED = 100_000
#: Steps of the grid of quantiles that narrows a bracket.
GRID = 256


def rank_error(k: int) -> float:
    """Normalised rank error that a KLL sketch of size ``k`` keeps in 99 of 100 cases
    (single-sided; the library's published fit, 1.33 % at 200)."""
    return 2.296 / k ** 0.9021


def _is_number(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMBERS)


def _value(c: str) -> Column:
    """A number as the sketch takes it: a double that is not NaN, else null."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _sketch(x: Column, k: int) -> Column:
    return F.call_function("kll_sketch_agg_double", x, F.lit(k))


def _name(q: float) -> str:
    return f"q{q * 100:g}".replace(".", "_")


def summarize(df: DataFrame, columns: Sequence[str] | None = None,
              quantiles: Sequence[float] = QUARTILES, exact: bool = False, digits: int = 4,
              k: int = SKETCH_K) -> DataFrame:
    """One row per column: ``column_name, count, nulls, mean, stddev, min, max`` (numbers),
    ``min_text, max_text`` (everything else that has an order), and one column per quantile.

    ``q25`` is the smallest value with at least a quarter of the column's values at or below it,
    exactly so with ``exact``, else within ``rank_error(k)``. NaN counts as a value of the
    column but has no rank; ``mean`` and ``stddev`` are rounded to ``digits``.
    """
    columns = list(columns or df.columns)
    numbers = [c for c in columns if _is_number(df, c)]
    points = exact_quantiles(df, numbers, quantiles, k) if exact and numbers else {}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count(col(c)).alias(f"_c{i}"))
        if c in numbers:
            x = col(c).cast("double")
            aggs += [F.round(F.avg(x), digits).alias(f"_m{i}"),
                     F.round(F.stddev_samp(x), digits).alias(f"_s{i}"),
                     F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
            if not exact and quantiles:
                aggs.append(_sketch(_value(c), k).alias(f"_k{i}"))
        else:
            text = col(c).cast("string") if isinstance(
                df.schema[c].dataType, T.AtomicType) else F.to_json(F.struct(col(c)))
            aggs += [F.min(text).alias(f"_lo{i}"), F.max(text).alias(f"_hi{i}")]
    no, text_no = F.lit(None).cast("double"), F.lit(None).cast("string")

    def point(i: int, c: str, q: float) -> Column:
        if c not in numbers:
            return no
        if exact:
            return F.lit(points[c, q]).cast("double")
        return F.when(F.call_function("kll_sketch_get_n_double", F.col(f"_k{i}")) > 0,
                      F.call_function("kll_sketch_get_quantile_double", F.col(f"_k{i}"), F.lit(q)))

    rows = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("count"),
        (F.col("_rows") - F.col(f"_c{i}")).alias("nulls"),
        (F.col(f"_m{i}") if c in numbers else no).alias("mean"),
        (F.col(f"_s{i}") if c in numbers else no).alias("stddev"),
        (F.col(f"_lo{i}") if c in numbers else no).alias("min"),
        (F.col(f"_hi{i}") if c in numbers else no).alias("max"),
        (text_no if c in numbers else F.col(f"_lo{i}")).alias("min_text"),
        (text_no if c in numbers else F.col(f"_hi{i}")).alias("max_text"),
        *[point(i, c, q).alias(_name(q)) for q in quantiles]) for i, c in enumerate(columns)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


@dataclass
class _Bracket:
    """Where a quantile lies: its rank (once the column's values are counted), two values it
    is between (both included), and the wider ones before."""

    column: str
    quantile: float
    rank: int = 0
    low: float = -math.inf
    high: float = math.inf
    wide: tuple[float, float] = (-math.inf, math.inf)
    done: bool = False

    @property
    def range(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def narrow(self, below: int, inside: int, distinct: int, grid: list | None,
               error: float, counted: int) -> None:
        """Take note of one pass: rows below and inside, and the sketch's quantiles inside."""
        if not self.rank:  # the first pass, over the whole column; 0.1 is a tenth, exactly
            self.rank = max(1, math.ceil(Fraction(str(self.quantile)) * inside))
        if inside == 0 and below == 0:
            self.done = True
        elif below >= self.rank:  # the sketch was off on the low side
            self.low = self.wide[0]
        elif below + inside < self.rank:
            self.high = self.wide[1]
        elif distinct <= counted:
            self.done = True
        else:
            share, last = (self.rank - below) / inside, len(grid) - 1
            low = grid[max(0, math.floor((share - error) * last))]
            high = grid[min(last, math.ceil((share + error) * last))]
            if (low, high) == (self.low, self.high):
                self.done = True  # as narrow as it gets: many copies of few values
            self.wide, self.low, self.high = (self.low, self.high), low, high


def _holds(column: str, low: float, high: float) -> Column:
    x = _value(column)
    return (x >= F.lit(low)) & (x <= F.lit(high))


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = QUARTILES,
                    k: int = SKETCH_K, counted: int = COUNTED) -> dict:
    """(column, quantile) → the exact quantile (a value of the column), None without values.

    Every pass is one aggregate over ``columns`` for all quantiles at once (quantiles that
    still share a bracket share its sketch), and shrinks each bracket to about a hundredth of
    its rows; the last one counts the distinct values of brackets that have about ``counted``
    of them or fewer.
    """
    brackets = [_Bracket(c, q) for c in columns for q in quantiles]
    error, grid = 2 * rank_error(k), F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    while live := [b for b in brackets if not b.done]:
        ranges = list(dict.fromkeys(b.range for b in live))
        aggs = []
        for i, (c, low, high) in enumerate(ranges):
            inside = F.when(_holds(c, low, high), _value(c))
            aggs += [F.count_if(_value(c) < F.lit(low)).alias(f"b{i}"),
                     F.count(inside).alias(f"n{i}"),
                     F.approx_count_distinct(inside).alias(f"d{i}"),
                     _sketch(inside, k).alias(f"k{i}")]
        got = df.agg(*aggs).select(*[x for i in range(len(ranges)) for x in (
            f"b{i}", f"n{i}", f"d{i}", F.when(F.col(f"n{i}") > 0, F.call_function(
                "kll_sketch_get_quantile_double", F.col(f"k{i}"), grid)).alias(f"g{i}"))]).first()
        at = {r: i for i, r in enumerate(ranges)}
        for b in live:
            i = at[b.range]
            b.narrow(got[f"b{i}"], got[f"n{i}"], got[f"d{i}"], got[f"g{i}"], error, counted)
    return _count_out(df, brackets)


def _count_out(df: DataFrame, brackets: Sequence[_Bracket]) -> dict:
    """The value at each bracket's rank, by running counts of its distinct values."""
    if not brackets:
        return {}
    ranges = list(dict.fromkeys(b.range for b in brackets))
    tags = F.filter(F.array(*[
        F.when(_holds(*r), F.struct(F.lit(i).alias("i"), _value(r[0]).alias("x")))
        for i, r in enumerate(ranges)]), lambda t: t.isNotNull())
    below = df.agg(*[F.count_if(_value(c) < F.lit(low)).alias(f"b{i}")
                     for i, (c, low, _) in enumerate(ranges)]).first()
    ranks = df.sparkSession.createDataFrame(
        [(k, ranges.index(b.range), b.rank - below[f"b{ranges.index(b.range)}"])
         for k, b in enumerate(brackets)], "k int, i int, rank long")
    counts = (df.select(F.explode(tags).alias("t")).groupBy("t.i", "t.x")
              .agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("x"))
    found = (counts.withColumn("upto", upto).join(F.broadcast(ranks), "i")
             .filter(F.col("upto") >= F.col("rank")).groupBy("k").agg(F.min("x").alias("x")))
    at = {r["k"]: r["x"] for r in found.collect()}
    return {(b.column, b.quantile): at.get(k) for k, b in enumerate(brackets)}


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                      k: int = SKETCH_K) -> DataFrame:
    """``(by…, column_name, n, sketch)``: mergeable sketches, for example one a day."""
    aggs = [a for i, c in enumerate(columns) for a in (
        F.count(_value(c)).alias(f"n{i}"), _sketch(_value(c), k).alias(f"k{i}"))]
    return df.groupBy(*map(col, by)).agg(*aggs).select(*map(col, by), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"),
                 F.col(f"k{i}").alias("sketch")) for i, c in enumerate(columns)])))


def merged_quantiles(sketches: DataFrame, quantiles: Sequence[float] = QUARTILES) -> DataFrame:
    """``column_name, n, q…`` of stored sketches, without a look at the rows behind them."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("n").alias("n"), F.call_function("kll_merge_agg_double", F.col("sketch")).alias("s"))
    return merged.select("column_name", "n", *[
        F.when(F.col("n") > 0, F.call_function(
            "kll_sketch_get_quantile_double", F.col("s"), F.lit(q))).alias(_name(q))
        for q in quantiles])


def rank_bounds(df: DataFrame, column: str, value: float) -> tuple[float, float]:
    """The shares of a column's values below ``value`` and at or below it (one pass)."""
    x = _value(column)
    n, below, upto = df.agg(F.count(x), F.count_if(x < F.lit(value)),
                            F.count_if(x <= F.lit(value))).first()
    return below / n, upto / n
