"""Data-quality rules, profiles and layer reconciliation.

Rules are data: a name, a severity and a boolean Column that marks a failing
row. ``check`` compiles any number of them into ONE aggregate over the input,
so a table is scanned once however many rules it has. Results are output rows
(never side effects such as ``assert_true``, which Catalyst may prune away).
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import col, exact_sum
from strata.functions.contracts import EmptyInputError, missing_columns
from strata.operators.gold import GOLD_ALIAS, GOLD_KEYS

log = logging.getLogger(__name__)


class DataQualityError(ValueError):
    """Raised by ``enforce`` when an error-severity rule fails."""


@dataclass(frozen=True)
class Rule:
    """A row-level rule: ``fails`` is true for every offending row."""

    name: str
    fails: Column
    severity: str = "error"


def _report_row(name: str, severity: str, failed: Column) -> Column:
    failed = failed.cast("bigint")
    return F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"),
                    failed.alias("failed"), (failed == 0).alias("passed"))


def check(df: DataFrame, rules: Sequence[Rule] = (), *, required: Sequence[str] = (),
          min_rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Evaluate every rule in one pass; one report row per rule.

    Report columns: ``rule, severity, failed, passed``. ``required`` adds a
    schema rule (failed = number of missing columns, metadata only);
    ``min_rows`` / ``max_rows`` add a volume rule (``max_rows=0`` is a bound).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(r.fails).alias(f"_r{i}") for i, r in enumerate(rules)]
    totals = df.agg(*aggs)
    rows: list[Column] = []
    if required:
        rows.append(_report_row("required_columns", "error",
                                F.lit(len(missing_columns(df, required)))))
    if min_rows is not None or max_rows is not None:
        bad = F.lit(False)
        if min_rows is not None:
            bad = bad | (F.col("_rows") < F.lit(min_rows))
        if max_rows is not None:
            bad = bad | (F.col("_rows") > F.lit(max_rows))
        rows.append(_report_row("row_count", "error", F.when(bad, 1).otherwise(0)))
    rows += [_report_row(r.name, r.severity, F.col(f"_r{i}")) for i, r in enumerate(rules)]
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "rule string, severity string, failed bigint, passed boolean")
    return totals.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> list:
    """Collect a (tiny, one row per rule) report; raise on failed error rules."""
    rows = report.collect()
    errors = [r for r in rows if not r["passed"] and r["severity"] == "error"]
    for r in rows:
        if not r["passed"] and r["severity"] != "error":
            log.warning("quality rule %s failed on %s rows", r["rule"], r["failed"])
    if errors:
        raise DataQualityError("; ".join(f"{r['rule']} failed ({r['failed']})" for r in errors))
    return rows


def any_null(cols: Sequence[str]) -> Column:
    """True when any of ``cols`` is null."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | col(c).isNull()
    return cond


def gold_rules(keys: Sequence[str] = GOLD_KEYS, measure: str = GOLD_ALIAS) -> list[Rule]:
    """Consistency (no null key or measure) and business rule (measure > 0)."""
    return [Rule("no_null_keys", any_null([*keys, measure])),
            Rule("positive_measure", col(measure) <= 0)]


def check_gold(gold: DataFrame, keys: Sequence[str] = GOLD_KEYS, measure: str = GOLD_ALIAS) -> DataFrame:
    """The Gold quality stage: columns present, not empty, no nulls, measure > 0."""
    required = [*keys, measure]
    if missing_columns(gold, required):
        return check(gold, required=required)
    return check(gold, gold_rules(keys, measure), required=required, min_rows=1)


def gold_summary(gold: DataFrame, keys: Sequence[str] = GOLD_KEYS, measure: str = GOLD_ALIAS) -> DataFrame:
    """One row: groups, distinct values per key, and the measure total."""
    return gold.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_distinct(col(k)).alias(f"distinct_{k}") for k in keys],
        F.sum(col(measure)).cast("bigint").alias(f"total_{measure}"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for every column, from one aggregate."""
    columns = list(columns or df.columns)
    totals = df.agg(*[F.count_if(col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(columns)])))


def null_total(df: DataFrame, columns: Sequence[str], severity: str = "warn") -> int:
    """Total nulls over ``columns`` (one job); warns (or raises) when positive."""
    total = null_profile(df, columns).agg(F.sum("null_count")).first()[0] or 0
    if total:
        if severity == "error":
            raise DataQualityError(f"{total} null values in {list(columns)}")
        log.warning("%s null values in %s", total, list(columns))
    return int(total)


def distinct_profile(df: DataFrame, columns: Sequence[str] | None = None,
                     exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """``(column_name, distinct_count)`` per column, nulls not counted.

    ``exact`` counts each column by its own two-step aggregate over a scan of that column
    alone, reduced map-side, so no row is multiplied by the number of columns; stage ``df``
    first if it is costly to compute. ``exact=False`` uses HyperLogLog++ sketches in one
    pass, which need no shuffle of values at all.
    """
    columns = list(columns or df.columns)
    if exact:
        parts = [df.select(col(c).alias("v")).filter("v is not null").distinct()
                 .agg(F.count(F.lit(1)).alias("distinct_count"))
                 .select(F.lit(c).alias("column_name"), "distinct_count") for c in columns]
        return functools.reduce(DataFrame.unionByName, parts)
    totals = df.agg(*[F.approx_count_distinct(col(c), rsd).alias(f"_d{i}")
                      for i, c in enumerate(columns)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_d{i}").alias("distinct_count"))
        for i, c in enumerate(columns)])))


def describe_stats(df: DataFrame, columns: Sequence[str], digits: int = 4,
                   scale: int | None = None) -> DataFrame:
    """Typed summary per numeric column: count, mean, stddev, min, max.

    Unlike ``DataFrame.describe`` the values stay numeric. ``mean`` is exact
    when ``scale`` (decimal places of the data) is given; ``stddev`` is the
    sample deviation rounded to ``digits``.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = col(c).cast("double")
        mean = (exact_sum(c, scale) / F.count(x)) if scale is not None else F.avg(x)
        aggs += [F.count(x).alias(f"_c{i}"), F.round(mean, digits).alias(f"_m{i}"),
                 F.round(F.stddev_samp(x), digits).alias(f"_s{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    totals = df.agg(*aggs)
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("count"),
                 F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("stddev"),
                 F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"))
        for i, c in enumerate(columns)])))


def untrimmed_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, untrimmed)``: rows whose value has outer spaces."""
    totals = df.agg(*[F.count_if(col(c) != F.trim(col(c))).alias(f"_t{i}")
                      for i, c in enumerate(columns)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_t{i}").alias("untrimmed"))
        for i, c in enumerate(columns)])))


def row_bounds(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> DataFrame:
    """One row: ``n_rows, min_rows, max_rows, passed``; ``max_rows=0`` is a real bound."""
    n = F.count(F.lit(1))
    ok = n >= F.lit(min_rows)
    if max_rows is not None:
        ok = ok & (n <= F.lit(max_rows))
    return df.agg(n.alias("n_rows"), F.lit(min_rows).cast("bigint").alias("min_rows"),
                  F.lit(max_rows).cast("bigint").alias("max_rows"), ok.alias("passed"))


def assert_row_bounds(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> int:
    """Row count (one job); raises ``DataQualityError`` outside the bounds."""
    r = row_bounds(df, min_rows, max_rows).first()
    if not r["passed"]:
        raise DataQualityError(f"Row count {r['n_rows']} outside [{min_rows}, {max_rows}]")
    return int(r["n_rows"])


def guard_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Return ``df`` unchanged; raise ``EmptyInputError`` if it has no row.

    The probe is ``isEmpty`` (a ``limit 1`` job), not a full count.
    """
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty")
    return df


def reconcile(layers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row counts per layer and the reduction from the previous layer.

    Columns: ``step, layer, rows, prev_rows, removed, reduction_pct``;
    ``reduction_pct = 100 * (prev - rows) / prev`` and 0 when ``prev`` is 0.
    Each layer is counted by its own partial aggregate; only the k count rows
    meet in the final window.
    """
    if not layers:
        raise ValueError("reconcile needs at least one layer")
    counts = None
    for step, (name, df) in enumerate(layers):
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(step).alias("step"), F.lit(name).alias("layer"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return with_reduction(counts)


def with_reduction(counts: DataFrame) -> DataFrame:
    """Add ``prev_rows, removed, reduction_pct`` to ``(step, layer, rows)`` rows."""
    w = Window.partitionBy(F.lit(0)).orderBy("step")
    prev = F.lag("rows").over(w)
    return counts.select(
        "step", "layer", "rows", prev.alias("prev_rows"),
        (prev - F.col("rows")).alias("removed"),
        F.when(prev == 0, F.lit(0.0))
         .otherwise(F.lit(100.0) * (prev - F.col("rows")) / prev).alias("reduction_pct"))
