"""Backfill: many logical dates through the whole flow in one plan.

The date is a column from the first row to the last: it is part of every de-duplication and
grouping key, so N dates cost one scan, one shuffle per stage and as many tasks as there is data,
not N small jobs. Each layer is staged whole; each date's metrics come from one grouped
aggregate per layer, and each date is accepted or rejected by itself, by the rules that a
single run applies. Only then are the accepted dates published, a layer at a time, by
Spark's own dynamic partition overwrite; a rejected date keeps every snapshot it had.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.contracts import EmptyInputError, conform
from strata.operators import quality
from strata.operators.bronze import CORRUPT_RECORD, from_json_records
from strata.plans.medallion import MedallionRun, MedallionSpec, gold_rows, silver_rows
from strata.plans.run_metrics import new_run_id, write_metrics
from strata.sinks.writes import (
    drop_partitions, snapshot_day, stage, unstage, write_snapshot, write_snapshots,
)
from strata.sources.scans import SNAPSHOT_KEY

log = logging.getLogger(__name__)


@dataclass
class Backfill:
    """What a backfill did to each date."""

    spark: SparkSession
    base: str
    spec: MedallionSpec
    dates: list[dt.date]
    run_id: str = field(default_factory=new_run_id)
    metrics: dict = field(default_factory=dict)  # date -> layer -> metric -> number
    rejected: dict = field(default_factory=dict)  # date -> reasons

    def path(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{self.spec.layers[layer]}"

    @property
    def accepted(self) -> list[dt.date]:
        return [d for d in self.dates if d not in self.rejected]

    def run_of(self, day: dt.date) -> MedallionRun:
        """One date's run, to read its layers and validate them."""
        return MedallionRun(self.spark, self.base, day, self.spec, run_id=self.run_id)

    def reject(self, day: dt.date, reason: str) -> None:
        self.rejected.setdefault(day, []).append(reason)
        log.warning("backfill: %s rejected: %s", day, reason)

    def take(self, layer: str, per_date: DataFrame) -> None:
        """Collect one layer's metrics, a row per date (there are as many as dates asked for)."""
        for row in per_date.collect():
            values = {k: int(v or 0) for k, v in row.asDict().items() if k != SNAPSHOT_KEY}
            self.metrics.setdefault(row[SNAPSHOT_KEY], {})[layer] = values

    def of(self, day: dt.date, layer: str) -> dict:
        return self.metrics.get(day, {}).get(layer, {})

    def report(self) -> DataFrame:
        """``snapshot_date, accepted, reasons, landing, bronze, silver, gold`` (rows) per date."""
        rows = [(d, d not in self.rejected, "; ".join(self.rejected.get(d, [])),
                 *[self.of(d, layer).get("rows") for layer in ("landing", "bronze", "silver", "gold")])
                for d in self.dates]
        return self.spark.createDataFrame(
            rows, f"{SNAPSHOT_KEY} date, accepted boolean, reasons string, landing bigint, "
                  "bronze bigint, silver bigint, gold bigint")


def run_backfill(spark: SparkSession, source: DataFrame, base: str, dates: Iterable,
                 spec: MedallionSpec = MedallionSpec(), run_ts: Column | None = None) -> Backfill:
    """Run every stage for all ``dates`` under ``base``; equal to one run per date.

    ``source`` has a ``snapshot_date`` column and either typed columns or raw JSON records
    (``record``, perhaps ``page``); rows of other dates are left out. ``run_ts`` is the
    ingestion instant as a column over ``snapshot_date`` (default: its midnight). Custom
    ``silver_transforms`` see all dates at once, with the date column. Dates that are rejected keep
    their snapshots and are in ``Backfill.rejected``; nothing is raised for them.
    """
    days = sorted({snapshot_day(d) for d in dates})
    if not days:
        raise EmptyInputError("backfill: no dates")
    key, done = SNAPSHOT_KEY, Backfill(spark, base, spec, days)
    if key in spec.contract.fieldNames():
        raise ValueError(f"the contract's own {key} clashes with the snapshot date")
    rows = source.withColumn(key, F.col(key).cast("date")).filter(F.col(key).isin(days))
    staged: dict[str, DataFrame] = {}
    try:
        if "record" in source.columns:
            staged["landing"] = stage(_landing(rows), "backfill_landing")
            _judge_landing(done, staged["landing"])
            rows = from_json_records(
                staged["landing"].select(key, F.col("value").alias("record")), spec.contract)
        staged["bronze"] = stage(_bronze(rows, spec, run_ts), "backfill_bronze")
        bad = _judge_bronze(done, staged["bronze"])
        split = spec.on_missing_required == "quarantine"
        good = staged["bronze"].filter(~bad) if split else staged["bronze"]
        good = good.drop(CORRUPT_RECORD)
        live = good.filter(F.col(key).isin(done.accepted or [None]))
        staged["silver"] = stage(silver_rows(live, spec, [key]), "backfill_silver")
        _count_silver(done, staged["silver"])
        staged["gold"] = stage(gold_rows(staged["silver"], spec, [key]), "backfill_gold")
        _judge_gold(done, staged["gold"])
        layers = {"landing": staged.get("landing"), "bronze": good, "silver": staged["silver"],
                  "gold": staged["gold"]}
        _publish(done, layers, staged["bronze"].filter(bad) if split else None)
    finally:
        for df in staged.values():
            unstage(df)
    return done


def _landing(rows: DataFrame) -> DataFrame:
    page = F.col("page").cast("int") if "page" in rows.columns else F.lit(None).cast("int")
    return rows.select(SNAPSHOT_KEY, page.alias("page"), F.col("record").alias("value"))


def _judge_landing(done: Backfill, landing: DataFrame) -> None:
    """Rows and missing pages per date: distinct pages first, so no page list is gathered."""
    per_page = landing.groupBy(SNAPSHOT_KEY, "page").agg(F.count(F.lit(1)).alias("n"))
    first, last = F.min("page"), F.max("page")
    gap = last - F.least(first, F.lit(1)) + 1 - F.count("page")
    done.take("landing", per_page.groupBy(SNAPSHOT_KEY).agg(
        F.sum("n").alias("rows"), F.coalesce(gap, F.lit(0)).alias("missing_pages")))
    for day in done.dates:
        got = done.of(day, "landing")
        if not got.get("rows"):
            done.reject(day, "landing: the source returned no records")
        elif got["missing_pages"]:
            if done.spec.on_missing_required == "fail":
                done.reject(day, f"landing: {got['missing_pages']} pages missing")
            else:
                log.warning("backfill: %s: %s pages missing", day, got["missing_pages"])


def _bronze(rows: DataFrame, spec: MedallionSpec, run_ts: Column | None) -> DataFrame:
    fields = [T.StructField(SNAPSHOT_KEY, T.DateType()), *spec.contract.fields]
    if CORRUPT_RECORD in rows.columns:
        fields.append(T.StructField(CORRUPT_RECORD, T.StringType()))
    at = F.col(SNAPSHOT_KEY).cast("timestamp_ntz") if run_ts is None else run_ts.cast("timestamp_ntz")
    return conform(rows, T.StructType(fields)).select(
        "*", at.alias("ingested_at"), F.to_date(at).alias("ingested_date"))


def _judge_bronze(done: Backfill, bronze: DataFrame) -> Column:
    """Metrics and verdicts of each date; returns what marks a bad row."""
    spec = done.spec
    required = [f.name for f in spec.contract.fields if not f.nullable]
    missing = quality.any_null(required) if required else F.lit(False)
    malformed = F.col(CORRUPT_RECORD).isNotNull() if CORRUPT_RECORD in bronze.columns else F.lit(False)
    bad = missing | malformed
    published = ~bad if spec.on_missing_required == "quarantine" else F.lit(True)
    done.take("bronze", bronze.groupBy(SNAPSHOT_KEY).agg(
        F.count_if(published).alias("rows"),
        F.count_if(missing & ~malformed).alias("missing_required"),
        F.count_if(malformed).alias("malformed")))
    for day in done.accepted:
        got = done.of(day, "bronze")
        rows, faults = got.get("rows", 0), {k: v for k, v in got.items() if k != "rows" and v}
        if faults and spec.on_missing_required == "fail":
            done.reject(day, f"bronze: bad records {faults}")
        elif faults:
            log.warning("backfill: %s: bad records %s", day, faults)
        if rows == 0:
            done.reject(day, "bronze: no (good) records")
        elif rows < spec.min_rows or (spec.max_rows is not None and rows > spec.max_rows):
            done.reject(day, f"bronze: {rows} rows outside [{spec.min_rows}, {spec.max_rows}]")
    return bad


def _count_silver(done: Backfill, silver: DataFrame) -> None:
    checked = [c for c in done.spec.null_check if c in silver.columns]
    done.take("silver", silver.groupBy(SNAPSHOT_KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked]))
    for day in done.accepted:
        if not done.of(day, "silver").get("rows"):
            done.reject(day, "silver: no rows")


def _judge_gold(done: Backfill, gold: DataFrame) -> None:
    rules = quality.gold_rules(done.spec.gold_keys, done.spec.gold_alias)
    done.take("gold", gold.groupBy(SNAPSHOT_KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(r.fails).alias(f"failed_{r.name}") for r in rules]))
    for day in done.accepted:
        got = done.of(day, "gold")
        if not got.get("rows"):
            done.reject(day, "gold: no groups")
        for rule in rules:
            if rule.severity == "error" and got.get(f"failed_{rule.name}"):
                done.reject(day, f"gold: {rule.name} failed ({got[f'failed_{rule.name}']})")


def _publish(done: Backfill, layers: dict, quarantined: DataFrame | None) -> None:
    """Accepted dates only; every layer in one job, its metrics after it."""
    days, spark = done.accepted, done.spark
    if not days:
        return
    wanted = F.col(SNAPSHOT_KEY).isin(days)
    for step, (layer, df) in enumerate(layers.items()):
        if df is None:
            continue
        by: Sequence[str] = done.spec.silver_partition_by if layer == "silver" else ()
        if by:  # value partitions that a date no longer has must go: the whole date is replaced
            for day in days:
                write_snapshot(df.filter(F.col(SNAPSHOT_KEY) == F.lit(day)), done.path(layer), day,
                               partition_by=by)
        else:
            write_snapshots(df.filter(wanted), done.path(layer))
        for day in days:
            write_metrics(spark, done.base, day, layer, step, done.of(day, layer), done.run_id)
    if quarantined is not None:
        write_snapshots(quarantined.filter(wanted), done.path("quarantine"))
        clean = [d for d in days if not (done.of(d, "bronze").get("missing_required")
                                         or done.of(d, "bronze").get("malformed"))]
        drop_partitions(spark, done.path("quarantine"), SNAPSHOT_KEY, clean)
