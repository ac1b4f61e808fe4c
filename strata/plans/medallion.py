"""The Bronze → Silver → Gold → quality run for one logical date.

Each stage reads the previous layer's snapshot (partition pruning on
``snapshot_date``), transforms it with the operators, and performs exactly one
action: its snapshot write, which also yields the stage metrics through an
``Observation``. Every stage takes the same logical date, so any date can be
rerun or backfilled and only its own partitions change.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.contracts import BRONZE_CONTRACT, EmptyInputError, assert_schema
from strata.operators import gold as gold_ops
from strata.operators import quality, validate
from strata.operators.bronze import CORRUPT_RECORD, from_json_records, to_bronze
from strata.operators.silver import SILVER_COLUMNS, clean, dedup
from strata.plans.run_metrics import new_run_id, write_metrics
from strata.sinks.writes import path_exists, stage, unstage, write_snapshot
from strata.sources.paged import page_report
from strata.sources.scans import read_snapshot

log = logging.getLogger(__name__)


# Layer directories under the lake base (landing and quarantine are
# this library's own; the other three keep the familiar layer names).
DEFAULT_LAYERS = {
    "landing": "landing/breweries",
    "bronze": "bronze/breweries",
    "silver": "silver/breweries",
    "gold": "gold/breweries_stats",
    "quarantine": "quarantine/breweries",
}


@dataclass(frozen=True)
class MedallionSpec:
    """What each layer keeps; the defaults are the brewery contract."""

    contract: T.StructType = BRONZE_CONTRACT
    silver_columns: Sequence[tuple[str, str, bool]] = SILVER_COLUMNS
    keys: Sequence[str] = ("id",)
    # Of rows with one key the latest stays, by these columns (() when there are none).
    version: Sequence[str] = ("updated_at",)
    keep: str = "last"
    # Bad records (missing a required contract field, or not valid JSON): "warn"
    # (count them), "fail" (raise; the date's Bronze stays as it was) or "quarantine"
    # (write them, raw text included, to their own layer and keep them out of Bronze).
    on_missing_required: str = "warn"
    null_check: Sequence[str] = ("id", "name", "state")
    # Bounds on Bronze rows, checked before the date is replaced.
    min_rows: int = 1
    max_rows: int | None = None
    # Extension point: extra DataFrame -> DataFrame steps applied to the cleaned
    # Silver rows (through ``DataFrame.transform``) before de-duplication.
    silver_transforms: Sequence[Callable[[DataFrame], DataFrame]] = ()
    # Value partitions of the Silver snapshot below the date (e.g. ("state",)).
    # Read back with the written schema, so '01' stays text; '' reads back as null.
    silver_partition_by: Sequence[str] = ()
    gold_keys: Sequence[str] = gold_ops.GOLD_KEYS
    gold_measure: str = gold_ops.GOLD_MEASURE
    gold_alias: str = gold_ops.GOLD_ALIAS

    def contract_keys(self) -> list[str]:
        """The Silver key by its names in Bronze."""
        source = {dst: src for src, dst, _ in self.silver_columns}
        return [source.get(k, k) for k in self.keys]

    layers: dict = field(default_factory=lambda: dict(DEFAULT_LAYERS))


@dataclass
class MedallionRun:
    """One logical date's run: where its layers live and what each stage observed."""

    spark: SparkSession
    base: str
    snapshot: dt.date
    spec: MedallionSpec
    counts: dict = field(default_factory=dict)
    nulls: dict = field(default_factory=dict)
    violations: dict = field(default_factory=dict)
    pages: dict = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)  # data schema written per layer
    quality: list = field(default_factory=list)
    summary: dict = field(default_factory=dict)
    run_id: str = field(default_factory=new_run_id)  # names the run's rows in the metrics table

    def note(self, stage_name: str, step: int, **values: int) -> None:
        """Add a finished stage's metrics to the lake's metrics table."""
        write_metrics(self.spark, self.base, self.snapshot, stage_name, step, values, self.run_id)

    def path(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{self.spec.layers[layer]}"

    def read(self, layer: str) -> DataFrame:
        """The run's snapshot of ``layer``; its emptiness is known from the write metrics."""
        if self.counts.get(layer) == 0:
            raise EmptyInputError(f"{layer} snapshot {self.snapshot} is empty")
        schema = self.schemas.get(layer)
        if schema is None and layer == "silver" and self.spec.silver_partition_by:
            schema = self._silver_schema()
        df = read_snapshot(self.spark, self.path(layer), self.snapshot, schema=schema,
                           require=layer not in self.counts).drop("snapshot_date")
        return df.select(*schema.fieldNames()) if schema is not None else df

    def _silver_schema(self) -> T.StructType:
        """Silver as the spec has it, for a process that did not write it: partition values
        keep the contract's type (no inference from folder names), columns their order."""
        found = read_snapshot(self.spark, self.path("silver"), self.snapshot,
                              require=False).drop("snapshot_date").schema
        typed = {dst: self.spec.contract[src].dataType for src, dst, _ in self.spec.silver_columns
                 if src in self.spec.contract.fieldNames()}
        own = [dst for _, dst, _ in self.spec.silver_columns if dst in found.fieldNames()]
        return T.StructType([T.StructField(c, typed.get(c, found[c].dataType)) for c in
                             [*own, *[c for c in found.fieldNames() if c not in own]]])

    def gold(self) -> DataFrame:
        spec = self.spec
        g = self.read("gold")
        return g.orderBy(F.col(spec.gold_alias).desc(), *[F.col(k).asc_nulls_first()
                                                          for k in spec.gold_keys])

    def validate(self, buckets: int = validate.BUCKETS) -> DataFrame:
        """``validate_layers`` of the published layers: each against what the spec makes of the
        layer before it (Bronze against the parsed landing, where there is one)."""
        spec, layers = self.spec, []
        bronze, silver = self.read("bronze"), self.read("silver")
        required, expected = spec.contract.fieldNames(), None
        if path_exists(self.spark, self.path("landing")):
            parsed = landed_records(self)
            good = parsed.filter(~_bad_record(spec, parsed))
            expected = (good if spec.on_missing_required == "quarantine" else parsed).select(
                *required)
        layers.append(validate.Layer("bronze", bronze, spec.contract_keys(), required, expected))
        layers.append(validate.Layer("silver", silver, spec.keys,
                                     [dst for _, dst, _ in spec.silver_columns],
                                     silver_rows(bronze, spec)))
        layers.append(validate.Layer("gold", self.read("gold"), spec.gold_keys,
                                     [*spec.gold_keys, spec.gold_alias], gold_rows(silver, spec)))
        return validate.validate_layers(layers, buckets)

    def metrics(self) -> DataFrame:
        """Rows per layer and the reduction from the layer before (landing → Bronze
        is what quarantine removed, Bronze → Silver the duplicates, Silver → Gold the
        grouping). Built from the counts observed during the writes: no new job."""
        layers = [name for name in ("landing", "bronze", "silver", "gold") if name in self.counts]
        rows = [(i, name, self.counts[name]) for i, name in enumerate(layers)]
        counts = self.spark.createDataFrame(rows, "step int, layer string, rows bigint")
        return quality.with_reduction(counts)


LANDING_SCHEMA = T.StructType([T.StructField("page", T.IntegerType()),
                              T.StructField("value", T.StringType())])


def land_stage(run: MedallionRun, records: DataFrame) -> int:
    """Keep the raw records untouched in the landing snapshot, with their page number.

    Landing has its own directory, so raw payloads never mix with the curated
    layers; each record's JSON text is stored as received (``value``) next to
    the page it came from (``page``, null when the source has no pages). Bronze
    is parsed from it and can always be rebuilt from it without refetching.
    When pages are known, one aggregate over the page column (no record is read)
    checks that no page from 1 on is missing, before the date is replaced. An empty
    response leaves the date's landing as it was.
    """
    paged = "page" in records.columns
    page = F.col("page").cast("int") if paged else F.lit(None).cast("int")

    def complete(landed: DataFrame, rows: int) -> None:
        if not (rows and paged):
            return
        run.pages = page_report(landed).first().asDict()
        if run.pages["missing_pages"]:
            if run.spec.on_missing_required == "fail":
                raise quality.DataQualityError(f"landing: pages missing {run.pages}")
            log.warning("landing: pages missing %s", run.pages)

    rows = write_snapshot(records.select(page.alias("page"), F.col("record").alias("value")),
                          run.path("landing"), run.snapshot, on_empty="keep", check=complete)
    run.counts["landing"] = rows
    run.note("landing", 0, rows=rows, **{k: v for k, v in run.pages.items() if v is not None})
    return rows


def landed_records(run: MedallionRun) -> DataFrame:
    """The landing snapshot parsed into the Bronze contract (JVM-side ``from_json``)."""
    if run.counts.get("landing") == 0:
        raise EmptyInputError("landing: the source returned no records")
    raw = read_snapshot(run.spark, run.path("landing"), run.snapshot, schema=LANDING_SCHEMA,
                        require=False)
    return from_json_records(raw.select(F.col("value").alias("record")), run.spec.contract)


def _bad_record(spec: MedallionSpec, df: DataFrame) -> F.Column:
    """True for a row that lacks a required contract field or was not valid JSON."""
    required = [f.name for f in spec.contract.fields if not f.nullable]
    missing = quality.any_null(required) if required else F.lit(False)
    if CORRUPT_RECORD in df.columns:
        return missing | F.col(CORRUPT_RECORD).isNotNull()
    return missing


def bronze_stage(run: MedallionRun, source: DataFrame, run_ts=None) -> int:
    """Conform the source records and write the Bronze snapshot.

    Rows missing a required contract field, and records that were not valid JSON
    (raw text kept in ``_corrupt_record`` by the parser), are counted during the
    write (an ``Observation``, no extra job) and handled per
    ``spec.on_missing_required``: warn, fail, or quarantine (bad rows, with their
    raw text, go to the quarantine layer instead of Bronze). All checks (contract schema,
    bad records, row bounds) come before the date is replaced: a failing or empty rerun
    leaves the good snapshot.
    """
    spec = run.spec
    required = [f.name for f in spec.contract.fields if not f.nullable]
    contract = spec.contract
    malformed = F.lit(False)
    if CORRUPT_RECORD in source.columns:
        contract = T.StructType(list(contract.fields)
                                + [T.StructField(CORRUPT_RECORD, T.StringType())])
        malformed = F.col(CORRUPT_RECORD).isNotNull()
    missing = quality.any_null(required) if required else F.lit(False)
    bad = missing | malformed
    obs = Observation()
    bronze = to_bronze(source, contract, run_ts)
    assert_schema(bronze.select(*spec.contract.fieldNames()), spec.contract, strict=False)
    bronze = bronze.observe(obs, F.count_if(missing & ~malformed).alias("missing_required"),
                            F.count_if(malformed).alias("malformed"))
    split = spec.on_missing_required == "quarantine"
    if split:  # parsed and observed once, then written to two layers
        bronze = staged = stage(bronze, "bronze")

    def publishable(_, rows: int) -> None:
        got = obs.get
        run.violations = {k: int(got.get(k) or 0) for k in ("missing_required", "malformed")}
        if sum(run.violations.values()):
            if spec.on_missing_required == "fail":
                raise quality.DataQualityError(
                    f"bronze: bad records {run.violations} (required fields {required})")
            log.warning("bronze: bad records %s (required fields %s)", run.violations, required)
        if rows == 0:
            raise EmptyInputError("bronze: the source returned no (good) records")
        if rows < spec.min_rows or (spec.max_rows is not None and rows > spec.max_rows):
            raise quality.DataQualityError(
                f"bronze: {rows} rows outside [{spec.min_rows}, {spec.max_rows}]")

    good = bronze.filter(~bad) if split else bronze
    try:
        rows = write_snapshot(good.drop(CORRUPT_RECORD), run.path("bronze"), run.snapshot,
                              on_empty="keep", check=publishable)
        run.counts["bronze"] = rows
        if split:
            run.counts["quarantine"] = write_snapshot(staged.filter(bad), run.path("quarantine"),
                                                      run.snapshot)
    finally:
        if split:
            unstage(staged)
    run.note("bronze", 1, rows=rows, **run.violations)
    log.info("bronze: %s rows", rows)
    return rows


def silver_rows(bronze: DataFrame, spec: MedallionSpec, by: Sequence[str] = ()) -> DataFrame:
    """Silver from Bronze rows: trim, rename, select, de-duplicate; ``by`` columns (a backfill's
    date) pass through and are part of every key."""
    outputs = {dst for _, dst, _ in spec.silver_columns}
    carried = [v for v in spec.version if v not in outputs]  # version columns Silver drops
    cleaned = clean(bronze, [*[(c, c, False) for c in by], *spec.silver_columns,
                             *[(v, v, False) for v in carried]])
    for step in spec.silver_transforms:
        cleaned = cleaned.transform(step)
    return dedup(cleaned, [*by, *spec.keys], spec.version, spec.keep).drop(*carried)


def gold_rows(silver: DataFrame, spec: MedallionSpec, by: Sequence[str] = ()) -> DataFrame:
    """Gold from Silver rows, in no order; ``by`` columns lead the grouping."""
    return gold_ops.count_by(silver, [*by, *spec.gold_keys], spec.gold_measure, spec.gold_alias,
                             order=False)


def silver_stage(run: MedallionRun) -> int:
    """Trim/rename/select, de-duplicate deterministically, write the Silver snapshot.

    An empty result leaves the date's Silver as it was.
    """
    spec = run.spec
    silver = silver_rows(run.read("bronze"), spec)
    checked = [c for c in spec.null_check if c in silver.columns]
    obs = Observation()
    silver = silver.observe(obs, F.count(F.lit(1)).alias("rows"),
                            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checked])
    write_snapshot(silver, run.path("silver"), run.snapshot,
                   partition_by=spec.silver_partition_by, on_empty="keep")
    if spec.silver_partition_by:
        run.schemas["silver"] = silver.schema
    got = obs.get
    run.counts["silver"] = int(got["rows"])
    run.nulls = {c: int(got[f"null_{c}"]) for c in checked}
    if sum(run.nulls.values()):
        log.warning("silver: null values in key columns %s", run.nulls)
    run.note("silver", 2, rows=run.counts["silver"],
             **{f"null_{c}": n for c, n in run.nulls.items()})
    log.info("silver: %s rows (%s removed)", run.counts["silver"],
             run.counts.get("bronze", 0) - run.counts["silver"])
    return run.counts["silver"]


def gold_stage(run: MedallionRun) -> int:
    """Aggregate the Silver snapshot, check the result, and write the Gold snapshot.

    The quality rules run on the rows about to be published: a failed error rule raises
    ``DataQualityError`` and leaves the date's Gold as it was, as an empty result does.
    """
    spec = run.spec

    def acceptable(gold: DataFrame, rows: int) -> None:
        if rows == 0:
            raise EmptyInputError("gold: no groups")
        _judge(run, gold)

    run.quality, run.summary = [], {}
    run.counts["gold"] = write_snapshot(gold_rows(run.read("silver"), spec), run.path("gold"),
                                        run.snapshot, on_empty="keep", check=acceptable)
    run.note("gold", 3, rows=run.counts["gold"])
    return run.counts["gold"]


def _judge(run: MedallionRun, gold: DataFrame) -> None:
    spec = run.spec
    run.quality = quality.enforce(quality.check_gold(gold, spec.gold_keys, spec.gold_alias))
    run.summary = quality.gold_summary(gold, spec.gold_keys, spec.gold_alias).first().asDict()


def quality_stage(run: MedallionRun) -> list:
    """One-pass Gold checks and summary (``run.quality``, ``run.summary``); raises
    ``DataQualityError`` on a failed error rule. In a run whose Gold stage has judged the rows
    it published, that judgement stands; else the published Gold is checked."""
    if not run.quality:
        _judge(run, run.read("gold"))
    run.note("quality", -1, **{f"failed_{r['rule']}": r["failed"] for r in run.quality},
             **{k: v for k, v in run.summary.items() if v is not None})
    return run.quality


def run_medallion(spark: SparkSession, source: DataFrame, base: str, snapshot,
                  spec: MedallionSpec = MedallionSpec(), run_ts=None) -> MedallionRun:
    """Run every stage for ``snapshot`` (a date) under ``base``; rerunnable.

    ``source`` is either typed rows or raw records (a ``record`` JSON-text
    column, as the paged source yields): raw records are landed first and
    Bronze is parsed from the landing snapshot.
    """
    day = snapshot if isinstance(snapshot, dt.date) else dt.date.fromisoformat(str(snapshot))
    if isinstance(day, dt.datetime):
        day = day.date()
    run = MedallionRun(spark, base, day, spec)
    if "record" in source.columns:
        land_stage(run, source)
        source = landed_records(run)
    bronze_stage(run, source, run_ts if run_ts is not None else f"{day.isoformat()} 00:00:00")
    silver_stage(run)
    gold_stage(run)
    quality_stage(run)
    return run
