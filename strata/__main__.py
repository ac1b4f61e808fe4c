"""Command line: run the layered flow for one date, or look at what a run left.

    python -m strata run      --pages <dir|url> --base <lake> --date 2026-02-02 [--version updated_at]
    python -m strata check    --base <lake> --date 2026-02-02     # rules of the published Gold
    python -m strata validate --base <lake> --date 2026-02-02     # each layer against the one before
    python -m strata metrics  --base <lake> [--date 2026-02-02]   # what the stages noted

Uses the active (or default) Spark session; on a cluster ship the package to the
executors and set a shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    from strata.plans.medallion import MedallionRun, MedallionSpec, quality_stage, run_medallion
    from strata.sources.paged import read_pages

    parser = argparse.ArgumentParser(prog="strata")
    sub = parser.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="landing → Bronze → Silver → Gold → checks for one date")
    run.add_argument("--pages", required=True, help="page-file folder or http(s) URL")
    run.add_argument("--base", required=True)
    run.add_argument("--date", required=True)
    run.add_argument("--version", action="append", default=[], help="dedup version column (default: updated_at)")
    run.add_argument("--on-missing-required", default="warn",
                     choices=["warn", "fail", "quarantine"])
    chk = sub.add_parser("check", help="quality report of an existing Gold snapshot")
    chk.add_argument("--base", required=True)
    chk.add_argument("--date", required=True)
    val = sub.add_parser("validate", help="compare each layer with what the one before makes of it")
    val.add_argument("--base", required=True)
    val.add_argument("--date", required=True)
    val.add_argument("--on-missing-required", default="warn",
                     choices=["warn", "fail", "quarantine"])
    met = sub.add_parser("metrics", help="the latest metrics of each date and stage")
    met.add_argument("--base", required=True)
    met.add_argument("--date")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    versions = tuple(getattr(args, "version", ())) or MedallionSpec.version
    spec = MedallionSpec(version=versions,
                         on_missing_required=getattr(args, "on_missing_required", "warn"))
    if args.cmd == "run":
        src = args.pages
        raw = read_pages(spark, url=src) if src.startswith(("http://", "https://")) else \
            read_pages(spark, path=src)
        result = run_medallion(spark, raw, args.base, args.date, spec)
        print(json.dumps({"counts": result.counts, "nulls": result.nulls,
                          "violations": result.violations, "pages": result.pages,
                          "summary": result.summary}))
        return 0
    import datetime as dt

    if args.cmd == "metrics":
        from strata.plans.run_metrics import read_metrics

        day = dt.date.fromisoformat(args.date) if args.date else None
        for r in read_metrics(spark, args.base, day).orderBy(
                "snapshot_date", "step", "stage", "metric").toLocalIterator():
            print(json.dumps({**r.asDict(), "snapshot_date": r["snapshot_date"].isoformat()}))
        return 0
    if args.cmd == "validate":
        from strata.operators.quality import DataQualityError
        from strata.operators.validate import enforce_layers

        report = MedallionRun(spark, args.base, dt.date.fromisoformat(args.date), spec).validate()
        try:
            rows = enforce_layers(report)
        except DataQualityError as exc:
            print(json.dumps({"valid": False, "reason": str(exc)}))
            return 1
        print(json.dumps({"valid": True, "rows": {r["layer"]: r["rows"] for r in rows}}))
        return 0
    result = MedallionRun(spark, args.base, dt.date.fromisoformat(args.date), spec)
    rows = quality_stage(result)
    print(json.dumps({"summary": result.summary}))
    print(json.dumps([r.asDict() for r in rows]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
