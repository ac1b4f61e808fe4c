"""Child process for test_resilience: every task fails on its first attempt.

Runs the layered flow on a session that allows task retries (``local[4,3]``) with
a step that raises on attempt 0 of every task, once in the ingestion stage and
once in the Silver stage, then prints the results as JSON.
"""

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


MARKERS = None  # folder where each injected failure leaves a file


def flaky(df):
    """Identity step whose first attempt of every task fails (a lost executor)."""
    from pyspark import TaskContext

    markers = MARKERS

    def fn(batches):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0:
            Path(markers, f"{ctx.stageId()}-{ctx.partitionId()}").touch()
            raise RuntimeError("injected task failure")
        yield from batches

    return df.mapInPandas(fn, df.schema)


def main(base: str) -> None:
    import datetime as dt

    global MARKERS
    MARKERS = Path(base).with_name("failures")
    MARKERS.mkdir(parents=True, exist_ok=True)

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from strata.plans.catalog import DOCS_SPEC, RUN_TS, table
    from strata.plans.medallion import MedallionSpec, run_medallion

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    docs = table(spark, "/root/testdata/sf0.001", "documents").repartition(3)
    raw = flaky(docs.select(F.to_json(F.struct(*docs.columns)).alias("record")))
    spec = MedallionSpec(**{**DOCS_SPEC.__dict__, "silver_transforms": (flaky,)})
    run = run_medallion(spark, raw, base, dt.date(2026, 2, 2), spec, run_ts=RUN_TS)
    gold = sorted(tuple(r) for r in run.gold().collect())
    expected = sorted(tuple(r) for r in docs.groupBy("source", "lang")
                      .agg(F.count("doc_id").alias("qty")).collect())
    print(json.dumps({"counts": run.counts, "gold_ok": gold == expected,
                      "docs": docs.count(), "injected": len(list(MARKERS.iterdir()))}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
