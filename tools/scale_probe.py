"""Scaling experiment: run the core operators on lineitem replicated N times.

    python tools/scale_probe.py <scratch_dir> [copies]
    python tools/scale_probe.py <scratch_dir> [copies] --medallion

Writes ``copies`` × sf0.1 lineitem (keys offset per copy, so the duplicate
ratio stays the same) as a multi-file Parquet set, plus a skewed variant in
which one l_orderkey holds a third of all rows, then times dedup, count_by,
distinct_rows, dedup_report and enrich_and_aggregate on both. Nothing is kept
in the repository; the scratch folder is the caller's.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def medallion_probe(spark, scratch: str, copies: int) -> dict:
    """The whole flow on sf0.1 documents replicated ``copies`` times (ids offset)."""
    from pyspark.sql import functions as F

    from strata.plans import medallion as M
    from strata.plans.catalog import DOCS_SPEC, RUN_DATE, RUN_TS

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    span = docs.agg(F.max("doc_id")).first()[0] + 1
    path = f"{scratch}/documents_x{copies}"
    if not Path(path).exists():
        big = docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c"))
        big = big.withColumn("doc_id", F.col("doc_id") + F.col("_c") * span).drop("_c")
        big.repartition(32).write.parquet(path)
    src = spark.read.parquet(path)
    raw = src.select(F.to_json(F.struct(*src.columns)).alias("record"))
    run = M.MedallionRun(spark, f"{scratch}/lake_x{copies}", RUN_DATE, DOCS_SPEC)
    steps = [("landing", lambda: M.land_stage(run, raw)),
             ("bronze", lambda: M.bronze_stage(run, M.landed_records(run), RUN_TS)),
             ("silver", lambda: M.silver_stage(run)),
             ("gold", lambda: M.gold_stage(run)),
             ("quality", lambda: M.quality_stage(run))]
    out = {}
    for name, step in steps:
        t = time.perf_counter()
        step()
        out[name] = round(time.perf_counter() - t, 2)
    out["total"] = round(sum(out.values()), 2)
    out["rows"] = dict(run.counts)
    return out


def main(argv):
    from pyspark.sql import functions as F

    from strata.operators.enrich import enrich_and_aggregate
    from strata.operators.gold import count_by
    from strata.operators.silver import dedup, dedup_report, distinct_rows
    from strata.session import local_session, scale_conf

    medallion = "--medallion" in argv
    argv = [a for a in argv if a != "--medallion"]
    scratch, copies = argv[0], int(argv[1]) if len(argv) > 1 else 32
    src = "/root/testdata/sf0.1"
    input_bytes = (Path(src) / "lineitem.parquet").stat().st_size * copies
    conf = scale_conf(input_bytes, 8)
    spark = local_session(8, int(conf["spark.sql.shuffle.partitions"]), extra=conf)
    if medallion:
        print(json.dumps(medallion_probe(spark, scratch, copies)))
        return
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    span = li.agg(F.max("l_orderkey")).first()[0] + 1
    # Replicate with explode over a copy index (one output row per input row and copy).
    big = li.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c"))
    big = big.withColumn("l_orderkey", F.col("l_orderkey") + F.col("_c") * span).drop("_c")
    plain_path, hot_path = f"{scratch}/lineitem_x{copies}", f"{scratch}/lineitem_x{copies}_hot"
    if not Path(plain_path).exists():
        big.repartition(64).write.parquet(plain_path)
        hot = spark.read.parquet(plain_path)
        hot = hot.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(-1))
                             .otherwise(F.col("l_orderkey")))
        hot.write.parquet(hot_path)
    supplier = spark.read.parquet(f"{src}/supplier.parquet").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    results = {}
    for name, path in (("plain", plain_path), ("hot", hot_path)):
        df = spark.read.parquet(path)
        rows = df.count()
        ops = {
            "dedup": lambda d: dedup(d, ["l_orderkey", "l_linenumber"], ["l_shipdate"]),
            "count_by": lambda d: count_by(d, ["l_orderkey"], "l_quantity", order=False),
            "distinct_rows": distinct_rows,
            "dedup_report": lambda d: dedup_report(d, ["l_orderkey", "l_linenumber"]),
            "join_group": lambda d: enrich_and_aggregate(d, supplier, "l_suppkey",
                                                         ["l_returnflag"], ["s_nationkey"],
                                                         value="l_extendedprice", scale=2),
        }
        for op, fn in ops.items():
            t = time.perf_counter()
            fn(df).write.format("noop").mode("overwrite").save()
            results[f"{name}.{op}"] = round(time.perf_counter() - t, 2)
        results[f"{name}.rows"] = rows
    print(json.dumps(results))


if __name__ == "__main__":
    main(sys.argv[1:])
