"""Physical-plan checks: the operators plan the way the design says."""

from pyspark.sql import functions as F

from strata.operators.enrich import enrich, enrich_and_aggregate, fits_broadcast
from strata.operators.gold import count_by
from strata.operators.silver import dedup
from strata.plans.catalog import QUERIES, table
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_partial_aggregate_before_one_hash_exchange(spark):
    docs = table(spark, SF_SMALL, "documents")
    p = plan(count_by(docs, ["source", "lang"], "doc_id", order=False))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_count" in p
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in p


def test_dedup_reduces_hot_keys_before_the_shuffle(spark):
    li = table(spark, SF_SMALL, "lineitem")
    p = plan(dedup(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert p.count("Exchange hashpartitioning") == 1
    exchange_at = p.index("Exchange hashpartitioning")
    assert "partial_max" in p[exchange_at:]


def test_filter_is_pushed_to_parquet(spark):
    p = plan(QUERIES["filter_threshold"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["scan_parquet"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>" in p


def test_small_dimension_is_broadcast_after_size_check(spark):
    customer = table(spark, SF_SMALL, "customer")
    nation = table(spark, SF_SMALL, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    assert fits_broadcast(nation, 25) and not fits_broadcast(nation, 24)
    assert not fits_broadcast(nation, 25, max_bytes=100)
    p = plan(enrich(customer, nation, "c_nationkey"))
    assert "BroadcastHashJoin" in p


def test_unbounded_dimension_is_not_forced_to_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        customer = table(spark, SF_SMALL, "customer")
        nation = table(spark, SF_SMALL, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
        p = final_plan(enrich(customer, nation, "c_nationkey", max_broadcast_rows=10))
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_join_then_group_shuffles_groups_only(spark):
    customer = table(spark, SF_SMALL, "customer")
    nation = table(spark, SF_SMALL, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    p = plan(enrich_and_aggregate(customer, nation, "c_nationkey", ["c_mktsegment"], ["n_name"],
                                  value="c_acctbal"))
    assert p.count("Exchange hashpartitioning") == 1
    assert p.index("partial_sum") < p.index("BroadcastHashJoin")  # partial agg above the join


def test_join_then_group_pre_aggregates_without_broadcast(spark):
    customer = table(spark, SF_SMALL, "customer")
    nation = table(spark, SF_SMALL, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    big = enrich_and_aggregate(customer, nation, "c_nationkey", ["c_mktsegment"], ["n_name"],
                               value="c_acctbal", max_broadcast_rows=10)
    small = enrich_and_aggregate(customer, nation, "c_nationkey", ["c_mktsegment"], ["n_name"],
                                 value="c_acctbal")
    assert "partial_count" in plan(big).split("Join")[-1]
    assert sorted(big.collect()) == sorted(small.collect())


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["gold_top_n"](spark, SF_SMALL))


def test_partition_pruning_on_year_month(spark):
    p = plan(QUERIES["partition_prune_ym"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(year" in p and "(month" in p


def test_no_python_udf_in_sql_operators(spark):
    for key in ("medallion", "dedup_latest", "dq_gold", "broadcast_enrich", "null_profile"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_scale_conf_sizes_shuffles_from_input():
    from strata.session import scale_conf

    tb = 1024 ** 4
    big = scale_conf(100 * tb, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    mid = scale_conf(10 * tb, total_cores=8000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 40_960
    small = scale_conf(40 * 1024 ** 2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def shuffle_records(df) -> int:
    """Rows written by every shuffle of ``df``'s own execution (from SQL metrics)."""
    df.collect()  # runs df's own query execution (a write would plan a new one)
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):  # stages are leaves; their plan holds the exchange
            stack.append(node.plan())
            continue
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            total += metric.get().value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return total


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key holding a third of 300k rows crosses the shuffle once per map task."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), (F.col("id") % 97).alias("v"),
                                              F.col("id").cast("string").alias("s"))
    distinct_keys = 200_000 + 1
    for out in (dedup(df, ["k"], ["v"]), count_by(df, ["k"], "v", order=False)):
        written = shuffle_records(out)
        assert distinct_keys <= written <= distinct_keys + 8, written


def test_group_of_copies_is_reduced_before_the_shuffle(spark):
    from strata.operators.silver import distinct_rows

    copy = F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, 300_000, 1, 8).select(copy.alias("s"), F.lit(1).alias("one"))
    written = shuffle_records(distinct_rows(df))
    assert 200_001 <= written <= 200_001 + 8, written
