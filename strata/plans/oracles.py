"""DuckDB SQL equivalents of the registered queries (same column names).

The tables are DuckDB views named after the driver tables. Sums of money
values are exact decimal sums cast to double, as on the Spark side.
"""

from __future__ import annotations

LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_REST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]


def _dedup(keep: str) -> str:
    direction = "DESC NULLS LAST" if keep == "last" else "ASC NULLS FIRST"
    order = ", ".join(f"{c} {direction}" for c in LI_REST)
    return (f"SELECT {', '.join(LI_COLS)} FROM lineitem QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(LI_KEYS)} ORDER BY {order}) = 1")


def _long(table: str, columns: list[str], expr: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {expr.format(c=c)} AS {value} FROM {table}" for c in columns)


CUSTOMER_TEXT = ("c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey, "
                 "c_acctbal::varchar AS c_acctbal, c_mktsegment, NULL::varchar AS c_comment")
LI_NULLS = ("(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, nullif(l_returnflag, 'A') AS l_returnflag, l_linestatus, "
            "l_shipdate FROM lineitem)")
DOCS_GOLD = "SELECT source, lang, count(doc_id) AS qty FROM documents GROUP BY source, lang"
LI_GOLD = ("SELECT l_returnflag, l_linestatus, count(l_orderkey) AS qty FROM {src} "
           "GROUP BY l_returnflag, l_linestatus")
ORDERS_YEAR = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
               "o_orderpriority, year(o_orderdate)::int AS year FROM orders")

CUSTOMER_RERUN = "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal > 0"

# Silver lineitem and its drifted copy, compared row by row.
DRIFT = f"""good AS ({_dedup('last')}),
lost AS (SELECT * FROM good WHERE NOT (l_orderkey % 1000 = 7 AND l_linenumber = 1)),
odd1 AS (SELECT * REPLACE (
    CASE WHEN l_orderkey % 1000 = 11 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
    CASE WHEN l_orderkey % 1000 <> 13 THEN l_returnflag END AS l_returnflag) FROM lost),
odd AS (SELECT * FROM odd1
        UNION ALL SELECT * FROM odd1 WHERE l_orderkey % 1000 = 17 AND l_linenumber = 2)"""


def _column_drift(buckets: int) -> str:
    """(c, i, bucket): where the (key, value) pairs of a column are not the same multiset."""
    one = ("SELECT DISTINCT '{c}' AS c, {i} AS i, l_orderkey % {n} AS bucket FROM ("
           "(SELECT l_orderkey, l_linenumber, {c} AS v FROM good "
           "EXCEPT ALL SELECT l_orderkey, l_linenumber, {c} FROM odd) UNION ALL "
           "(SELECT l_orderkey, l_linenumber, {c} AS v FROM odd "
           "EXCEPT ALL SELECT l_orderkey, l_linenumber, {c} FROM good))")
    return " UNION ALL ".join(one.format(c=c, i=i, n=buckets) for i, c in enumerate(LI_COLS))


def _layer_columns(step: int, layer: str, src: str, columns: list[str], differ: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {step} AS step, '{layer}' AS layer, '{c}' AS column_name, true AS present, "
        f"count(*) AS rows, count(*) - count({c}) AS nulls, {differ.format(c=c)} AS buckets_differ "
        f"FROM {src}" for c in columns)


BACKFILLED = ("(SELECT *, (DATE '2026-03-01' + (doc_id % 6)::int)::date AS snapshot_date "
              "FROM documents WHERE doc_id % 6 IN (1, 3, 4) OR doc_id % 7 <> 0)")
CUSTOMER_ELEMENT = (
    """('{"c_custkey": ' || c_custkey || ', "c_name": "' || c_name || '", "wide": 1' || c_custkey """
    """|| '00000000000000000000000000.10, "power":' || c_nationkey || 'E5' """
    """|| CASE WHEN c_custkey % 100 = 7 THEN ',}' ELSE '}' END)""")


def _summary(columns: list[tuple[str, bool]], src: str) -> str:
    parts = []
    for c, number in columns:
        own, text = (f"min({c})::double", f"max({c})::double"), ("NULL", "NULL")
        if not number:
            own, text = ("NULL", "NULL"), (f"min({c})", f"max({c})")
        quantiles = ", ".join(
            (f"quantile_disc({c}, {q})::double" if number else "NULL::double") + f" AS q{q * 100:g}"
            for q in (0.25, 0.5, 0.75))
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS nulls, "
            f"{own[0]}::double AS min, {own[1]}::double AS max, {text[0]}::varchar AS min_text, "
            f"{text[1]}::varchar AS max_text, {quantiles} FROM {src}")
    return " UNION ALL ".join(parts)


ORACLES: dict[str, str] = {
    "medallion": DOCS_GOLD + " ORDER BY qty DESC, source, lang",
    "gold_stats": DOCS_GOLD + " ORDER BY qty DESC, source, lang",
    "silver_clean": ("SELECT doc_id AS id, trim('  ' || source || ' ') AS source, "
                     "trim(' ' || lang || '  ') AS lang, n_chars FROM documents"),
    "normalize_strings": ("SELECT c_custkey::varchar AS c_custkey, c_name, "
                          "c_nationkey::varchar AS c_nationkey, c_acctbal::varchar AS c_acctbal, "
                          "c_mktsegment FROM customer"),
    "bronze_metadata": ("SELECT *, TIMESTAMP '2026-02-02 00:00:00' AS ingested_at, "
                        "DATE '2026-02-02' AS ingested_date FROM customer"),
    "bronze_contract": f"SELECT {CUSTOMER_TEXT} FROM customer",
    "schema_evolve": ("SELECT o_orderkey, o_custkey::varchar AS o_custkey, o_orderstatus, "
                      "o_totalprice, o_orderdate::date AS o_orderdate, NULL::varchar AS o_clerk "
                      "FROM orders"),
    "bronze_stage": (f"SELECT {CUSTOMER_TEXT}, TIMESTAMP '2026-02-02 00:00:00' AS ingested_at, "
                     "DATE '2026-02-02' AS ingested_date, DATE '2026-02-02' AS snapshot_date "
                     "FROM customer"),
    "src_paged": "SELECT * FROM orders",
    "union_pages": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
        "NULL::varchar AS o_orderpriority FROM orders WHERE year(o_orderdate) < 1997 "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, NULL::double AS o_totalprice, "
        "o_orderdate, o_orderpriority FROM orders "
        "WHERE year(o_orderdate) >= 1997 AND year(o_orderdate) < 2000 "
        "UNION ALL SELECT * FROM orders WHERE year(o_orderdate) >= 2000"),
    "dedup_latest": _dedup("last"),
    "dedup_first": _dedup("first"),
    "dedup_report": ("SELECT coalesce(sum(n), 0)::bigint AS n_in, count(*) AS n_out, "
                     "coalesce(sum(n - 1), 0)::bigint AS removed, "
                     "count(*) FILTER (WHERE n > 1) AS dup_keys "
                     "FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"),
    "distinct_rows": "SELECT DISTINCT * FROM lineitem",
    "gold_top_n": DOCS_GOLD + " ORDER BY qty DESC, source, lang LIMIT 10",
    "gold_point_lookup": f"SELECT * FROM ({DOCS_GOLD}) WHERE source = 'src7' AND lang = 'en'",
    "ordered_sample": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "filter_threshold": "SELECT * FROM lineitem WHERE l_quantity > 10",
    "count_by_key": f"SELECT l_returnflag, count(*) AS n FROM {LI_NULLS} GROUP BY l_returnflag",
    "agg_non_null_keys": (f"SELECT l_returnflag, l_linestatus, count(*) AS n FROM {LI_NULLS} "
                          "WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL "
                          "GROUP BY l_returnflag, l_linestatus"),
    "date_parts_stats": (
        "SELECT year(o_orderdate)::int AS year, month(o_orderdate)::int AS month, "
        "day(o_orderdate)::int AS day, count(o_totalprice) AS n, "
        "min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice, "
        "sum(o_totalprice::decimal(18,2))::double AS sum_o_totalprice, "
        "sum(o_totalprice::decimal(18,2))::double / count(o_totalprice) AS avg_o_totalprice "
        "FROM orders GROUP BY 1, 2, 3"),
    "broadcast_enrich": (
        "SELECT n_name, c_mktsegment, count(*) AS n, "
        "sum(c_acctbal::decimal(18,2))::double AS sum_c_acctbal "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment"),
    "dq_gold": (
        f"WITH g AS ({LI_GOLD.format(src='lineitem')}), "
        "t AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_returnflag IS NULL OR "
        "l_linestatus IS NULL OR qty IS NULL) AS nulls, count(*) FILTER (WHERE qty <= 0) AS bad "
        "FROM g) "
        "SELECT 'required_columns' AS rule, 'error' AS severity, 0::bigint AS failed, "
        "true AS passed FROM t "
        "UNION ALL SELECT 'row_count', 'error', (CASE WHEN n < 1 THEN 1 ELSE 0 END)::bigint, "
        "n >= 1 FROM t "
        "UNION ALL SELECT 'no_null_keys', 'error', nulls, nulls = 0 FROM t "
        "UNION ALL SELECT 'positive_measure', 'error', bad, bad = 0 FROM t"),
    "dq_summary": (
        f"SELECT count(*) AS n_rows, count(DISTINCT l_returnflag) AS distinct_l_returnflag, "
        f"count(DISTINCT l_linestatus) AS distinct_l_linestatus, sum(qty)::bigint AS total_qty "
        f"FROM ({LI_GOLD.format(src='lineitem')})"),
    "null_profile": _long(LI_NULLS, LI_COLS, "count(*) FILTER (WHERE {c} IS NULL)", "null_count"),
    "distinct_profile": _long("orders", ORDERS_COLS, "count(DISTINCT {c})", "distinct_count"),
    "describe_stats": (
        "SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS count, "
        "round(sum(o_totalprice::decimal(18,2))::double / count(o_totalprice), 4) AS mean, "
        "round(stddev_samp(o_totalprice), 4) AS stddev, min(o_totalprice) AS min, "
        "max(o_totalprice) AS max FROM orders"),
    "dq_trimmed": _long(
        "(SELECT CASE WHEN lang = 'en' THEN source || ' ' ELSE source END AS source, lang "
        "FROM documents)", ["source", "lang"], "count(*) FILTER (WHERE {c} <> trim({c}))",
        "untrimmed"),
    "dq_row_bounds": ("SELECT count(*) AS n_rows, 1::bigint AS min_rows, "
                      "1000000::bigint AS max_rows, count(*) BETWEEN 1 AND 1000000 AS passed "
                      "FROM orders"),
    "row_count": "SELECT count(*) AS n_rows FROM orders",
    "guard_non_empty": "SELECT * FROM orders",
    "layer_reconcile": (
        f"WITH s AS ({_dedup('last')}), g AS ({LI_GOLD.format(src='s')}), "
        "c AS (SELECT 0 AS step, 'bronze' AS layer, count(*) AS rows FROM lineitem "
        "UNION ALL SELECT 1, 'silver', count(*) FROM s UNION ALL SELECT 2, 'gold', count(*) FROM g), "
        "p AS (SELECT step, layer, rows, lag(rows) OVER (ORDER BY step) AS prev_rows FROM c) "
        "SELECT step, layer, rows, prev_rows, prev_rows - rows AS removed, "
        "CASE WHEN prev_rows = 0 THEN 0.0::double "
        "ELSE 100.0::double * (prev_rows - rows) / prev_rows END AS reduction_pct FROM p"),
    "partition_skew": ("SELECT o_custkey % 8 AS bucket, count(*) AS n_rows, "
                       "count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY 1"),
    "scan_parquet": "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0",
    "write_roundtrip": DOCS_GOLD,
    "scan_json_roundtrip": "SELECT * FROM customer",
    "csv_export": "SELECT * FROM customer",
    "partition_by_value": "SELECT * FROM customer",
    "partition_by_value_rerun": CUSTOMER_RERUN,
    "snapshot_rerun_by_value": CUSTOMER_RERUN,
    "snapshot_read_flat": "SELECT *, DATE '2026-02-02' AS snapshot_date FROM orders",
    "staged_checkpoint": LI_GOLD.format(src=f"({_dedup('last')})"),
    "snapshot_read": ("SELECT *, DATE '1997-01-01' AS snapshot_date FROM orders "
                      "WHERE year(o_orderdate) = 1997"),
    "partition_prune_ym": ("SELECT *, year(o_orderdate)::int AS year, "
                           "month(o_orderdate)::int AS month FROM orders "
                           "WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3"),
    "snapshot_overwrite": ("SELECT o_orderkey, o_custkey, o_orderstatus, "
                           "CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice * 2 "
                           "ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority, "
                           "year(o_orderdate)::int AS year FROM orders"),
    "list_snapshots": "SELECT DISTINCT year(o_orderdate)::int AS year FROM orders",
    "snapshot_retention": f"SELECT * FROM ({ORDERS_YEAR}) WHERE year >= 1998",
    "layer_validate": (
        f"WITH {DRIFT}, d AS ({_column_drift(64)}), g AS ({LI_GOLD.format(src='good')}) "
        + _layer_columns(0, "bronze", "lineitem", LI_COLS, "NULL::bigint") + " UNION ALL "
        + _layer_columns(1, "silver", "odd", LI_COLS,
                         "(SELECT count(*) FROM d WHERE d.c = '{c}')")
        + " UNION ALL SELECT 1, 'silver', 'l_comment', false, count(*), NULL, NULL FROM odd "
          "UNION ALL "
        + _layer_columns(2, "gold", "g", ["l_returnflag", "l_linestatus", "qty"], "0::bigint")),
    "layer_drift": (
        f"WITH {DRIFT}, d AS ({_column_drift(1000)}), "
        "c AS (SELECT bucket, string_agg(c, ',' ORDER BY i) AS columns FROM d GROUP BY bucket) "
        "SELECT bucket, (SELECT count(*) FROM good WHERE l_orderkey % 1000 = bucket) AS "
        "expected_rows, (SELECT count(*) FROM odd WHERE l_orderkey % 1000 = bucket) AS "
        "actual_rows, columns FROM c"),
    "layer_diff": (
        f"WITH {DRIFT}, b AS (SELECT *, 1 AS sign FROM odd UNION ALL SELECT *, -1 FROM good) "
        f"SELECT {', '.join(LI_COLS)}, sum(sign)::bigint AS surplus FROM b GROUP BY ALL "
        "HAVING sum(sign) <> 0"),
    "backfill": ("SELECT snapshot_date, source, lang, count(doc_id) AS qty FROM "
                 f"{BACKFILLED} GROUP BY ALL"),
    "backfill_metrics": (
        "WITH n AS (SELECT snapshot_date, count(*) AS rows, count(DISTINCT (source, lang)) AS "
        f"groups FROM {BACKFILLED} GROUP BY 1), "
        "m AS (SELECT * FROM (VALUES (0, 'landing', 'rows'), (0, 'landing', 'missing_pages'), "
        "(1, 'bronze', 'rows'), (1, 'bronze', 'missing_required'), (1, 'bronze', 'malformed'), "
        "(2, 'silver', 'rows'), (2, 'silver', 'null_id'), (2, 'silver', 'null_source'), "
        "(2, 'silver', 'null_lang'), (3, 'gold', 'rows'), (3, 'gold', 'failed_no_null_keys'), "
        "(3, 'gold', 'failed_positive_measure')) AS v(step, stage, metric)) "
        "SELECT snapshot_date, step, stage, metric, (CASE WHEN metric <> 'rows' THEN 0 "
        "WHEN stage = 'gold' THEN groups ELSE rows END)::bigint AS value FROM n, m"),
    "hot_keys": (
        "WITH s AS (SELECT 'source' AS key, nullif(source, 'src3') AS value, count(*) AS n_rows, "
        "count(*) / sum(count(*)) OVER () AS share FROM documents GROUP BY 2), "
        "p AS (SELECT 'status,priority' AS key, o_orderstatus || ',' || o_orderpriority AS value, "
        "count(*) AS n_rows, count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY 2) "
        "SELECT * FROM s WHERE share >= 0.04 UNION ALL SELECT * FROM p WHERE share >= 0.05"),
    "summarize": _summary(
        [("o_orderkey", True), ("o_custkey", True), ("o_totalprice", True),
         ("o_orderstatus", False), ("o_orderpriority", False)],
        "(SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)"),
    "summarize_sketch": (
        "SELECT c AS column_name, q::double AS quantile, (SELECT count(*) FROM orders) AS n, "
        "true AS within_error FROM (VALUES ('o_custkey'), ('o_totalprice')) AS c(c), "
        "(VALUES (0.25), (0.5), (0.75)) AS q(q)"),
    "distinct_merged": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT year(o_orderdate)) AS snapshots, "
        f"count(*) AS rows, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_count, "
        "true AS within_error FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998"
        for c in ("o_custkey", "o_orderpriority", "o_orderdate")),
    "json_arrays": (
        f"SELECT c_custkey // 1000 AS part, CASE WHEN ok THEN c_custkey::varchar END AS c_custkey, "
        "CASE WHEN ok THEN c_name END AS c_name, CASE WHEN ok THEN '1' || c_custkey || "
        "'00000000000000000000000000.10' END AS wide, CASE WHEN ok THEN c_nationkey || 'E5' END "
        f"AS power, CASE WHEN NOT ok THEN {CUSTOMER_ELEMENT} END AS _corrupt_record "
        "FROM (SELECT *, c_custkey % 100 <> 7 AS ok FROM customer)"),
    "union_widen": (
        "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_custkey::varchar "
        "WHEN 1 THEN o_custkey || '.0' ELSE 'C' || o_custkey END AS o_custkey, "
        "o_totalprice::decimal(18,4) AS o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN "
        "o_orderdate::date::timestamp WHEN o_orderkey % 3 = 1 THEN o_orderdate END AS o_orderdate, "
        "CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders"),
    "cached_reuse": (
        f"WITH s AS ({_dedup('last')}) SELECT 'rows' AS result, count(*) AS n FROM s "
        "UNION ALL SELECT 'groups', count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM s) "
        "UNION ALL SELECT 'parts', count(DISTINCT l_partkey) FROM s"),
}
