"""Silver: select / trim / rename, and deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col, orderable

# The Silver projection of the Bronze contract, in output order.
# (source column, output column, trimmed?)
SILVER_COLUMNS = (
    ("id", "id", False),
    ("name", "name", True),
    ("brewery_type", "brewery_type", True),
    ("state_province", "state", True),
    ("city", "city", True),
    ("country", "country", True),
    ("website_url", "website_url", False),
    ("phone", "phone", False),
    ("ingested_at", "ingested_at", False),
)


def clean(df: DataFrame, columns: Sequence[tuple[str, str, bool]] = SILVER_COLUMNS) -> DataFrame:
    """One projection: keep, rename and ``trim`` columns per ``(source, target, trim)``."""
    out = []
    for src, dst, trim in columns:
        c = F.trim(col(src)) if trim else col(src)
        out.append(c.alias(dst))
    return df.select(*out)


def clean_columns(df: DataFrame, trim: Sequence[str] = (), rename: Mapping[str, str] | None = None,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """``clean`` spelled by column lists instead of a spec."""
    rename = dict(rename or {})
    trim_set = set(trim)
    keep = list(keep) if keep is not None else df.columns
    return clean(df, [(c, rename.get(c, c), c in trim_set) for c in keep])


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), keep: str = "last",
          null_keys: str = "collapse") -> DataFrame:
    """Keep exactly one row per key, chosen by a total order.

    Rows are ordered by ``order_by`` and then by every other orderable column
    (in ``df`` column order), so the survivor never depends on partitioning or
    arrival order. ``keep="last"`` keeps the greatest row (nulls lowest, the
    order of ``ORDER BY … DESC NULLS LAST``); ``keep="first"`` the smallest
    (``ASC NULLS FIRST``).

    Plan: ``max``/``min`` of a struct per key. It is a partial + final
    aggregate, so a hot key is reduced to one row per map task before the
    shuffle; a key holding a third of the data never lands whole in one task.

    ``null_keys``: ``"collapse"`` treats null keys as equal (one survivor, as
    ``dropDuplicates`` does); ``"keep"`` passes rows with a null key through.
    """
    if keep not in ("last", "first"):
        raise ValueError("keep must be 'last' or 'first'")
    if null_keys not in ("collapse", "keep"):
        raise ValueError("null_keys must be 'collapse' or 'keep'")
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order_by if c not in keys]  # a key does not order its own group
    order += [c for c in rest if c not in order and orderable(df.schema[c].dataType)]
    other = [c for c in rest if c not in order]
    pick = F.max if keep == "last" else F.min
    by = F.max_by if keep == "last" else F.min_by
    ranked = F.struct(*[col(c).alias(f"_o{i}") for i, c in enumerate(order)])

    source = df
    passthrough = None
    if null_keys == "keep":
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | col(k).isNull()
        passthrough = df.filter(any_null)
        source = df.filter(~any_null)

    aggs = [pick(ranked).alias("_best")] + [by(col(c), ranked).alias(c) for c in other]
    best = source.groupBy(*map(col, keys)).agg(*aggs)
    picked = [F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)]
    out = best.select(*map(col, [*keys]), *picked, *map(col, other)).select(*map(col, df.columns))
    return out if passthrough is None else out.unionByName(passthrough)


def dedup_window(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
                 keep: str = "last") -> DataFrame:
    """The ``row_number() = 1`` form of ``dedup`` (same survivor).

    Catalyst plans it with a partial ``WindowGroupLimit`` before the shuffle;
    ``dedup`` is the default because its aggregate form measured faster.
    """
    from pyspark.sql import Window

    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order_by if c not in keys]  # a key does not order its own group
    order += [c for c in rest if c not in order and orderable(df.schema[c].dataType)]
    sort = [col(c).desc_nulls_last() if keep == "last" else col(c).asc_nulls_first() for c in order]
    w = Window.partitionBy(*map(col, keys)).orderBy(*sort)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``n_in`` rows, ``n_out`` distinct keys, ``removed``, ``dup_keys``.

    Null keys count as one key (the ``collapse`` policy). Two aggregates: rows
    per key (partial-aggregated map-side), then four totals over the keys.
    """
    per_key = df.groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_in"),
        F.count(F.lit(1)).alias("n_out"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("removed"),
        F.count_if(F.col("_n") > 1).alias("dup_keys"),
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication (hash aggregate on every column, partial map-side)."""
    return df.distinct()
