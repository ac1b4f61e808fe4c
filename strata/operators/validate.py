"""End-to-end layer validation: what each layer holds, and where it drifts from its source.

A layer is compared with what the layer before it should have become (``expected``), without
joining their rows: both sides are reduced to one checksum per column and key bucket,
which no order, partitioning or retry changes. A checksum is the sum, in two halves, of
``xxhash64`` over the key and the value of a column, so a lost, repeated, altered or swapped value changes
its bucket, and repeated rows do not cancel out. One aggregate per side yields rows, nulls and
checksums together; the side tables have ``buckets`` rows. Only rows of buckets that differ are
looked at again, by ``drifted_rows``.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import DataQualityError

BUCKETS = 256


@dataclass(frozen=True)
class Layer:
    """A layer to validate: its rows, the key that tells them apart, the columns it must have
    (``required``) and, if known, the rows it should hold."""

    name: str
    df: DataFrame
    keys: Sequence[str] = ()
    required: Sequence[str] = ()
    expected: DataFrame | None = None

    def columns(self) -> list[str]:
        """Columns of the layer, then those it lacks."""
        lacking = [*self.required, *(self.expected.columns if self.expected is not None else ())]
        return [*self.df.columns, *dict.fromkeys(c for c in lacking if c not in self.df.columns)]

    def compared(self) -> list[str]:
        """Columns that both the layer and its expectation have."""
        if self.expected is None:
            return []
        return [c for c in self.expected.columns if c in self.df.columns]


def _q(name: str) -> str:
    """A column name as SQL has it. Expressions are SQL texts here: a wide layer needs hundreds,
    and a text is one call to the JVM where a ``Column`` takes one for each of its parts."""
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key(keys: Sequence[str]) -> str:
    """A key as text, so that both sides agree whatever its type; nulls are told apart."""
    return ", ".join(f"{_q(k)} is null, cast({_q(k)} as string)" for k in keys)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.expr(f"cast(pmod(xxhash64({_key(keys)}), {buckets}) as int)") if keys else F.lit(0)


def _checked(layer: Layer) -> dict[str, bool]:
    """Compared columns, and whether their values meet as text because the types differ."""
    if layer.expected is None:
        return {}
    want, have = layer.expected.schema, layer.df.schema
    return {c: want[c].dataType != have[c].dataType for c in layer.compared()}


def _side(df: DataFrame, layer: Layer, buckets: int, bucket: Column | None) -> DataFrame:
    """(bucket, rows, n<i> nulls, h<i> and l<i> checksums): one aggregate over one side."""
    names, checked = layer.columns(), _checked(layer)
    keys = [k for k in layer.keys if k in checked]
    lead = f"{_key(keys)}, " if keys else ""
    aggs = ["count(1) as rows"]
    for i, c in enumerate(names):
        if c not in df.columns:
            continue
        aggs.append(f"count_if({_q(c)} is null) as n{i}")
        if c in checked:
            value = f"cast({_q(c)} as string)" if checked[c] else _q(c)
            h = f"xxhash64({lead}{_q(c)} is null, {value})"
            aggs += [f"sum(shiftright({h}, 32)) as h{i}", f"sum({h} & 4294967295L) as l{i}"]
    where = _bucket(layer.keys, buckets) if bucket is None else bucket
    return df.groupBy(where.alias("bucket")).agg(*map(F.expr, aggs))


def _differences(layer: Layer, buckets: int, bucket: Column | None) -> DataFrame:
    """The layer's side table, with a flag d<i> per compared column and the rows expected."""
    have = _side(layer.df, layer, buckets, bucket)
    if layer.expected is None:
        return have
    own = [i for i, c in enumerate(layer.columns()) if c in _checked(layer)]
    want = _side(layer.expected, layer, buckets, bucket).selectExpr(
        "bucket", "rows as want_rows", *[f"{s}{i} as want_{s}{i}" for i in own for s in "hl"])
    # One row per side and bucket at most, so the larger value is the only one: no join.
    both = have.unionByName(want, allowMissingColumns=True)
    both = both.groupBy("bucket").agg(*[F.expr(f"max({c}) as {c}") for c in both.columns
                                        if c != "bucket"])
    return both.selectExpr("*", *[
        f"not (h{i} <=> want_h{i} and l{i} <=> want_l{i} and rows <=> want_rows) as d{i}"
        for i in own])


def validate_layers(layers: Sequence[Layer], buckets: int = BUCKETS,
                    bucket: Column | None = None) -> DataFrame:
    """One row per layer and column: ``step, layer, column_name, present, rows, nulls,
    buckets_differ``.

    ``rows`` and ``nulls`` are the layer's (``nulls`` is null for an absent column);
    ``buckets_differ`` counts the key buckets whose checksum is not the expected one, and is null where
    nothing is expected. ``bucket`` replaces the default bucket of the key, for all layers.
    """
    if not layers:
        raise ValueError("validate_layers needs at least one layer")
    parts = []
    for step, layer in enumerate(layers):
        names, compared = layer.columns(), set(layer.compared())
        sums, rows = ["coalesce(sum(rows), 0L) as rows"], []
        for i, c in enumerate(names):
            nulls = differ = "cast(null as bigint)"
            if c in layer.df.columns:
                sums.append(f"coalesce(sum(n{i}), 0L) as n{i}")
                nulls = f"n{i}"
            if c in compared:
                sums.append(f"count_if(d{i}) as d{i}")
                differ = f"d{i}"
            rows.append(f"named_struct('column_name', {_text(c)}, 'present', "
                        f"{str(c in layer.df.columns).lower()}, 'nulls', {nulls}, "
                        f"'buckets_differ', {differ})")
        parts.append(_differences(layer, buckets, bucket).agg(*map(F.expr, sums)).selectExpr(
            f"{step} as step", f"{_text(layer.name)} as layer", "rows",
            f"inline(array({', '.join(rows)}))"))
    report = functools.reduce(DataFrame.unionByName, parts)
    return report.select("step", "layer", "column_name", "present", "rows", "nulls",
                         "buckets_differ")


def drifted_buckets(layer: Layer, buckets: int = BUCKETS,
                    bucket: Column | None = None) -> DataFrame:
    """``bucket, expected_rows, actual_rows, columns``: the buckets that differ from what is
    expected, and in which columns (all of them where rows are missing or too many)."""
    own = [(i, c) for i, c in enumerate(layer.columns()) if c in layer.compared()]
    if not own:
        raise ValueError(f"layer {layer.name} has nothing to be compared with")
    found = F.expr("filter(array({}), x -> x is not null)".format(
        ", ".join(f"if(d{i}, {_text(c)}, null)" for i, c in own)))
    return (_differences(layer, buckets, bucket).withColumn("columns", found)
            .filter(F.size("columns") > 0)
            .select("bucket", F.coalesce("want_rows", F.lit(0)).alias("expected_rows"),
                    F.coalesce("rows", F.lit(0)).alias("actual_rows"), "columns"))


def drifted_rows(layer: Layer, buckets: int = BUCKETS, bucket: Column | None = None) -> DataFrame:
    """The compared columns of rows that one side has more often, and ``surplus``: how many
    more the layer has than expected (negative: missing).

    Only rows in buckets that differ are shuffled: the list of those buckets (``buckets``
    rows at most) is broadcast. Copies are counted, so repeated rows are found too.
    """
    where = _bucket(layer.keys, buckets) if bucket is None else bucket
    bad = F.broadcast(drifted_buckets(layer, buckets, bucket).select(
        F.col("bucket").alias("_bucket")))
    texts = _checked(layer)
    sides = []
    for df, sign in ((layer.df, 1), (layer.expected, -1)):
        rows = df.join(bad, where == F.col("_bucket"), "left_semi")
        sides.append(rows.selectExpr(*[f"cast({_q(c)} as string) as {_q(c)}" if as_text else _q(c)
                                       for c, as_text in texts.items()], f"{sign} as _sign"))
    return (sides[0].unionByName(sides[1]).groupBy(*map(_q, texts))
            .agg(F.sum("_sign").alias("surplus")).filter("surplus <> 0"))


def enforce_layers(report: DataFrame) -> list:
    """Collect a (small) ``validate_layers`` report; raise ``DataQualityError`` for an empty
    layer, an absent column or drifted buckets."""
    rows = report.collect()
    bad = [f"{r['layer']}: empty" for r in {r["layer"]: r for r in rows if not r["rows"]}.values()]
    bad += [f"{r['layer']}.{r['column_name']}: absent" for r in rows if not r["present"]]
    bad += [f"{r['layer']}.{r['column_name']}: {r['buckets_differ']} buckets differ"
            for r in rows if r["buckets_differ"]]
    if bad:
        raise DataQualityError("; ".join(bad))
    return rows
