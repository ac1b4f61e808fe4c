"""Bronze: raw records conformed to an all-text contract plus ingestion metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.contracts import BRONZE_CONTRACT, all_strings, conform
from strata.sources.json_arrays import raw_members, raw_value


def normalize_strings(df: DataFrame, contract: T.StructType | None = None) -> DataFrame:
    """Every value as text, contract fields only, missing fields as null.

    Without a contract every column of ``df`` is kept and cast to string. Spark
    cast semantics apply (``true`` not ``True``; doubles in shortest form).
    """
    return conform(df, contract if contract is not None else all_strings(df.columns))


def run_timestamp(run_ts: str | dt.datetime | None) -> Column:
    """The logical run instant as ``timestamp_ntz`` (UTC wall clock).

    Pass the run's logical time so reruns reproduce the same values; ``None``
    falls back to the query start time.
    """
    if run_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(run_ts, dt.datetime):
        run_ts = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def add_ingest_metadata(df: DataFrame, run_ts: str | dt.datetime | None = None,
                        ts_col: str = "ingested_at", date_col: str = "ingested_date") -> DataFrame:
    """Append ``ingested_at`` (timestamp) and ``ingested_date`` (its date)."""
    ts = run_timestamp(run_ts)
    return df.select("*", ts.alias(ts_col), F.to_date(ts).alias(date_col))


def to_bronze(df: DataFrame, contract: T.StructType = BRONZE_CONTRACT,
              run_ts: str | dt.datetime | None = None) -> DataFrame:
    """Bronze rows: contract projection (all text) followed by ingestion metadata."""
    return add_ingest_metadata(normalize_strings(df, contract), run_ts)


CORRUPT_RECORD = "_corrupt_record"


def from_json_records(records: DataFrame, contract: T.StructType = BRONZE_CONTRACT,
                      column: str = "record", corrupt: str | None = CORRUPT_RECORD,
                      exact: bool = False) -> DataFrame:
    """Parse one-JSON-object-per-row text into the contract, JVM-side.

    With text fields, JSON numbers/booleans/objects keep their raw JSON text,
    so row-to-row type drift (``1`` vs ``1.0``) never breaks the load. Other
    columns of ``records`` (for example a page number) are kept in front. A
    record that is not valid JSON keeps its raw text in the ``corrupt`` column
    (null for good records) instead of silently becoming a row of nulls.

    The parser may write a number anew (``1E5`` as ``100000.0``, and more than 17 digits with a
    fraction rounded). ``exact`` keeps the text fields' numbers, truth values and nested values
    as they were received, at the price of one more pass over the record's text.
    """
    keep = [c for c in records.columns if c != column]
    schema = contract
    options = {"mode": "PERMISSIVE"}
    if corrupt:
        schema = T.StructType(list(contract.fields) + [T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = F.from_json(F.col(column), schema, options).alias("_r")
    if not exact:
        return records.select(*keep, parsed).select(*keep, "_r.*")
    rows = records.select(*keep, parsed, raw_members(F.col(column)).alias("_m"))
    text = {f.name for f in contract.fields if isinstance(f.dataType, T.StringType)}
    fields = []
    for f in schema.fields:
        value = F.col("_r")[f.name]
        if f.name in text:
            value = F.when(value.isNotNull(), F.coalesce(raw_value(F.col("_m"), f.name), value))
        fields.append(value.alias(f.name))
    return rows.select(*keep, *fields)
