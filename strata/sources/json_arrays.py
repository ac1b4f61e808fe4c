"""JSON payloads taken apart in the JVM, every element's text kept as it was received.

A payload is one JSON array, or JSON lines. Elements of an array are cut out by one regular
expression whose nesting is written out ``DEPTH`` levels deep, with possessive loops only, so
it runs in linear time and constant stack. What it leaves must be the array's
own brackets and commas; anything else (a cut-off string, deeper nesting, a missing comma) becomes one
more record, which no parser accepts, so a broken payload is quarantined with its text and
loses none of its good elements.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Levels of objects and arrays inside one element.
DEPTH = 24
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_BLANK = " \t\r\n\ufeff"


def _nested(depth: int) -> str:
    """An object or array with up to ``depth`` levels inside."""
    inner = f"|{_nested(depth - 1)}" if depth else ""
    return rf'[\[{{](?:[^\[\]{{}}"]++|{_STRING}{inner})*+[\]}}]'


#: One value: an object or array, a string, or a bare word such as a number.
VALUE = rf'(?s:{_nested(DEPTH)}|{_STRING}|[^\s\[\]{{}},":]++)'


def _element_lines(element: Column) -> Column:
    """Line breaks between an element's tokens (JSON strings hold none) become spaces."""
    return F.translate(element, "\r\n", "  ")


def array_elements(payload: Column) -> Column:
    """The element texts of one JSON array, then what is left if the payload is broken."""
    whole = F.btrim(payload, F.lit(_BLANK))
    closed = F.endswith(whole, F.lit("]")) & (F.char_length(whole) > 1)
    body = F.substring(whole, F.lit(2), F.char_length(whole) - F.when(closed, 2).otherwise(1))
    found = F.regexp_extract_all(body, F.lit(VALUE), F.lit(0))
    rest = F.regexp_replace(body, VALUE, "")
    commas = F.char_length(F.regexp_replace(rest, r"[^,]", ""))
    sound = closed & (F.btrim(F.translate(rest, ",", ""), F.lit(_BLANK)) == "") & (
        commas == F.greatest(F.size(found) - 1, F.lit(0)))
    elements = F.transform(found, _element_lines)
    return F.when(sound, elements).otherwise(
        F.concat(elements, F.array(F.concat(F.lit("broken array: "), _element_lines(rest)))))


def records_of(payload: Column) -> Column:
    """The record texts of a payload: a JSON array's elements, or the lines that are not blank."""
    lines = F.filter(F.split(payload, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    whole = F.coalesce(payload, F.lit(""))
    return (F.when(F.startswith(F.btrim(whole, F.lit(_BLANK)), F.lit("[")), array_elements(whole))
            .otherwise(F.coalesce(lines, F.array().cast("array<string>"))))


def read_payloads(spark: SparkSession, path: str, key: str | None = None,
                  key_type: T.DataType | None = None) -> DataFrame:
    """``(key, payload)``: every file below ``path`` as one row, by Spark's text reader.

    ``key`` is a partition column of the folders (``<path>/<key>=<value>/…``). A file is one
    value, so it has 2 GB at most; write larger days as several files or as JSON lines.
    """
    fields = [T.StructField("value", T.StringType())]
    if key:
        fields.append(T.StructField(key, key_type or T.StringType()))
    rows = (spark.read.schema(T.StructType(fields)).option("basePath", path)
            .text(path, wholetext=True))
    return rows.select(*([key] if key else []), F.col("value").alias("payload"))


def read_json_arrays(spark: SparkSession, path: str, key: str | None = None,
                     key_type: T.DataType | None = None) -> DataFrame:
    """``(key, position, record)``: the records of every payload file, each with its text.

    Parse them with ``strata.operators.bronze.from_json_records``, which quarantines a
    malformed one by its raw text.
    """
    keep = [key] if key else []
    return read_payloads(spark, path, key, key_type).select(
        *keep, F.posexplode(records_of(F.col("payload"))).alias("position", "record"))


def raw_members(record: Column) -> Column:
    """(name, value) texts of an object's own members, as received; a name keeps its quotes."""
    member = rf'(?s){_STRING}\s*+:\s*+{VALUE}'
    body = F.substring(F.btrim(record, F.lit(_BLANK)), F.lit(2), F.char_length(record))
    name = rf'(?s)^({_STRING})\s*+:\s*+(.*)$'
    return F.transform(F.regexp_extract_all(body, F.lit(member), F.lit(0)), lambda m: F.struct(
        F.regexp_extract(m, name, 1).alias("name"), F.regexp_extract(m, name, 2).alias("value")))


def raw_value(members: Column, name: str) -> Column:
    """The text of a member that is a number, a truth value, an object or an array; else null.

    Texts and null are the parser's to read. A name written with escapes is not found.
    """
    key = '"' + re.sub(r'(["\\])', r"\\\1", name) + '"'
    mine = F.filter(members, lambda m: m["name"] == key)
    value = F.element_at(mine, -1)["value"]
    return F.when((F.size(mine) > 0) & ~F.startswith(value, F.lit('"')) & (value != "null"), value)
