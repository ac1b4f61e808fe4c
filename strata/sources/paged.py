"""Paged records: page files by Spark's text reader, or an HTTP endpoint.

Each record comes as its raw JSON text next to its page number, and
``strata.operators.bronze.from_json_records`` parses it into a contract in the JVM.

* ``path``: page payload files laid out as ``<path>/page=<n>/*`` (JSON lines, or one JSON
  array per file). Spark discovers ``page`` as a partition column, packs the small files into
  tasks and takes the payloads apart in the JVM (``strata.sources.json_arrays``); no Python
  runs. Every page there is gets read, and gaps show in ``page_report``.
* ``path`` with ``packed``: the same payloads as lines of JSON files, many pages to a file
  (``pack_pages``). A folder per page costs the driver a move, a listing and a plan entry for
  every few records; packed, these costs follow the bytes.
* ``url``: an HTTP endpoint answering ``?page=<n>&per_page=<k>`` with a JSON array (used only
  where the executors can reach it), as a Spark Python Data Source: executors fetch several pages per
  input partition; options ``retries`` (per page), ``timeout`` and ``min_interval`` (seconds
  between one task's requests). The page count is given, or the driver finds the first empty
  page with O(log P) probes. A page before the last that is empty is an error wherever it
  lies: the probes go on past the end they find, and a task that meets one fails too.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strata.functions.contracts import BRONZE_CONTRACT
from strata.sources.json_arrays import read_payloads, records_of

SOURCE_NAME = "strata_paged"


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first = first
        self.last = last


def _split_records(payload: bytes) -> list[str]:
    """Records of one page file: a JSON array, or JSON lines, each as it was received.

    Only a line feed ends a line: JSON text may hold U+2028 and its like. An array's
    elements are cut from the text, so numbers and escapes keep their form; line breaks
    between an element's tokens (JSON strings hold none) become spaces.
    """
    text = payload.decode("utf-8").strip()
    if not text:
        return []
    if not text.startswith("["):
        return [line for line in text.split("\n") if line.strip()]
    records, at, parse = [], 1, json.JSONDecoder().raw_decode
    while True:
        while at < len(text) and text[at] in " \t\r\n,":
            at += 1
        if text[at:at + 1] == "]":
            return records
        _, end = parse(text, at)
        records.append(text[at:end].replace("\r", " ").replace("\n", " "))
        at = end


class _HttpPages:
    def __init__(self, url: str, per_page: int, retries: int, timeout: float,
                 min_interval: float = 0.0):
        self.url, self.per_page, self.retries, self.timeout = url, per_page, retries, timeout
        self.min_interval = min_interval  # rate limit: seconds between requests of one task
        self._last = None

    def _pace(self) -> None:
        if self.min_interval and self._last is not None:
            wait = self.min_interval - (time.monotonic() - self._last)
            if wait > 0:
                time.sleep(wait)
        self._last = time.monotonic()

    def fetch(self, page: int) -> list[str]:
        import urllib.parse
        import urllib.request

        sep = "&" if "?" in self.url else "?"
        query = urllib.parse.urlencode({"page": page, "per_page": self.per_page})
        for attempt in range(self.retries + 1):  # the retry budget is per page
            self._pace()
            try:
                with urllib.request.urlopen(f"{self.url}{sep}{query}", timeout=self.timeout) as r:
                    return _split_records(r.read())
            except OSError:
                if attempt == self.retries:
                    raise
                time.sleep(2 ** attempt)
        return []


def _fetcher(options: dict):
    if options.get("url"):
        return _HttpPages(options["url"], int(options.get("per_page", 200)),
                          int(options.get("retries", 3)), float(options.get("timeout", 30)),
                          float(options.get("min_interval", 0)))
    raise ValueError("the paged data source needs a 'url' option")


#: Pages asked for past the end that was found: a gap has fewer pages than this.
CONFIRM = 3


def discover_page_count(fetch, start: int = 1, confirm: int = CONFIRM) -> int:
    """Number of pages before the first empty one, in O(log P) fetches.

    Exponential probing finds an empty page, then a binary search finds the end. A gap can
    lead that search astray, so ``confirm`` pages past the end are asked for as well: one with
    records means that an empty page was taken for the end, which is an error.
    """
    end = _last_page(fetch, start)
    for page in range(end + 1, end + 1 + confirm):
        if fetch(page):
            raise RuntimeError(f"page {page} has records, but a page before it is empty")
    return end - start + 1


def _last_page(fetch, start: int) -> int:
    if not fetch(start):
        return start - 1
    lo, hi = start, start + 1
    while fetch(hi):
        lo, hi = hi, start + 2 * (hi - start + 1)
    while hi - lo > 1:  # fetch(lo) is non-empty, fetch(hi) is empty
        mid = (lo + hi) // 2
        if fetch(mid):
            lo = mid
        else:
            hi = mid
    return lo


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self):
        fetcher, pages = _fetcher(self.options), self.options.get("pages")
        n = int(pages) if pages is not None else discover_page_count(fetcher.fetch)
        per = max(1, int(self.options.get("pages_per_partition", 16)))
        return [PageRange(first, min(first + per - 1, n)) for first in range(1, n + 1, per)]

    def read(self, partition: PageRange):
        import pyarrow as pa

        fetcher = _fetcher(self.options)
        for page in range(partition.first, partition.last + 1):
            records = fetcher.fetch(page)
            if not records and not self.options.get("pages"):
                raise RuntimeError(f"page {page} is empty, but later pages are not")
            if records:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([page] * len(records), pa.int32()), pa.array(records, pa.string())],
                    names=["page", "record"])


class PagedSource(DataSource):
    """``spark.read.format("strata_paged").option("url", …).load()``."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return "page int, record string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(self.options)


#: Pages in one folder of a packed landing.
FOLDER_PAGES = 1000
#: A payload's records lie within a block of two to this power rows of the input.
_BLOCK_BITS = 10


def pack_pages(records: DataFrame) -> DataFrame:
    """``(first_page, page, payload)`` of ``(page, record)`` rows: a page's records as JSON lines.

    Write it with ``write_partitioned(…, ["first_page"], fmt="json")``, the first page of the
    folder, and read it with ``packed=True`` (a columnar file's reader would hold thousands of
    whole payloads at once). Records are JSON objects. A page's records meet in one payload
    where they lie close to each other in the input, so a page of any size (records without a
    page number are one) needs no task or row that holds it whole. The blocks follow the order
    of the input's rows: give a table, not the result of a shuffle, which a retry may reorder.
    """
    lines = records.select(
        "page", F.translate("record", "\r\n", "  ").alias("record"),
        F.shiftright(F.monotonically_increasing_id(), _BLOCK_BITS).alias("block"))
    first = F.col("page") - F.pmod(F.col("page"), F.lit(FOLDER_PAGES))
    return (lines.groupBy("page", "block").agg(F.collect_list("record").alias("records"))
            .select(first.alias("first_page"), "page",
                    F.array_join("records", "\n").alias("payload")))


def _packed_payloads(spark: SparkSession, path: str) -> DataFrame:
    fields = T.StructType([T.StructField("page", T.LongType()),
                           T.StructField("payload", T.StringType())])
    # the parser's default limit on one text is below that of a payload of long records
    return (spark.read.schema(fields).option("maxStringLen", 2**31 - 1).json(path, mode="FAILFAST")
            .select(F.col("page").cast("int").alias("page"), "payload"))


def read_pages(spark: SparkSession, *, path: str | None = None, url: str | None = None,
               pages: int | None = None, pages_per_partition: int = 16, packed: bool = False,
               **options) -> DataFrame:
    """Raw ``(page, record)`` rows of a paged source (records as JSON text).

    ``pages`` keeps pages up to that number. ``pages_per_partition`` is for URLs; files are
    packed by their sizes (``spark.sql.files.maxPartitionBytes``, ``openCostInBytes``).
    ``packed`` says that ``path`` holds what ``pack_pages`` made instead of a folder per page.
    """
    if path:
        if packed:
            found = _packed_payloads(spark, path.rstrip("/"))
        else:
            found = read_payloads(spark, path.rstrip("/"), "page", T.IntegerType())
        if pages is not None:
            found = found.filter(F.col("page") <= int(pages))
        return found.select("page", F.explode(records_of(F.col("payload"))).alias("record"))
    # The reader needs only this module; ship it by value so executors do not
    # have to import the package.
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedSource)
    reader = spark.read.format(SOURCE_NAME).option("pages_per_partition", pages_per_partition)
    if url:
        reader = reader.option("url", url)
    if pages is not None:
        reader = reader.option("pages", pages)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


def read_paged(spark: SparkSession, contract: T.StructType = BRONZE_CONTRACT, **kwargs) -> DataFrame:
    """Paged records parsed into ``contract``.

    Columns: ``page``, the contract fields, and ``_corrupt_record`` (the raw text of
    a record that was not valid JSON; null otherwise).
    """
    from strata.operators.bronze import from_json_records

    return from_json_records(read_pages(spark, **kwargs), contract)


def page_report(pages: DataFrame, per_page: int | None = None) -> DataFrame:
    """One row checking a paged read: no page missing from 1 to the last, records per page.

    Columns: ``pages, first_page, last_page, missing_pages, short_pages, records``.
    ``short_pages`` counts pages with fewer than ``per_page`` records (the last page
    normally is one). Repeated ids across pages (page drift) are reported by
    ``strata.operators.silver.dedup_report`` on the parsed records.
    """
    per = pages.groupBy("page").agg(F.count(F.lit(1)).alias("n"))
    short = F.count_if(F.col("n") < per_page) if per_page else F.lit(None).cast("bigint")
    return per.agg(
        F.count(F.lit(1)).alias("pages"),
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        (F.max("page") - F.least(F.min("page"), F.lit(1)) + 1 - F.count(F.lit(1)))
        .cast("bigint").alias("missing_pages"),
        short.alias("short_pages"),
        F.sum("n").cast("bigint").alias("records"))
