"""Connected components of a link table, as alternating stars on Spark.

Each round links every larger neighbour of a node, then the node and its smaller
neighbours, to the smallest of them, until nothing changes (a number of rounds that
grows with the logarithm of the longest path). Minima are partial aggregates; they are
written before they are joined back, so that adaptive execution can split the join at a
node with very many links. Nothing of the graph reaches the driver but two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch


def _star(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(u, v, m): the links with the smallest of each u's neighbours and u itself."""
    low = scratch.stage(links.groupBy("u").agg(F.min("v").alias("m"))
                        .select("u", F.least("u", "m").alias("m")), "low")
    return links.join(low, "u")


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) but the roots; root: its smallest node."""
    now = scratch.stage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                                      F.least("u", "v").alias("v"))
                        .distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(mark)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = scratch.stage(_star(scratch, both).filter("v > u and v <> m")
                              .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                              "large")
        kept = _star(scratch, large)
        small = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            kept.select("u", F.col("m").alias("v")))
        new = scratch.stage(small.filter("u <> v").distinct(), "links")
        scratch.drop(now)
        scratch.drop(large)
        now = new
