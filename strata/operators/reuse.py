"""A scoped cache for an intermediate that several results read.

``cached`` is for what a few results need while one block of code runs: blocks stay on the
executors, spill to their disks and are given back at the end, come what may. ``sinks.stage`` is the other
choice, for what must outlive an executor or cut a lineage: it writes to shared storage.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
           eager: bool = False) -> Iterator[DataFrame]:
    """``df`` persisted inside the block; unpersisted at its end, errors included.

    Results built inside must be written or collected there: after the block they still work,
    but compute ``df`` anew. ``eager`` fills the cache first, in one job. A frame that someone
    else has persisted already stays persisted.
    """
    mine = df.storageLevel == StorageLevel.NONE
    held = df.persist(level) if mine else df
    try:
        if eager:
            held.count()
        yield held
    finally:
        if mine:
            held.unpersist(blocking=True)


def write_all(df: DataFrame, sinks, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> list:
    """Give one intermediate to several sinks (functions of a frame), computing it once.

    Returns what the sinks return; a failing sink ends the block, and the cache with it.
    """
    with cached(df, level) as held:
        return [sink(held) for sink in sinks]
