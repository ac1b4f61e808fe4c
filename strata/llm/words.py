"""Words of whole texts by Arrow kernels, for the operators that read ``[0-9a-z]`` words.

A word is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case: digits,
letters a-z and every code point beyond ASCII. Null and empty texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower

#: What parts words, once A-Z are in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text column, as Spark's own expression."""
    parts = F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), GAP)
    return F.filter(parts, lambda w: w != "")


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows, so that a slice's texts have ``max_bytes`` bytes or are one text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(sizes):
            held = np.cumsum(sizes[at:], dtype=np.int64)
            n = max(1, int(np.searchsorted(held, max_bytes, "right")))
            yield batch.slice(at, n)
            at += n


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in order, and how many each text has."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), GAP)
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(flat), 0)  # none: a text's gap at its head or tail
    counts = np.bincount(parent.filter(real).to_numpy(zero_copy_only=False),
                         minlength=len(texts))
    return flat.filter(real), counts.astype(np.int64)
