"""A Bloom filter of fixed size, to leave rows out of a shuffle that cannot match its keys.

Spark builds and merges its words; only the finished filter, whose size is a parameter, goes through
the driver. A false hit costs a row in the shuffle after it and changes no result.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BYTES = 4 << 20


def broadcast_filter(keys: DataFrame, hash_column: str, n_bytes: int = FILTER_BYTES) -> Broadcast:
    """The filter of a column of well-spread 64-bit hashes. ``n_bytes`` is a power of two."""
    mask = n_bytes * 8 - 1
    places = F.expr(
        f"array({hash_column} & {mask}L, shiftrightunsigned({hash_column}, 29) & {mask}L)"
    )
    merged = (
        keys.select(F.explode(places).alias("bit"))
        .groupBy(F.expr("bit div 64").alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("word"))
    ).toPandas()
    words = np.zeros(n_bytes // 8, dtype=np.int64)
    words[merged["at"].to_numpy(dtype=np.int64)] = merged["word"].to_numpy(dtype=np.int64)
    return keys.sparkSession.sparkContext.broadcast(words)


def possible(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of the keys; all keys are."""
    values, mask = hashes.view(np.uint64), np.uint64(len(words) * 64 - 1)
    found = np.ones(len(values), dtype=bool)
    for place in (values & mask, (values >> np.uint64(29)) & mask):
        word = words[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
        found &= ((word >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found
