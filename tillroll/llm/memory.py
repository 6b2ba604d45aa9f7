"""What a worker holds: batches of few rows, and memory given back at the end of a task."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 1_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS = "10000"


def bound_batches(spark: SparkSession) -> None:
    """Send ``BATCH_ROWS`` rows to a worker at a time where the session leaves Spark's number.

    A batch is held whole on both sides, and ten thousand texts or pairs of sets are too much.
    """
    if spark.conf.get(_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of ``mapInArrow``, which gives memory back when its task ends.

    Workers are reused; what one task freed would otherwise stay with its process through the next stages.
    """

    @functools.wraps(run)
    def tidy(batches: Iterator) -> Iterator:
        yield from run(batches)
        _give_back()

    return tidy
