"""Arrow functions over streams of batches, as column expressions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

Arrays = Iterator[pa.Array]
BATCH_ROWS = 1000
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def give_back() -> None:
    """Return freed memory to the system. A Python worker waits for its next task with all it ever used otherwise, next
    to the workers of other stages on the same executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def bound_batches(spark: SparkSession) -> None:
    """Let Spark send at most `BATCH_ROWS` texts to a Python worker at once, unless the session asks for less or more."""
    if spark.conf.get(_BATCH_CONF) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)


def arrow_stream(function: Callable[[Arrays], Arrays], returns: str) -> Callable[..., Column]:
    """An Arrow UDF from a function of batches to batches."""

    def run(batches: Arrays) -> Arrays:
        yield from function(batches)
        give_back()

    bound_batches(SparkSession.active())
    run.__annotations__ = {"batches": Arrays, "return": Arrays}
    return F.arrow_udf(run, returns)


def arrow_streams(function: Callable[[Iterator[tuple[pa.Array, ...]]], Arrays], returns: str) -> Callable[..., Column]:
    """The same for functions of several columns, which take batches of tuples."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Arrays:
        yield from function(batches)
        give_back()

    bound_batches(SparkSession.active())
    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Arrays}
    return F.arrow_udf(run, returns)
