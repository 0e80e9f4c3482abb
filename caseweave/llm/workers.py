"""What Python functions on the executors owe the other processes there."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

from caseweave.deploy import ensure_on_workers

#: Rows sent to Python at once.  Texts are long, and a batch is held several times over.
BATCH_ROWS = 2000
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def prepare(spark: SparkSession | None = None) -> None:
    """Ship the package, and lower the batch size of a session that left it at its default."""
    spark = spark or SparkSession.active()
    ensure_on_workers(spark)
    if spark.conf.get(_SETTING, _DEFAULT) == _DEFAULT:
        spark.conf.set(_SETTING, str(BATCH_ROWS))


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]):
    """Something costly to build, once per worker process.

    Only one thing is kept: a worker that moves on to another operator drops
    the last one's tables before it builds the next.
    """
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Free memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # not a C library that can


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """Gives freed memory back at the end of a task: workers stay beside the JVM when idle."""

    @wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            for thing in _kept.values():
                if hasattr(thing, "shrink"):
                    thing.shrink()
            give_back()

    return run
