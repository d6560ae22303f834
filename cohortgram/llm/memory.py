"""What a Python worker keeps from one task to the next, and when it lets go of it.

Spark runs the tasks of many operators in the same workers. Each memo is cleared when a task of another operator starts, so a
worker holds those of one operator, and memory freed by then goes back to the system.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows of an Arrow batch between the JVM and Python, where whole texts travel: at 10,000, Spark's own number, both sides hold tens of MB
#: a task, and the JVM keeps what it has once taken.
BATCH_ROWS = "500"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_clear: list[Callable[[], None]] = []
_working: list[str] = [""]


def kept(clear: Callable[[], None]) -> None:
    """Registers how to empty a memo."""
    _clear.append(clear)


def begin(operator: str) -> None:
    """To be called where a task of an operator starts in a worker."""
    if _working[0] != operator:
        _working[0] = operator
        for clear in _clear:
            clear()
    release()


def release() -> None:
    """Gives freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Lowers the rows of an Arrow batch for the session, unless they are set lower."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= int(BATCH_ROWS):
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
