"""Memory of Python workers, which stay for later tasks and share an executor."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

ARROW_MB = 16
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def released() -> None:
    """Give memory that a task has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of the session hold ``ARROW_MB`` MB at most, so that their memory does not depend on how long
    texts are. A smaller limit that the session has stays."""
    jvm = spark.sparkContext._jvm
    now = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ARROW_LIMIT))
    if now > ARROW_MB << 20:
        spark.conf.set(ARROW_LIMIT, f"{ARROW_MB}m")
