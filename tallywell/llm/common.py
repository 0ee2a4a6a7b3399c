"""What several operators share: tables, scratch tables, and words and hashes of Arrow text batches."""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions.memory import ARROW_LIMIT, ARROW_MB, bounded_batches, released  # noqa: F401
from tallywell.sources.scratch import settled  # noqa: F401

CHUNK_BYTES = 2 << 20
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def buckets(df: DataFrame, mb: float = 8.0, text: str | None = None) -> int:
    """How many parts of about ``mb`` MB ``df`` has: of the bytes of its column ``text``, which are counted, or of the
    files of a table just written (``settled``). There is no most."""
    if text is None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    else:
        size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, math.ceil(size / (mb * 1e6)))


def cuts_of(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts that occur, bounds of their rows) of sorted part numbers; the cost does not grow with the number of parts."""
    first = np.flatnonzero(np.diff(part, prepend=-1) != 0)
    return part[first], np.append(first, len(part))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many more underscores as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


BYTE_VALUES = stream(257, 77)
BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, at least ``n`` of them."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 16), base, U)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        _powers[base] = found
    return found


def running_hash(data: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] = the polynomial of bytes i to j; scale it by BASE_INVERSE^i to compare places."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data))[: len(data)], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, equal for equal bytes."""
    h = (running[end] - running[start]) * powers(BASE_INVERSE, len(running))[start]
    return mix(h + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column without copying; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets from 0) of runs of rows with about ``most`` bytes of text; a row is never cut."""
    if not batch.num_rows:
        return
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield (batch.slice(low, high - low), data[offsets[low]: offsets[high]],
               offsets[low: high + 1] - offsets[low])
        low = high


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and the total) of the runs of bytes that are no white space."""
    inside = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def tidy() -> None:
    """Give memory that a task has freed, and its tables of powers, back to the machine: Python workers stay for later stages."""
    _powers.clear()
    gc.collect()
    released()


def tidied(run: Callable) -> Callable:
    """``run``, a function for mapInArrow, giving its memory back when its task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        tidy()

    return whole


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
