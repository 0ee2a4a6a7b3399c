"""A filter of fixed size that keeps most texts out of a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import column

SLICE_BITS = 17


def _place(keys: Column, bits: int, hashed: bool = False) -> Column:
    return F.shiftrightunsigned(keys if hashed else F.xxhash64(keys), 64 - bits)


def bit_filter(keys: DataFrame, name: str, bits: int = 24, hashed: bool = False) -> np.ndarray:
    """``2 ** bits`` bits, set where a hash of a key falls, or the key itself if it is ``hashed`` already; 2 MB by
    default, whatever the number of keys.

    Slices of it are made in tasks, so at most that many bytes reach the driver.
    """
    low = 1 << min(SLICE_BITS, bits)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(low, np.uint8)
        out[rows["place"].to_numpy() % low] = 1
        return pd.DataFrame({"slice": [int(rows["slice"].iloc[0])], "bits": [np.packbits(out, bitorder="little").tobytes()]})

    places = keys.where(F.col(name).isNotNull()).select(_place(F.col(name), bits, hashed).alias("place")).distinct()
    found = places.withColumn("slice", (F.col("place") / low).cast("int")).groupBy("slice").applyInPandas(gather, "slice int, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in found.collect():
        out[r.slice * low // 8: (r.slice + 1) * low // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def passes(df: DataFrame, name: str, bits: np.ndarray) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and few others while it is sparse."""
    shared = df.sparkSession.sparkContext.broadcast(bits)
    width = len(bits).bit_length() + 2
    marked = df.withColumn("_place", _place(F.col(name), width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            place = column(batch, "_place").to_numpy()
            own = pa.array((held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1)
            yield batch.select([f for f in batch.schema.names if f != "_place"]).filter(own)

    return marked.mapInArrow(run, df.schema)
