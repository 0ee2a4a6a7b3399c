"""A filter of fixed size for the terms of a list of any length."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 MB of bits, made in slices of 16 KB.
BITS, SLICE = 1 << 24, 1 << 17


def term_filter(terms: DataFrame, name: str) -> Broadcast:
    """Bits of the checksums of all terms: no term is missed, and while the filter is sparse few others pass."""
    place = F.pmod(F.crc32(F.col(name)), F.lit(BITS))
    places = terms.where(F.col(name).isNotNull()).select(place.alias("place")).distinct()
    slices = places.groupBy(F.floor(F.col("place") / SLICE).alias("slice")).agg(
        F.collect_list(F.pmod("place", F.lit(SLICE)).cast("int")).alias("inside"))
    bits = np.zeros(BITS, bool)
    # At most SLICE numbers a row and BITS in all.
    for row in slices.toLocalIterator():
        bits[int(row["slice"]) * SLICE + np.asarray(row["inside"], np.int64)] = True
    return terms.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))


def likely(shared: Broadcast):
    """A column function from words to array<struct<term, times>> of those that may be terms."""
    @F.arrow_udf("array<struct<term: string, times: bigint>>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = shared.value
        for batch in batches:
            offsets, terms, times = [0], [], []
            for words in batch.to_pylist():
                for word, n in Counter(words or ()).items():
                    place = zlib.crc32(word.encode()) % BITS
                    if bits[place >> 3] >> (place & 7) & 1:
                        terms.append(word)
                        times.append(n)
                offsets.append(len(terms))
            fields = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(times, pa.int64())], ["term", "times"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)

    return count
