"""Centroid clustering on bit planes.

A vector of 64 whole numbers is held as one 64-bit word per binary digit: bit j of word p is digit p of component j, in
two's complement. The dot product of two vectors is then a weighted sum of AND-popcounts over pairs of planes, and
a squared distance is made of three of them; both are exact. Every round sends the few centroids to the tasks and
takes back one sum per task and cluster, which are added by a grouping.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import U, column, settled

COMPONENTS = 64
#: Components are held within this, so that every squared distance fits into 64 bits.
LARGEST = 1 << 27
CLUSTERS_SCHEMA = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Settings:
    """``clusters`` bounds what goes to the driver and to tasks: that many times 64 numbers."""

    clusters: int = 16
    rounds: int = 3
    scale: int = 64
    seed: int = 1
    rows_at_once: int = 4096


def weights(planes: int) -> np.ndarray:
    """What each plane counts; the last one holds the sign."""
    out = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    out[-1] = -out[-1]
    return out


def to_planes(numbers: np.ndarray, planes: int) -> np.ndarray:
    """(n, 64) whole numbers to (n, planes) words."""
    digits = (numbers[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(digits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The dot product of every row of ``a`` with every row of ``b``, both as planes."""
    out = np.zeros((len(a), len(b)), np.int64)
    for p, x in enumerate(weights(a.shape[1])):
        for q, y in enumerate(weights(b.shape[1])):
            out += np.bitwise_count(a[:, p, None] & b[None, :, q]).astype(np.int64) * (x * y)
    return out


def norms(a: np.ndarray) -> np.ndarray:
    """The dot product of every row with itself."""
    out = np.zeros(len(a), np.int64)
    for p, x in enumerate(weights(a.shape[1])):
        for q, y in enumerate(weights(a.shape[1])):
            out += np.bitwise_count(a[:, p] & a[:, q]).astype(np.int64) * (x * y)
    return out


def sums(a: np.ndarray) -> np.ndarray:
    """The sum of each component over the rows, from the planes."""
    bits = np.unpackbits(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.shape[1], 8), axis=2, bitorder="little")
    return weights(a.shape[1]) @ bits.sum(0, dtype=np.int64)


def vectors(df: DataFrame, settings: Settings = Settings(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, numbers) of the vectors with 64 components, none of them null or non-finite."""
    v, top = F.col(vector), float(LARGEST - 1)
    sound = (F.size(v) == COMPONENTS) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * settings.scale, F.lit(top)), F.lit(-top))).cast("long"))
    return df.where(F.coalesce(sound, F.lit(False))).select(F.col(id).alias("id"), whole.alias("numbers"))


def _planes_of(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    packed = column(batch, "packed")
    joined = b"".join(packed.to_pylist())
    return np.frombuffer(joined, "<u8").reshape(len(packed), planes)


def _pack(found: DataFrame, planes: int, s: Settings) -> DataFrame:
    kind = found.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, s.rows_at_once):
                part = batch.slice(low, s.rows_at_once)
                numbers = column(part, "numbers").flatten().to_numpy().reshape(-1, COMPONENTS)
                words = to_planes(numbers, planes)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "id"), pa.array([w.tobytes() for w in words], pa.binary())], ["id", "packed"])

    return found.mapInArrow(run, f"id {kind}, packed binary")


def _nearest(packed: DataFrame, centroids: list[list[int]], planes: int, s: Settings, total: bool) -> DataFrame:
    """(id, cluster, distance) of each vector, or with ``total`` (cluster, n, sums) of each task."""
    centres = to_planes(np.array(centroids, np.int64), planes)
    own = norms(centres)
    kind = packed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, added = np.zeros(len(centres), np.int64), np.zeros((len(centres), COMPONENTS), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, s.rows_at_once):
                part = batch.slice(low, s.rows_at_once)
                rows = _planes_of(part, planes)
                far = norms(rows)[:, None] - 2 * dots(rows, centres) + own[None, :]
                cluster = far.argmin(1)
                if total:
                    for c in np.unique(cluster):
                        count[c] += (cluster == c).sum()
                        added[c] += sums(rows[cluster == c])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [column(part, "id"), pa.array(cluster, pa.int32()), pa.array(far[np.arange(len(far)), cluster], pa.int64())],
                        ["id", "cluster", "distance"])
        live = np.flatnonzero(count)
        if total and len(live):
            yield pa.RecordBatch.from_arrays(
                [pa.array(live, pa.int32()), pa.array(count[live], pa.int64()), pa.array(list(added[live]), pa.list_(pa.int64()))],
                ["cluster", "n", "sums"])

    return packed.mapInArrow(run, "cluster int, n long, sums array<long>" if total else f"id {kind}, cluster int, distance long")


def _moved(packed: DataFrame, centroids: list[list[int]], planes: int, s: Settings) -> list[list[int]]:
    """The centroids after one round; at most clusters x 64 sums reach the driver."""
    parts = _nearest(packed, centroids, planes, s, total=True)
    added = parts.select("cluster", "n", F.posexplode("sums").alias("j", "x")).groupBy("cluster", "j").agg(
        F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    out = [list(c) for c in centroids]
    for r in added:
        out[r.cluster][r.j] = r.x // r.n
    return out


def cluster(df: DataFrame, settings: Settings = Settings(), id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    Vectors that are null, of another length, or hold a null or non-finite component take no part, and other columns
    are ignored. A repeated row is as many vectors. A vector without an id is put into a cluster but starts none;
    vectors with one id start in the order of their components. With fewer vectors than clusters each starts one.
    Without any start, as for an empty table, the result is empty. A component is held within +-2^27 after
    scaling. An inertia that does not fit into 64 bits is NULL.
    """
    s = settings
    found = vectors(df, s, id, vector)
    largest = found.agg(F.max(F.greatest(F.array_max("numbers"), -F.array_min("numbers")))).first()[0]
    planes = int(largest or 0).bit_length() + 1
    packed = settled(_pack(found, planes, s), "planes")
    order = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("id").cast("string")), 256)
    starts = packed.where(F.col("id").isNotNull()).select(order.alias("hash"), "packed").orderBy("hash", "packed").limit(s.clusters).collect()
    centroids = [_numbers(r.packed, planes) for r in starts]
    spark, kind = df.sparkSession, packed.schema["id"].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame([], f"`{id}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(s.rounds):
        centroids = _moved(packed, centroids, planes, s)
    placed = settled(_nearest(packed, centroids, planes, s, total=False), "placed")
    inertia = {r.cluster: int(r.x) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    whole = lambda x: x if x < 1 << 63 else None
    table = [(c, whole(inertia[c]), whole(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c in sorted(inertia)]
    # At most ``clusters`` rows.
    return placed.join(F.broadcast(spark.createDataFrame(table, CLUSTERS_SCHEMA)), "cluster").select(
        F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _numbers(packed: bytes, planes: int) -> list[int]:
    words = np.frombuffer(packed, "<u8").astype(U)[None, :]
    return sums(words).tolist()
