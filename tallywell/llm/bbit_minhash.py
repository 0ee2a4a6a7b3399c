"""Near duplicates by b-bit MinHash.

A document is its set of distinct word shingles; equal sets are one class. Of each of ``hashes`` minima only the
low ``bits`` bits are kept, packed into 64-bit words. The whole minima are used once, to name ``hashes / rows`` bands;
classes that share a band are candidates. From the bits in which two packed signatures differ, the share of equal
minima is counted, corrected for the bits that agree by chance, and a candidate whose estimate is more than ``slack``
standard deviations below the threshold goes. What is left is verified on whole sets.

A group of near copies must not give all its pairs. So a class is first verified against the class of each
of its bands that most others share bands with, and linked classes become components. Bands that still hold
several components are then compared in blocks, as arrays inside a task. A block gives out only a few
spanning forests of its candidates, at most one edge per class each, and the rounds go on without the failed edges
until no candidate joins two components. So every candidate pair is either verified, failed, or inside a component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import U, chunks, column, mix, settled, stream
from tallywell.llm.components import components
from tallywell.llm.ngram_jaccard import set_class, shingle_sets
from tallywell.llm.texts import bit_filter, passes

SLICE = 64


@dataclass(frozen=True)
class Settings:
    """Linked from ``percent`` / 100. With 32 bands of 6 rows, a pair at 0.85 shares none with probability 3e-7, and
    at 6 deviations its estimate is too low with probability 1e-6. Sets of unlike size share fewer bits by chance,
    so the correction assumes sets that are small against all shingles. ``profile_bits`` bounds a class's parity
    profile; ``block`` the classes that are compared at once; ``forests`` the edges that a class gives out at once, so
    that failed ones do not cost a round each; ``run`` the pairs of one verification task."""

    size: int = 5
    percent: int = 85
    hashes: int = 192
    rows: int = 6
    bits: int = 2
    slack: float = 6.0
    profile_bits: int = 1 << 14
    block: int = 4096
    forests: int = 6
    run: int = 256

    @property
    def least_equal(self) -> int:
        """The fewest equal minima, by their bits, that a linked pair is expected to show."""
        chance = 0.5 ** self.bits
        p = chance + (1 - chance) * self.percent / 100
        return math.floor(self.hashes * p - self.slack * math.sqrt(self.hashes * p * (1 - p)))


def minima(flat: np.ndarray, starts: np.ndarray, s: Settings) -> np.ndarray:
    """(sets, hashes): the minimum of each hash function over each set; no set is empty."""
    factors, shifts = stream(s.hashes, 7) | U(1), stream(s.hashes, 8)
    out = np.empty((len(starts), s.hashes), U)
    for i in range(s.hashes):
        out[:, i] = np.minimum.reduceat(flat * factors[i] + shifts[i], starts)
    return mix(out)


def bands(found: np.ndarray, s: Settings) -> np.ndarray:
    """(sets, bands): a 64-bit name of each run of minima."""
    count = s.hashes // s.rows
    parts = found[:, : count * s.rows].reshape(len(found), count, s.rows)
    return mix((mix(parts + stream(s.rows, 9)) * (stream(s.rows, 10) | U(1))).sum(2) + stream(count, 11))


def signatures(found: np.ndarray, s: Settings) -> np.ndarray:
    """(sets, words): the low bits of each minimum, packed."""
    each = 64 // s.bits
    low = (found & U((1 << s.bits) - 1)).reshape(len(found), -1, each)
    return np.bitwise_or.reduce(low << (np.arange(each, dtype=U) * U(s.bits)), axis=2)


def equal_minima(a: np.ndarray, b: np.ndarray, s: Settings) -> np.ndarray:
    """How many minima have the same bits, for signatures in the last axis."""
    apart = a ^ b
    for i in range(1, s.bits):
        apart = apart | ((a ^ b) >> U(i))
    ones = U(sum(1 << i for i in range(0, 64, s.bits)))
    return s.hashes - np.bitwise_count(apart & ones).sum(-1, dtype=np.int64)


def similarity(equal: np.ndarray, s: Settings) -> np.ndarray:
    """The estimate of the Jaccard similarity, corrected for bits that agree by chance."""
    chance = 0.5 ** s.bits
    return (equal / s.hashes - chance) / (1 - chance)


def parity(grams: np.ndarray, s: Settings) -> np.ndarray:
    """Packed bits, about four for each shingle, which turns one of them; two sets differ in as many shingles at least
    as their bits do. Halves of a profile XORed are the profile of half the size."""
    size = min(s.profile_bits, 1 << max(6, (4 * len(grams) - 1).bit_length()))
    bits = np.bincount((mix(grams) & U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")


def _signed(rows: DataFrame, s: Settings) -> DataFrame:
    """(id, row, n, class, signature, bands) of each row; a set of no shingle has neither signature nor bands."""
    names = ["id", "row", "n", "class", "signature", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch):
                sets = shingle_sets(data, offsets, s.size)
                sizes = np.array([len(g) for g in sets], np.int64)
                live = np.flatnonzero(sizes)
                marks: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if len(live):
                    starts = np.concatenate([[0], np.cumsum(sizes[live])[:-1]])
                    found = minima(np.concatenate([sets[i] for i in live]), starts, s)
                    packed, named = signatures(found, s).view(np.int64), bands(found, s).view(np.int64)
                    for k, i in enumerate(live.tolist()):
                        marks[i], keys[i] = packed[k], named[k]
                yield pa.RecordBatch.from_arrays(
                    [column(part, "id"), column(part, "row"), pa.array(sizes, pa.int64()), pa.array([set_class(g) for g in sets], pa.int64()),
                     pa.array(marks, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))], names)

    return rows.mapInArrow(run, "id long, row long, n long, class long, signature array<long>, bands array<long>")


def _equal_bits(a: str, b: str, s: Settings) -> Column:
    """``equal_minima`` of two array columns."""
    ones = sum(1 << i for i in range(0, 64, s.bits))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones

    def apart(x: Column, y: Column) -> Column:
        out = x.bitwiseXOR(y)
        for i in range(1, s.bits):
            out = out.bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), i))
        return F.bit_count(out.bitwiseAND(F.lit(ones)))

    return F.lit(s.hashes) - F.aggregate(F.zip_with(a, b, apart), F.lit(0), lambda acc, x: acc + x)


def _star_pairs(shared: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """(hub, class): each class with the class of each band that shares bands with most others."""
    pull = shared.groupBy("class").agg(F.sum("k").alias("pull"))
    members = shared.join(pull, "class")
    hubs = members.groupBy("band").agg(F.max_by(F.struct(F.col("class").alias("hub"), F.col("n").alias("hub_n")), F.struct("pull", "class")).alias("h"))
    long, short = F.greatest("n", "hub_n"), F.least("n", "hub_n")
    pairs = shared.join(hubs.select("band", "h.*"), "band").where(
        (F.col("class") != F.col("hub")) & (100 * short >= s.percent * long)).select("hub", "class").distinct()
    left = classes.select(F.col("class").alias("hub"), F.col("signature").alias("_a"))
    return pairs.join(left, "hub").join(classes.select("class", F.col("signature").alias("_b")), "class").where(
        _equal_bits("_a", "_b", s) >= s.least_equal).select("hub", "class")


def _profiles(texts: DataFrame, s: Settings) -> DataFrame:
    """(class, profile)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch):
                found = [parity(g, s).tobytes() for g in shingle_sets(data, offsets, s.size)]
                yield pa.RecordBatch.from_arrays([column(part, "class"), pa.array(found, pa.binary())], ["class", "profile"])

    return texts.select("class", "text").mapInArrow(run, "class long, profile binary")


def fold(profiles: np.ndarray, words: int) -> np.ndarray:
    """(rows, more words) to (rows, words)."""
    while profiles.shape[1] > words:
        half = profiles.shape[1] // 2
        profiles = profiles[:, :half] ^ profiles[:, half:]
    return profiles


class Forest:
    """Components of the rows of one block; ``join`` tells whether two were apart."""

    def __init__(self, roots: np.ndarray) -> None:
        self.names, self.of = np.unique(roots, return_inverse=True)
        self.up = np.arange(len(self.names))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def join(self, a: int, b: int) -> bool:
        x, y = self.top(int(self.of[a])), self.top(int(self.of[b]))
        self.up[max(x, y)] = min(x, y)
        return x != y

    def now(self) -> np.ndarray:
        for _ in range(len(self.up)):
            up = self.up[self.up]
            if (up == self.up).all():
                break
            self.up = up
        return self.up[self.of]


def _edges(rows: pd.DataFrame, s: Settings) -> list[tuple[int, int]]:
    """Spanning forests of the candidates among the classes of one band and two blocks of it."""
    name, n = rows["class"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    side = rows["own"].to_numpy()
    left, right = np.flatnonzero(side == rows["low"].iloc[0]), np.flatnonzero(side == rows["high"].iloc[0])
    marks = np.stack([np.asarray(x, np.int64) for x in rows["signature"]]).view(U)
    profiles = [np.frombuffer(x, "<u8") for x in rows["profile"]]
    words = np.array([len(p) for p in profiles])
    failed = {(int(c), int(f)) for c, found in zip(name, rows["failed"], strict=True) if found is not None for f in found}
    # What one forest has joined goes to the next, so the last one is the least joined.
    forests = [Forest(rows["root"].to_numpy(np.int64)) for _ in range(s.forests)]
    out: list[tuple[int, int]] = []
    for at in range(0, len(left), SLICE):
        part, root = left[at: at + SLICE], forests[-1].now()
        able = (root[part][:, None] != root[right][None, :]) & (
            100 * np.minimum(n[part][:, None], n[right][None, :]) >= s.percent * np.maximum(n[part][:, None], n[right][None, :]))
        x, y = np.nonzero(able)
        i, j = part[x], right[y]
        near = equal_minima(marks[i], marks[j], s) >= s.least_equal
        i, j = i[near], j[near]
        for size in np.unique(np.minimum(words[i], words[j])):
            own = np.minimum(words[i], words[j]) == size
            a, b = i[own], j[own]
            short = {k: fold(profiles[k][None, :], size)[0] for k in np.unique(np.append(a, b)).tolist()}
            for low in range(0, len(a), 4096):
                p, q = a[low: low + 4096], b[low: low + 4096]
                apart = np.bitwise_count(np.stack([short[k] for k in p.tolist()]) ^ np.stack([short[k] for k in q.tolist()])).sum(1, dtype=np.int64)
                close = apart * (100 + s.percent) <= (n[p] + n[q]) * (100 - s.percent)
                for u, v in zip(p[close].tolist(), q[close].tolist(), strict=True):
                    pair = (int(min(name[u], name[v])), int(max(name[u], name[v])))
                    if pair not in failed and any(f.join(u, v) for f in forests):
                        out.append(pair)
    return out


def _forest_edges(members: DataFrame, failed: DataFrame, s: Settings) -> DataFrame:
    """(hub, class) of candidates that join two components."""
    sizes = members.groupBy("band").agg(F.count("*").alias("k"))
    blocks = F.ceil(F.col("k") / s.block).cast("int")
    about = sizes.agg(F.sum(F.col("k") * blocks)).first()[0] or 0
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    dealt = members.drop("k").join(sizes, "band").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    # Few: what the profiles let pass and whole sets did not.
    failed = failed.groupBy(F.least("hub", "class").alias("class")).agg(F.collect_list(F.greatest("hub", "class")).alias("failed"))
    dealt = dealt.join(failed, "class", "left")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    part = F.pmod(F.xxhash64("band", low, high), F.lit(max(1, about // s.block))).cast("int")
    dealt = dealt.select(part.alias("part"), "band", low.alias("low"), high.alias("high"), "own", "class", "n", "root", "signature", "profile", "failed")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found: set[tuple[int, int]] = set()
        for _, block in rows.groupby(["band", "low", "high"], sort=False):
            found.update(_edges(block.drop_duplicates("class"), s))
        return pd.DataFrame(sorted(found), columns=["hub", "class"], dtype=np.int64)

    return dealt.groupBy("part").applyInPandas(compare, "hub long, class long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(hub, class, linked) of each pair, by whole sets. Pairs of a hub are dealt in runs, each with the hub's text."""
    count = pairs.count()
    runs = pairs.groupBy("hub").agg(F.ceil(F.count("*") / s.run).alias("runs"))
    dealt = pairs.join(runs, "hub").withColumn("run", F.pmod(F.xxhash64("class"), F.col("runs")))
    part = F.pmod(F.xxhash64("hub", "run"), F.lit(max(1, math.ceil(count / s.run)))).cast("int").alias("part")
    members = dealt.select(part, "hub", "class", F.lit(False).alias("is_hub"))
    hubs = dealt.select("hub", "run").distinct().select(part, "hub", F.col("hub").alias("class"), F.lit(True).alias("is_hub"))
    rows = members.union(hubs).distinct().join(texts, "class")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows.drop_duplicates("class")
        batch = pa.RecordBatch.from_arrays([pa.array(own["text"], pa.large_string())], ["text"])
        sets: list[np.ndarray] = []
        for _, data, offsets in chunks(batch):
            sets += shingle_sets(data, offsets, s.size)
        known = dict(zip(own["class"], sets, strict=True))
        found = []
        for hub, name in rows.loc[~rows["is_hub"], ["hub", "class"]].itertuples(index=False):
            a, b = known[hub], known[name]
            both = len(np.intersect1d(a, b, assume_unique=True))
            found.append((hub, name, 100 * both >= s.percent * (len(a) + len(b) - both)))
        return pd.DataFrame(found, columns=["hub", "class", "linked"])

    return settled(rows.groupBy("part").applyInPandas(compare, "hub long, class long, linked boolean"), "verified")


def groups(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, n, class, root) of each row: its set's size, its class and the root class of its component.

    ``row`` is a hash of id and text. A null or blank text has class 0, size 0 and no links. Ids may be null or
    repeated, as links are between texts. Other columns are ignored; an empty table gives no rows.
    """
    s = settings
    rows = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.col(id), F.col(text)).alias("row"), F.col(text).alias("text"))
    signed = settled(_signed(rows, s), "signed")
    classes = settled(signed.where("class <> 0").groupBy("class").agg(
        *(F.first(c).alias(c) for c in ("n", "signature", "bands")), F.min("row").alias("row")), "classes")
    named = classes.select("class", "n", F.explode("bands").alias("band"))
    often = named.groupBy("band").agg(F.count("*").alias("k")).where("k > 1")
    shared = settled(named.join(often, "band"), "shared-bands")
    asked = settled(classes.join(shared.select("class").distinct(), "class").drop("bands"), "asked")
    texts = passes(rows.select("row", "text"), "row", bit_filter(asked, "row"))
    texts = settled(texts.join(asked.select("row", "class"), "row").select("class", "text").dropDuplicates(["class"]), "texts")
    profiles = settled(_profiles(texts, s), "profiles")

    checked = _verified(settled(_star_pairs(shared, asked, s), "stars"), texts, s)
    roots = settled(components(checked.where("linked"), "hub", "class"), "roots")
    failed = checked.where("NOT linked").select("hub", "class")
    while True:
        members = shared.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
        several = members.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band")
        members = settled(members.join(several, "band").join(asked.select("class", "signature"), "class").join(profiles, "class"), "members")
        edges = settled(_forest_edges(members, failed, s), "edges")
        checked = _verified(edges, texts, s)
        if checked.isEmpty():
            break
        failed = settled(failed.union(checked.where("NOT linked").select("hub", "class")), "failed")
        # Links of roots are few; what they join takes the new root.
        old = roots.withColumnsRenamed({"node": "_n", "root": "_r"})
        ends = checked.where("linked")
        for end in ("hub", "class"):
            ends = ends.join(old.select(F.col("_n").alias(end), F.col("_r").alias(f"_{end}")), end, "left").withColumn(
                f"_{end}", F.coalesce(f"_{end}", end))
        joined = settled(ends.select(F.col("_hub").alias("a"), F.col("_class").alias("b"), "hub", "class"), "joined")
        tops = components(joined.select("a", "b")).withColumnsRenamed({"node": "_r", "root": "_top"})
        every = roots.select("node", F.col("root").alias("_r")).union(joined.select("hub", "a")).union(joined.select("class", "b")).distinct()
        roots = settled(every.join(tops, "_r", "left").select("node", F.coalesce("_top", "_r").alias("root")), "roots")
    return signed.select("id", "row", "n", "class").join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class"))


def link(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row. A component is named by its smallest non-null id, whose rows are
    kept; a row without words is kept under its own id. A row without an id is never kept beside one with an id;
    a component without any id has no name and keeps its rows."""
    rows = settled(groups(docs, settings, id, text), "groups")
    names = rows.where("class <> 0").groupBy("root").agg(F.min("id").alias("name"))
    component = F.when(F.col("class") == 0, F.col("id")).otherwise(F.col("name"))
    return rows.join(names, "root", "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
