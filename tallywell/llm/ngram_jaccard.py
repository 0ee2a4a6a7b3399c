"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word shingles. Equal sets are one class, so copies cost one row each.
Shingles are ordered from rare to frequent by a hashed frequency sketch. Two sets with enough in common share
at least l shingles among the first ``n - ceil(t * n) + l`` of each, for any l up to the overlap. Each class
picks the l with the least estimated cost, from the frequencies of its own prefix, and as many shared
prefix shingles are asked for before a pair is verified on its texts.

Groups of near copies would give all their pairs. So a first round compares each class only with the most
typical class that shares one of its min-hashes and merges what is verified. The prefix join then
pairs components, so a prefix shingle that lies in one component gives no pair at all. For a frequent shingle,
parity bits of both sets bound how far they are apart before a pair becomes a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.llm.common import (
    LOWER,
    U,
    buckets,
    chunks,
    column,
    cuts_of,
    mix,
    released,
    running_hash,
    settled,
    span_hash,
    stream,
    tidied,
    unused,
    words,
)
from tallywell.llm.components import components
from tallywell.sources.scratch import scratch_path


SLICES = 1024


@dataclass(frozen=True)
class Settings:
    """Shingles of ``size`` words; linked from ``percent`` / 100; l up to ``most``; a verification costs as much as
    ``verify`` prefix entries (``most`` is 4 at most: a layer is two bits); the sketch has ``2 ** sketch_bits`` counts, which bounds what is broadcast. A token of at most ``few`` classes is
    joined with itself; the classes of another are compared in blocks of about ``block``."""

    size: int = 5
    percent: int = 80
    most: int = 4
    verify: int = 20
    min_hashes: int = 8
    few: int = 16
    block: int = 2048
    sketch_bits: int = 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: none without words, one if there are fewer than ``size``."""
    lower = LOWER[data]
    starts, ends, firsts = words(lower, offsets)
    word = span_hash(running_hash(lower), starts, ends)
    factors = stream(size, 5)
    grams = np.zeros(max(0, len(word) - size + 1), U)
    for j in range(size):
        grams += mix(word[j: j + len(grams)] + factors[j]) * (factors[j] | U(1))
    grams = mix(grams)
    out = []
    for low, high in zip(firsts[:-1], firsts[1:], strict=True):
        if high - low >= size:
            out.append(np.unique(grams[low: high - size + 1]))
        elif high > low:
            own = word[low:high]
            out.append(mix(np.array([(mix(own + factors[: len(own)]) * (factors[: len(own)] | U(1))).sum()], U) + U(len(own))))
        else:
            out.append(np.zeros(0, U))
    return out


def set_class(grams: np.ndarray) -> int:
    """A 64-bit name of a set, 0 for none."""
    if not len(grams):
        return 0
    return int(mix(np.array([mix(grams).sum() + U(len(grams))], U)).view(np.int64)[0]) or 1


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """A word for about every 64 shingles, each of which turns one bit; two sets differ in at least as many shingles
    as their bits do."""
    size = 1 << min(9, max(6, (2 * len(grams) - 1).bit_length()))
    bits = np.bincount((mix(grams) % U(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def needed(n: int, percent: int) -> int:
    """The least overlap that a set of ``n`` can have with a linked one."""
    return -(-n * percent // 100)


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.col(id), F.col(text)).alias("row"),
                       F.col(text).alias("text"))


def _classes(rows: DataFrame, s: Settings) -> DataFrame:
    """(id, row, n, class) of each row, and in rows of their own (slice, counts) the sketch."""
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("class", T.LongType()), T.StructField("slice", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << s.sketch_bits, np.int32)
        for batch in batches:
            for part, data, offsets in chunks(batch):
                sets = shingle_sets(data, offsets, s.size)
                if sum(map(len, sets)):
                    counts += np.bincount((np.concatenate(sets) >> U(64 - s.sketch_bits)).astype(np.int64),
                                          minlength=len(counts)).astype(np.int32)
                names = pa.array([set_class(g) for g in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "id"), column(part, "row"), pa.array([len(g) for g in sets], pa.int64()),
                     names, pa.nulls(len(sets), kinds[4]), pa.nulls(len(sets), kinds[5])], schema.names)
        if counts.any():
            slices = counts.reshape(min(SLICES, len(counts)), -1)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(slices), k) for k in kinds[:4]), pa.array(np.arange(len(slices)), kinds[4]),
                 pa.array([x.tobytes() for x in slices], kinds[5])], schema.names)

    return rows.mapInArrow(tidied(run), schema)


def _sketch(classes: DataFrame, s: Settings) -> np.ndarray:
    """The sums of the tasks' counts, slice by slice."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in rows["counts"])
        return pd.DataFrame({"slice": rows["slice"][:1], "counts": [np.minimum(total, np.iinfo(np.int32).max).astype(np.int32).tobytes()]})

    summed = classes.where("counts IS NOT NULL").select("slice", "counts").groupBy("slice").applyInPandas(add, "slice int, counts binary")
    found = sorted((r.slice, r.counts) for r in summed.collect())
    return np.frombuffer(b"".join(c for _, c in found), np.int32) if found else np.zeros(1 << s.sketch_bits, np.int32)


def _prefixes(rows: DataFrame, sketch: np.ndarray, s: Settings) -> DataFrame:
    """One row per class: (class, n, tokens of its longest prefix from rare to frequent, min-hashes, typical, bits).

    The two low bits of a token are its layer less 1, the smallest l whose prefix has it.
    """
    schema = "class long, n long, tokens array<long>, mins array<long>, typical double, bits array<long>"
    shared = rows.sparkSession.sparkContext.broadcast(sketch)
    seeds = stream(s.min_hashes, 99)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for batch in batches:
            for _, data, offsets in chunks(batch):
                sets = [g for g in shingle_sets(data, offsets, s.size) if len(g)]
                tokens, mins, typical, bits = [], [], [], []
                for grams in sets:
                    often = count[(grams >> U(64 - s.sketch_bits)).astype(np.int64)]
                    length = min(len(grams), len(grams) - needed(len(grams), s.percent) + s.most)
                    chosen = grams[np.lexsort((grams, often))[:length]] & ~U(3)
                    first = len(grams) - needed(len(grams), s.percent) + 1
                    chosen[first:] |= np.arange(1, len(chosen) - first + 1).astype(U)
                    tokens.append(chosen.view(np.int64))
                    bits.append(parity_bits(grams))
                    mins.append(np.array([mix(grams ^ seed).min() for seed in seeds], U).view(np.int64))
                    typical.append(float(np.log(often + 1.0).mean()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_class(g) for g in sets], pa.int64()), pa.array([len(g) for g in sets], pa.int64()),
                     pa.array(tokens, pa.list_(pa.int64())), pa.array(mins, pa.list_(pa.int64())),
                     pa.array(typical, pa.float64()), pa.array(bits, pa.list_(pa.int64()))],
                    ["class", "n", "tokens", "mins", "typical", "bits"])

    found = rows.select("text").mapInArrow(tidied(run), schema)
    return found.groupBy("class").agg(*(F.first(c).alias(c) for c in ("n", "tokens", "mins", "typical", "bits")))


def _shared_tokens(prefixes: DataFrame, parts: int) -> DataFrame:
    """(token, class, layer, df): prefix entries whose token at least two classes have.

    Entries travel packed, dealt by token; a part holds a bounded share of all entries.
    """
    entry = np.dtype([("token", "<u8"), ("class", "<i8")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = column(batch, "tokens")
            flat = tokens.flatten().to_numpy().view(U)
            out = np.empty(len(flat), entry)
            out["token"] = flat
            out["class"] = np.repeat(column(batch, "class").to_numpy(), np.diff(tokens.offsets.to_numpy()))
            part = (mix(flat | U(3)) % U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            live, cuts = cuts_of(part[order])
            out = out[order]
            yield pa.RecordBatch.from_arrays(
                [pa.array(live, pa.int32()), pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                ["part", "packed"])

    def repeated(rows: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(rows["packed"]), entry)
        found = found[np.argsort(found["token"], kind="stable")]
        token = found["token"] >> U(2)
        cut = np.flatnonzero(np.diff(token, prepend=~token[:1]) != 0)
        df = np.diff(np.append(cut, len(found)))
        found, df = found[np.repeat(df > 1, df)], np.repeat(df, df)[np.repeat(df > 1, df)]
        return pd.DataFrame({
            "token": (found["token"] >> U(2)).astype(np.int64), "class": found["class"],
            "layer": (found["token"] & U(3)).astype(np.int32) + 1, "df": df.astype(np.int32)})

    packed = prefixes.select("class", "tokens").mapInArrow(tidied(pack), "part int, packed binary")
    return packed.groupBy("part").applyInPandas(repeated, "token long, class long, layer int, df int")


def _star_pairs(prefixes: DataFrame, s: Settings) -> DataFrame:
    """(hub, class): each class with the most typical class of each of its min-hashes."""
    keys = prefixes.select("class", "n", "typical", F.posexplode("mins").alias("i", "m"))
    hubs = keys.groupBy("i", "m").agg(
        F.max_by(F.struct(F.col("class").alias("hub"), F.col("n").alias("hub_n")), F.struct("typical", "class")).alias("h"),
        F.count("*").alias("k")).where("k > 1").select("i", "m", "h.hub", "h.hub_n")
    long, short = F.greatest("n", "hub_n"), F.least("n", "hub_n")
    return keys.join(hubs, ["i", "m"]).where((F.col("class") != F.col("hub")) & (100 * short >= s.percent * long)).select(
        "hub", "class").distinct()


def _prefix_pairs(tokens: DataFrame, prefixes: DataFrame, roots: DataFrame, s: Settings) -> DataFrame:
    """(hub, class): pairs of classes of different components that share enough of their adaptive prefixes."""
    # Of the classes that can match l times, at most scan / l are candidates.
    costs = [(F.sum(F.when(F.col("layer") <= level, F.col("df")).otherwise(0)) * (1 + s.verify / level)).alias(f"c{level}")
             for level in range(1, s.most + 1)]
    least = F.least(*(F.col(f"c{level}") for level in range(1, s.most + 1)))
    best = F.coalesce(*(F.when((F.col(f"c{level}") == least) & (F.col("n") * s.percent > (level - 1) * 100), level)
                        for level in range(s.most, 0, -1)), F.lit(1))
    classes = tokens.groupBy("class").agg(*costs).join(prefixes.select("class", "n"), "class").join(
        roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", F.col("n").cast("int").alias("n"), F.coalesce("root", "class").alias("root"), best.alias("level"))
    tokens = tokens.join(settled(classes, "levels"), "class")
    mixed = tokens.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    tokens = settled(tokens.join(mixed, "token"), "mixed-tokens")
    own = ("class", "n", "layer", "level", "root")
    probe = F.struct("a_n", "a_class") > F.struct("b_n", "b_class")
    level = F.when(probe, F.col("a_level")).otherwise(F.col("b_level"))
    able = ((F.col("a_root") < F.col("b_root")) & (F.col("a_layer") <= level) & (F.col("b_layer") <= level)
            & (100 * F.least("a_n", "b_n") >= s.percent * F.greatest("a_n", "b_n")))

    def side(rows: DataFrame, name: str, *more: str) -> DataFrame:
        return rows.select("token", *(F.col(c).alias(f"{name}_{c}") for c in (*own, *more)))

    few = tokens.where(F.col("df") <= s.few)
    pairs = side(few, "a").join(side(few, "b"), "token").where(able)
    pairs = pairs.select(
        F.when(probe, F.col("a_class")).otherwise(F.col("b_class")).alias("hub"),
        F.when(probe, F.col("b_class")).otherwise(F.col("a_class")).alias("class"), level.alias("level"))
    pairs = pairs.union(_frequent_pairs(tokens.where(F.col("df") > s.few), prefixes, s))
    return pairs.groupBy("hub", "class", "level").count().where("count >= level").select("hub", "class")


def _frequent_pairs(tokens: DataFrame, prefixes: DataFrame, s: Settings) -> DataFrame:
    """(hub, class, level) for tokens of many classes: only pairs that the parity bits of both sets allow.

    Classes of a token are dealt to blocks, and each two blocks are compared as arrays, so neither a group nor a
    pair that cannot be linked becomes rows.
    """
    blocks = F.ceil(F.col("df") / s.block).cast("int")
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    dealt = tokens.join(prefixes.select("class", "bits"), "class").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    parts = buckets(prefixes, 1)
    dealt = dealt.select(F.pmod(F.xxhash64("token", low, high), F.lit(parts)).cast("int").alias("part"), "token",
                         low.alias("low"), high.alias("high"), "own", "class", "n", "layer", "level", "root", "bits")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["token", "low", "high"], kind="stable").reset_index(drop=True)
        key = rows[["token", "low", "high"]].to_numpy()
        cuts = np.append(np.flatnonzero((np.diff(key, axis=0, prepend=key[:1] - 1) != 0).any(1)), len(rows))
        name, n, layer, level, root, side = (rows[c].to_numpy(np.int64) for c in ("class", "n", "layer", "level", "root", "own"))
        size = np.array([len(b) for b in rows["bits"]])
        bits = np.zeros((len(rows), 8), U)
        for i, b in enumerate(rows["bits"]):
            bits[i, : len(b)] = np.asarray(b, np.int64).view(U)
        out = []
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            every = np.arange(first, last)
            left = every[side[every] == key[first, 1]]
            right = every[side[every] == key[first, 2]]
            for at in range(0, len(left), 64):
                a, b = left[at: at + 64][:, None], right[None, :]
                probe = (n[a] > n[b]) | ((n[a] == n[b]) & (name[a] > name[b]))
                asked = np.where(probe, level[a], level[b])
                able = (root[a] != root[b]) & (layer[a] <= asked) & (layer[b] <= asked) & (
                    100 * np.minimum(n[a], n[b]) >= s.percent * np.maximum(n[a], n[b]))
                if key[first, 1] == key[first, 2]:
                    able &= a < b
                x, y = np.nonzero(able)
                i, j = left[at: at + 64][x], right[y]
                apart = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
                near = (size[i] != size[j]) | (apart * (100 + s.percent) <= (n[i] + n[j]) * (100 - s.percent))
                i, j = i[near], j[near]
                up = probe[x[near], y[near]]
                out.append(np.stack([np.where(up, name[i], name[j]), np.where(up, name[j], name[i]), np.where(up, level[i], level[j])], 1))
        found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        released()
        return pd.DataFrame({"hub": found[:, 0], "class": found[:, 1], "level": found[:, 2].astype(np.int32)})

    return dealt.groupBy("part").applyInPandas(compare, "hub long, class long, level int")


def _verified(pairs: DataFrame, texts: DataFrame, s: Settings, at_once: int = 256) -> DataFrame:
    """The pairs (hub, class) whose sets are similar enough, from their texts.

    Pairs of a hub are dealt in runs of about ``at_once``, each with the hub's text, so a hub with very many
    members is spread.
    """
    pairs = settled(pairs, "pairs")
    n = pairs.count()
    parts = max(1, math.ceil(n / at_once))
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / at_once).alias("runs"))
    dealt = pairs.join(sizes, "hub").withColumn("run", F.pmod(F.xxhash64("class"), F.col("runs")))
    part = F.pmod(F.xxhash64("hub", "run"), F.lit(parts)).cast("int").alias("part")
    members = dealt.select(part, "hub", "class", F.lit(False).alias("is_hub"))
    hubs = dealt.select("hub", "run").distinct().select(part, "hub", F.col("hub").alias("class"), F.lit(True).alias("is_hub"))
    rows = members.union(hubs).join(texts, "class")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["hub", "class", "is_hub"])
        batch = pa.RecordBatch.from_arrays(
            [pa.array(rows["text"].drop_duplicates(), pa.large_string())], ["text"])
        sets: list[np.ndarray] = []
        for _, data, offsets in chunks(batch):
            sets += shingle_sets(data, offsets, s.size)
        known = dict(zip(rows["text"].drop_duplicates(), sets, strict=True))
        hub = {h: known[t] for h, t in rows.loc[rows["is_hub"], ["hub", "text"]].itertuples(index=False)}
        found = []
        for h, c, t in rows.loc[~rows["is_hub"], ["hub", "class", "text"]].itertuples(index=False):
            a, b = hub[h], known[t]
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= s.percent * (len(a) + len(b) - both):
                found.append((h, c))
        del batch, sets, known, hub
        released()
        return pd.DataFrame(found, columns=["hub", "class"], dtype=np.int64)

    return settled(rows.groupBy("part").applyInPandas(compare, "hub long, class long"), "verified")


def _by_class(texts: DataFrame, parts: int) -> tuple[DataFrame, str]:
    """(texts, name): one text of each class, as a table in buckets of the class, so that later joins do not move texts.

    The table is known to the catalog by ``name`` until the caller drops it; its files stay in the scratch folder.
    """
    spark = texts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts)
    path = scratch_path(spark, "texts")
    name = "texts_" + path.rsplit("-", 1)[1]
    texts.repartition(parts, "class").dropDuplicates(["class"]).write.bucketBy(parts, "class").option("path", path).saveAsTable(name)
    return spark.table(name), name


def groups(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, row, n, class, root) of each row: its set's size, its class, and the root class of its component.

    ``row`` is a hash of id and text. A null or blank text has class 0, size 0 and no links. Ids may be null or
    repeated: links are between texts. Other columns are ignored; an empty table gives no rows.
    """
    s, rows = settings, _rows(docs, id, text)
    marked = settled(_classes(rows, s), "classes")
    classes = marked.where("counts IS NULL").drop("counts")
    prefixes = settled(_prefixes(rows, _sketch(marked, s), s), "prefixes")
    tokens = settled(_shared_tokens(prefixes, buckets(prefixes, 4)), "tokens")
    stars = settled(_star_pairs(prefixes, s), "stars")
    asked = tokens.select("class").union(stars.select("class")).union(stars.select("hub")).distinct()
    first = classes.where("class <> 0").groupBy("class").agg(F.min("row").alias("row"))
    texts, name = _by_class(
        rows.select("row", "text").join(first.join(asked, "class"), "row").select("class", "text"), buckets(docs, 54, text))
    try:
        links = _verified(stars, texts, s)
        roots = settled(components(links, "hub", "class"), "roots")
        more = _verified(_prefix_pairs(tokens, prefixes, roots, s), texts, s)
    finally:
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    roots = components(links.union(more), "hub", "class").withColumnRenamed("node", "class")
    return classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))


def link(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row; the component is named by its smallest non-null id."""
    rows = settled(groups(docs, settings, id, text), "groups")
    names = rows.where("class <> 0").groupBy("root").agg(F.min("id").alias("name"))
    return rows.join(names, "root", "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"),
        F.when(F.col("class") == 0, F.col("id")).otherwise(F.col("name")).alias("component_id"))


def deduplicate(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that with the smallest id; rows without words all stay.

    Other columns stay as they are, whatever their names. Rows that are equal in id and text are one; an empty table
    stays empty.
    """
    rows = settled(groups(docs, settings, id, text), "groups")
    (key,) = unused(docs, "_row")
    stay = rows.where("class <> 0").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("x")).select(F.col("x.row").alias(key))
    marked = docs.withColumn(key, F.xxhash64(F.col(id), F.col(text)))
    blank = marked.where(F.coalesce(F.trim(F.translate(F.col(text), "\t\n\x0b\x0c\r", "     ")), F.lit("")) == "")
    kept = marked.join(stay, key).dropDuplicates([key])
    return kept.unionByName(blank).select(*docs.columns)
