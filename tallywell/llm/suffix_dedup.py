"""Removal of byte strings that stand anywhere else in a corpus, by suffix arrays of content-keyed shards.

A window of ``length`` bytes has a key that depends on its bytes alone, and consecutive windows with one key are
a run. So equal windows lie in runs of one key, and a shard that gets all runs of its keys decides on them.
Runs of keys that occur once never leave their task. A shard takes each distinct stretch of bytes once, with
its count, builds the suffix array of the stretches by induced sorting and their permuted common prefixes,
and marks the windows that share ``length`` bytes with a neighbour.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywell.llm.anchors import runs, window_hashes
from tallywell.llm.common import (
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
    tidied,
    unused,
)
from tallywell.llm.suffix_array import Shard


@dataclass(frozen=True)
class Settings:
    """``width`` is the stretch that keys come from. A key of more than ``hot`` runs is split: each of its windows
    gets a key of its own. A shard is cut between keys at ``shard_bytes``."""

    length: int = 200
    width: int = 32
    hot: int = 16_000
    shard_bytes: int = 2 << 20


#: Over how many tasks the rows of a key are dealt while its heat is looked up.
SALTS = 64
PLACE = np.dtype([("row", "<i8"), ("start", "<i8"), ("no", "<i4")])
PAIR = np.dtype([("key", "<u8"), ("row", "<i8"), ("sure", "u1")])


def _dealt(pieces: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    pieces = pieces[order]
    live, cuts = cuts_of(part[order])
    return pa.RecordBatch.from_arrays(
        [pa.array(live, pa.int32()), pa.array([pieces[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
        ["part", "packed"])


def _repeated_keys(rows: DataFrame, parts: int, s: Settings) -> DataFrame:
    """(row, key) of the keys with at least two runs in the corpus."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [np.zeros(0, U)], [np.zeros(0, np.int64)]
            for part, data, offsets in chunks(batch):
                text, _, _, key = runs(data, offsets, s.length, s.width)
                keys.append(key)
                owners.append(column(part, "row").to_numpy()[text])
            found = np.empty(sum(map(len, keys)), PAIR)
            found["key"], found["row"], found["sure"] = np.concatenate(keys), np.concatenate(owners), 0
            if not len(found):
                continue
            found = found[np.argsort(found["key"], kind="stable")]
            cut = np.flatnonzero(np.diff(found["key"], prepend=~found["key"][:1]) != 0)
            many = np.diff(np.append(cut, len(found)))
            # What repeats in the batch is sure, and only one of it travels on to be counted.
            sure = found[np.repeat(many > 1, many)].copy()
            sure["sure"] = 1
            out = np.concatenate([found[cut], sure])
            spread = np.where(out["sure"] == 1, mix(out["row"].view(U) ^ out["key"]), mix(out["key"]))
            yield _dealt(out, (spread % U(parts)).astype(np.int64))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(rows["packed"]), PAIR)
        sure, open_ = found[found["sure"] == 1], found[found["sure"] == 0]
        open_ = open_[np.argsort(open_["key"], kind="stable")]
        many = np.unique(open_["key"], return_counts=True)[1]
        out = np.concatenate([sure, open_[np.repeat(many > 1, many)]])
        return pd.DataFrame({"row": out["row"].astype(np.int64), "key": out["key"].astype(U).view(np.int64)})

    return rows.mapInArrow(tidied(find), "part int, packed binary").groupBy("part").applyInPandas(count, "row long, key long")


def _marked(rows: DataFrame, keys: DataFrame, s: Settings) -> DataFrame:
    """(row, text, keys, hot): the texts that have repeated keys."""
    often = keys.groupBy("key").count().where(F.col("count") > s.hot).select(
        "key", F.lit(True).alias("hot"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keys = keys.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(often, ["key", "salt"], "left")
    marks = keys.groupBy("row").agg(
        F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hot"))
    return rows.join(marks, "row")


def _occurrences(marked: DataFrame, s: Settings, parts: int | None) -> DataFrame:
    """The runs with repeated keys: dealt to ``parts`` and packed with their bytes or, without parts, by chunk: (chunk, its
    distinct stretches, packed places of its runs). ``chunk`` is a hash of what the chunk holds."""

    def cut(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        for part, data, offsets in chunks(batch):
            text, first, count, key = runs(data, offsets, s.length, s.width)
            row = column(part, "row").to_numpy()

            def among(name: str) -> np.ndarray:
                lists = column(part, name)
                owner = np.repeat(row, np.diff(lists.offsets.to_numpy()))
                return np.isin(mix(key ^ mix(row[text].view(U))), mix(lists.flatten().to_numpy().view(U) ^ mix(owner.view(U))))

            live = among("keys")
            hot = among("hot")[live]
            text, first, count, key = text[live], first[live], count[live], key[live]
            running = running_hash(data)
            if hot.any():
                many = np.where(hot, count, 1)
                at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                hot = np.repeat(hot, many)
                text, first, count = np.repeat(text, many), np.repeat(first, many) + at, np.where(hot, 1, np.repeat(count, many))
                key = np.repeat(key, many)
                key[hot] = window_hashes(running, s.length)[first[hot]]
            same = span_hash(running, first, first + count + s.length - 1)
            yield row[text], first - offsets[text], count, key, same, data, first

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start, _, key, same, _, _ in cut(batch):
                if not len(key):
                    continue
                order = np.lexsort((same, key))
                key, same = key[order], same[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (same[1:] != same[:-1])
                at = np.flatnonzero(new)
                found = np.empty(len(key), PLACE)
                found["row"], found["start"], found["no"] = row[order], start[order], np.cumsum(new) - 1
                chunk = mix(mix(found["row"].view(U)) + found["start"].view(U) + mix(key ^ same)).sum().view(np.int64)
                stretch = pa.StructArray.from_arrays(
                    [pa.array(np.arange(len(at), dtype=np.int32)), pa.array(key[at].view(np.int64)), pa.array(same[at].view(np.int64))],
                    ["no", "key", "same"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), stretch),
                     pa.array([zlib.compress(found.tobytes(), 1)], pa.binary())], ["chunk", "stretches", "packed"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, count, key, same, data, first in cut(batch):
                if not len(key):
                    continue
                # Equal stretches of a chunk travel once, with their number.
                _, at, many = np.unique(mix(key) + same, return_index=True, return_counts=True)
                part = (mix(key[at]) % U(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                at, many, part = at[order], many[order], part[order]
                bounds = np.flatnonzero(np.diff(part, prepend=-1, append=parts + 1))
                out = []
                for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                    i = at[low:high]
                    head = np.stack([key[i].view(np.int64), same[i].view(np.int64), count[i], np.minimum(many[low:high], 2)], 1)
                    body = b"".join(data[a: a + c].tobytes() for a, c in zip(first[i], count[i] + s.length - 1, strict=True))
                    out.append(zlib.compress(len(i).to_bytes(8, "little") + head.astype("<i8").tobytes() + body, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[bounds[:-1]], pa.int32()), pa.array(out, pa.binary())], ["part", "packed"])

    if parts is None:
        return marked.mapInArrow(
            tidied(plain), "chunk long, stretches array<struct<no: int, key: long, same: long>>, packed binary")
    return marked.mapInArrow(tidied(packed), "part int, packed binary")


def repeated_windows(texts: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each text whether each of its first ``counts`` windows stands at another counted place of the shard."""
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = raw + np.uint8(1) if raw.max(initial=0) < 255 else raw.astype(np.uint16) + np.uint16(1)
    symbols[begin + sizes] = 0
    shard = Shard(symbols)
    order = shard.order()
    group = np.cumsum(shard.common(order) < length)
    at = np.repeat(begin, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    asked = np.zeros(len(symbols), bool)
    asked[at] = True
    own = asked[order]
    many = np.bincount(group[own], minlength=int(group[-1]) + 1)
    found = np.zeros(len(symbols), bool)
    found[order] = own & (many[group] > 1)
    return np.split(found[at], np.cumsum(counts)[:-1])


def _shards(packed: DataFrame, s: Settings) -> DataFrame:
    """(key, same, ranges): of each distinct stretch, from and to of the windows that repeat, flat."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        heads, bodies = [], []
        for item in rows["packed"]:
            item = zlib.decompress(item)
            n = int.from_bytes(item[:8], "little")
            head = np.frombuffer(item, "<i8", 4 * n, 8).reshape(n, 4)
            at = 8 + 32 * n
            for size in (head[:, 2] + s.length - 1).tolist():
                bodies.append(item[at: at + size])
                at += size
            heads.append(head)
        head = np.concatenate(heads)
        order = np.lexsort((head[:, 1], head[:, 0]))
        head = head[order]
        new = np.ones(len(head), bool)
        new[1:] = (head[1:, :2] != head[:-1, :2]).any(1)
        at = np.flatnonzero(new)
        many = np.add.reduceat(head[:, 3], at)
        key, same, count = head[at, 0], head[at, 1], head[at, 2]
        texts = [bodies[i] for i in order[at]]
        marks: list[np.ndarray | None] = [None] * len(at)
        variants = np.flatnonzero(np.isin(key, key[1:][key[1:] == key[:-1]]))
        low = 0
        while low < len(variants):
            high, size = low, 0
            while high < len(variants) and (size < s.shard_bytes or key[variants[high]] == key[variants[high - 1]]):
                size += len(texts[variants[high]]) + 1
                high += 1
            chosen = variants[low:high]
            for i, mark in zip(chosen, repeated_windows([texts[i] for i in chosen], count[chosen], s.length), strict=True):
                marks[i] = mark
            low = high
        out = []
        for i, mark in enumerate(marks):
            if many[i] > 1:
                out.append((key[i], same[i], [0, int(count[i])]))
            elif mark is not None and mark.any():
                out.append((key[i], same[i], np.flatnonzero(np.diff(mark.astype(np.int8), prepend=0, append=0)).tolist()))
        del heads, bodies, texts, marks
        released()
        return pd.DataFrame(out, columns=["key", "same", "ranges"])

    return packed.groupBy("part").applyInPandas(solve, "key long, same long, ranges array<int>")


def _spans(starts: list[int], ranges: list, length: int) -> list[tuple[int, int]]:
    """Merged byte spans of repeated windows."""
    flat = sorted((s + r[i], s + r[i + 1] - 1 + length) for s, r in zip(starts, ranges, strict=True) for i in range(0, len(r), 2))
    out: list[tuple[int, int]] = []
    for a, b in flat:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def merged(places: np.ndarray, no: np.ndarray, ranges: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the merged spans of repeated windows, from the places of a chunk and what is decided on its
    stretches ``no``."""
    bounds, flat = ranges.offsets.to_numpy().astype(np.int64), ranges.values.to_numpy()
    first, many = np.zeros(places["no"].max(initial=-1) + 1, np.int64), np.zeros(places["no"].max(initial=-1) + 1, np.int64)
    first[no], many[no] = bounds[:-1], np.diff(bounds) // 2
    own = many[places["no"]]
    at = np.repeat(first[places["no"]], own) + 2 * (np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own))
    row, start = np.repeat(places["row"], own), np.repeat(places["start"], own)
    low, high = start + flat[at], start + flat[at + 1] - 1 + length
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    if not len(row):
        return row, low, high
    # Each row gets a stretch of numbers of its own, so that one running maximum serves all.
    base = np.cumsum(np.append(False, row[1:] != row[:-1])) * (int(high.max()) + 1)
    reach = np.maximum.accumulate(high + base)
    cut = np.flatnonzero(np.append(True, (low + base)[1:] > reach[:-1]) | np.append(True, row[1:] != row[:-1]))
    last = np.append(cut[1:], len(row)) - 1
    return row[cut], low[cut], (reach - base)[last]


def _places(decided: DataFrame, length: int) -> DataFrame:
    """(row, places) of the rows of each chunk, from (packed, decided)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "decided")
            for i, packed in enumerate(column(batch, "packed")):
                own = lists.slice(i, 1).flatten()
                ranges = pa.concat_arrays([own.field("ranges")])
                row, low, high = merged(np.frombuffer(zlib.decompress(packed.as_py()), PLACE), own.field("no").to_numpy(), ranges, length)
                cut = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
                flat = np.stack([np.zeros_like(low), high - low - length + 1], 1).astype(np.int32).ravel()
                spans = pa.StructArray.from_arrays(
                    [pa.array(low), pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 2), pa.int32()), pa.array(flat))],
                    ["start", "ranges"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[cut]), pa.ListArray.from_arrays(pa.array(np.append(cut, len(row)), pa.int32()), spans)],
                    ["row", "places"])

    return decided.mapInArrow(tidied(run), "row long, places array<struct<start: long, ranges: array<int>>>")


def _with_row(docs: DataFrame, id: str, text: str, name: str = "_row") -> DataFrame:
    return docs.withColumn(name, F.xxhash64(F.col(id), F.col(text)))


def repeats(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, spans): (row, text) of the rows with repeated keys, and (row, places) with what repeats in them.

    ``row`` is a hash of id and text, so equal rows share it; they repeat each other. A null text is empty and has no
    windows; ids may be null or repeated; other columns are ignored. An empty table gives no rows.
    """
    s = settings
    rows = _with_row(docs, id, text).select(F.col("_row").alias("row"), F.col(text).alias("text"))
    parts = buckets(rows, 5, "text")
    keys = settled(_repeated_keys(rows, parts, s), "repeated-keys")
    marked = settled(_marked(rows, keys, s), "marked-texts", "zstd")
    decided = _shards(_occurrences(marked, s, parts), s)
    # A stretch is looked up once a chunk and not once a text, so a passage of very many texts is joined as few rows.
    found = settled(_occurrences(marked, s, None), "occurrences")
    known = found.select("chunk", F.inline("stretches")).join(decided, ["key", "same"])
    known = known.groupBy("chunk").agg(F.collect_list(F.struct("no", "ranges")).alias("decided"))
    spans = _places(found.select("chunk", "packed").join(known, "chunk").select("packed", "decided"), s.length)
    # Equal rows have equal places.
    spans = spans.groupBy("row").agg(F.first("places").alias("places"))
    return marked.select("row", "text"), settled(spans, "spans")


def _cut(texts: DataFrame, length: int, schema: T.StructType, make: Callable, text: str = "text", places: str = "places") -> DataFrame:
    """Rows of ``make(other columns, bytes, kept bytes, spans)`` from texts with their places."""
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(low, 256).to_pylist():
                    found, data = row.pop(places), (row.pop(text) or "").encode()
                    spans = _spans([p["start"] for p in found], [p["ranges"] for p in found], length)
                    kept, at = [], 0
                    for start, end in spans:
                        kept.append(data[at:start])
                        at = end
                    out.append(make(row, data, b"".join([*kept, data[at:]]), spans))
                yield pa.RecordBatch.from_pylist(out, kind)

    return texts.mapInArrow(tidied(run), schema)


def report(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    texts, spans = repeats(docs, settings, id, text)
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept", T.StringType())])
    cut = _cut(texts.join(spans, "row"), settings.length, schema, lambda row, data, kept, found: {
        "_row": row["row"], "n_removed": len(data) - len(kept), "n_spans": len(found), "kept": hashlib.sha256(kept).hexdigest()})
    whole = F.coalesce(F.col(text), F.lit(""))
    every = _with_row(docs, id, text).select(
        F.col(id).alias(id), "_row", F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("whole"))
    return every.join(cut.dropDuplicates(["_row"]), "_row", "left").select(
        id, "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"))


def deduplicate(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated bytes taken out of their texts; a broken character at a seam is dropped.

    Other columns stay as they are, whatever their names. A null text stays null, and an empty table empty.
    """
    _, spans = repeats(docs, settings, id, text)
    row, places = unused(docs, "_row", "_places")
    marked = _with_row(docs, id, text, row).join(
        spans.select(F.col("row").alias(row), F.col("places").alias(places)), row, "left").select(*docs.columns, places)
    cut = _cut(marked.where(F.col(places).isNotNull()), settings.length, docs.schema, lambda row, data, kept, found: {
        **row, text: kept.decode("utf-8", "ignore")}, text, places)
    return marked.where(F.col(places).isNull()).select(*docs.columns).unionByName(cut)
