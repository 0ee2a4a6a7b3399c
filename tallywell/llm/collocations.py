"""Phrase collocations by vertical partitioning of a truncated word-suffix tree.

Words and pairs of words are counted first: they are the prefixes of depth one and two. Prefixes that occur too
rarely for any reported phrase are cut off, and the rest are dealt to groups that each fit a memory budget; a prefix above
the budget is extended by a word, and again if need be. Every group sorts its own suffixes, cut to the longest phrase,
which lays out their subtree; the count of a node is the sum of the leaves below it. Groups do not depend on
each other, and nodes above the depth of dealing are added up over groups.

Words travel as 64-bit hashes and get their texts back at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import (
    LOWER,
    U,
    bounded_batches,
    chunks,
    column,
    mix,
    released,
    running_hash,
    settled,
    span_hash,
    tidied,
)
from tallywell.llm.texts import bit_filter
from tallywell.operators.ranked import top_per_group

GAP = np.zeros(256, bool)
GAP[[9, 32]] = True
END = np.zeros(256, bool)
END[[*range(10, 14), *b".,;:!?"]] = True
PLACE_BITS = 16
#: Bytes of text whose words are hashed at once; their arrays take about 50 times as much.
CHUNK = 512 << 10


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to ``longest`` words with at least ``least`` occurrences; a phrase goes if a longer one that holds it
    has ``percent`` / 100 of its count. A group is dealt about ``budget`` suffixes, and a task remembers ``held``
    distinct entries before it passes them on."""

    longest: int = 5
    least: int = 100
    percent: int = 100
    first: int = 2000
    budget: int = 500_000
    held: int = 400_000


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, piece of each word, text of each word)."""
    inside = ~(GAP | END)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    cut = END[data] | edge[:-1]
    return starts, ends, np.cumsum(cut)[starts], np.searchsorted(offsets, starts, "right") - 1


class Counts:
    """Sums of counts by key rows, with what has been seen so far made distinct now and then."""

    def __init__(self, held: int) -> None:
        self.held, self.size = held, 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def full(self) -> bool:
        if self.size > 2 * self.held:
            self.merge()
        return self.size > self.held

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = summed(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.size = [keys], [counts], len(keys)
        return keys, counts

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merge()
        self.keys, self.counts, self.size = [], [], 0
        return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``keys`` in order, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.lexsort(keys.T[::-1])
    keys, counts = keys[order], counts[order]
    cut = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
    return keys[cut], np.add.reduceat(counts, cut)


def lang_key(names: pa.Array) -> np.ndarray:
    """A 64-bit number for each name."""
    data, offsets = np.frombuffer("".join(names.to_pylist()).encode(), np.uint8), [0]
    for name in names.to_pylist():
        offsets.append(offsets[-1] + len(name.encode()))
    at = np.array(offsets)
    return span_hash(running_hash(data), at[:-1], at[1:])


def word_hashes(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(language number, hash, piece, start, end) of each word; a hash is of the language and the word."""
    low = LOWER[data]
    starts, ends, piece, text = tokens(low, offsets)
    names = column(part, "lang").dictionary_encode()
    own = lang_key(names.dictionary)[names.indices.to_numpy()][text]
    return own, mix(span_hash(running_hash(low), starts, ends) + own), piece, starts, ends


def pair_hashes(word: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word with the next one, whether the next one is in its piece)."""
    whole = np.zeros(len(word), bool)
    whole[:-1] = piece[1:] == piece[:-1]
    pair = np.zeros(len(word), U)
    pair[:-1] = mix(word[:-1] * U(3) + word[1:])
    return pair, whole


def _in(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a hash may be in the filter."""
    place = (hashes >> U(64 - 24)).astype(np.int64)
    return (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _words(rows: DataFrame, s: Settings) -> DataFrame:
    """(lang, word, n): how often each word occurs in each language, and the number of all words under word NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, totals, names = Counts(s.held), {}, {}

        def given() -> pa.RecordBatch:
            keys, counts = found.take()
            langs, at = np.unique(keys[:, 0], return_inverse=True)
            own = pa.array([names[k] for k in langs.tolist()], pa.string()).take(pa.array(at))
            return pa.RecordBatch.from_arrays([own, pa.array(keys[:, 1].view(np.int64)), pa.array(counts)], ["lang", "word", "n"])

        for batch in batches:
            for part, data, offsets in chunks(batch, most=CHUNK):
                own, word, _, _, _ = word_hashes(part, data, offsets)
                every = pc.unique(column(part, "lang"))
                names.update(zip(lang_key(every).tolist(), every.to_pylist(), strict=True))
                for key, count in zip(*np.unique(own, return_counts=True), strict=True):
                    totals[int(key)] = totals.get(int(key), 0) + int(count)
                distinct, first, counts = np.unique(word, return_index=True, return_counts=True)
                found.add(np.stack([own[first], distinct], 1), counts)
                if found.full():
                    yield given()
        if found.size:
            yield given()
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[k] for k in totals], pa.string()), pa.nulls(len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())],
            ["lang", "word", "n"])

    return rows.mapInArrow(tidied(run), "lang string, word long, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _pairs(rows: DataFrame, words: np.ndarray, s: Settings) -> DataFrame:
    """(pair, n): occurrences of two words in a row, both frequent."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counts(s.held)

        def given() -> pa.RecordBatch:
            keys, counts = found.take()
            return pa.RecordBatch.from_arrays([pa.array(keys[:, 0].view(np.int64)), pa.array(counts)], ["pair", "n"])

        for batch in batches:
            for part, data, offsets in chunks(batch, most=CHUNK):
                _, word, piece, _, _ = word_hashes(part, data, offsets)
                pair, whole = pair_hashes(word, piece)
                often = _in(shared.value, word)
                whole[:-1] &= often[:-1] & often[1:]
                distinct, counts = np.unique(pair[whole], return_counts=True)
                found.add(distinct[:, None], counts)
                if found.full():
                    yield given()
        if found.size:
            yield given()

    return rows.mapInArrow(tidied(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _places(counts: DataFrame, name: str) -> np.ndarray:
    """Occurrences by the first bits of the hash; always ``2 ** PLACE_BITS`` numbers."""
    out = np.zeros(1 << PLACE_BITS, np.int64)
    for r in counts.groupBy(F.shiftrightunsigned(name, 64 - PLACE_BITS).alias("place")).agg(F.sum("n").alias("n")).collect():
        out[r.place] = r.n
    return out


def vertical(first: np.ndarray, second: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(first group of each place of prefixes, how many groups it has, depth a pair's place is dealt at, all groups).

    Neighbouring places share a group while they fit the budget together; a place above it gets as many
    groups as it fills, and its prefixes are extended by a word, or by two where a pair alone is above it.
    """
    asked = np.maximum(1, -(-first // budget))
    start, group, room = np.zeros(len(first), np.int64), 0, budget
    for place, n in enumerate(first.tolist()):
        if asked[place] > 1:
            group += room < budget
            start[place], room = group, budget
            group += int(asked[place])
        else:
            if n > room:
                group, room = group + 1, budget
            start[place] = group
            room -= n
    return start, asked, np.where(second > budget, 3, 2), group + 1


def suffix_type(s: Settings) -> np.dtype:
    return np.dtype([("words", "<u8", (s.longest,)), ("n", "<i8"), ("depth", "<i4")])


def _suffixes(rows: DataFrame, pairs: np.ndarray, plan: tuple[np.ndarray, np.ndarray, np.ndarray, int], s: Settings) -> DataFrame:
    """(part, packed): distinct suffixes of frequent pairs with their counts, cut to ``longest`` words, 0 behind the end.

    A task packs those of one part into one row, each time it has gathered enough.
    """
    entry = suffix_type(s)
    shared = rows.sparkSession.sparkContext.broadcast((pairs, plan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (start, asked, depths, _) = shared.value
        found = Counts(s.held // 4)

        def given() -> pa.RecordBatch:
            keys, counts = found.take()
            place = (keys[:, 0] >> U(64 - PLACE_BITS)).astype(np.int64)
            pair = mix(keys[:, 0] * U(3) + keys[:, 1])
            more = asked[place] > 1
            depth = np.where(more, depths[(pair >> U(64 - PLACE_BITS)).astype(np.int64)], 1)
            deal = np.where(depth == 3, mix(pair + keys[:, min(2, s.longest - 1)]), pair)
            part = start[place] + np.where(more, (deal % asked[place].astype(U)).astype(np.int64), 0)
            order = np.argsort(part, kind="stable")
            out = np.empty(len(keys), entry)
            out["words"], out["n"], out["depth"] = keys, counts, depth
            out, part = out[order], part[order]
            cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
            return pa.RecordBatch.from_arrays(
                [pa.array(part[cut[:-1]], pa.int32()), pa.array([out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                ["part", "packed"])

        for batch in batches:
            for part, data, offsets in chunks(batch, most=CHUNK):
                _, word, piece, _, _ = word_hashes(part, data, offsets)
                pair, whole = pair_hashes(word, piece)
                whole &= _in(held, pair)
                at = np.flatnonzero(whole)
                keys = np.zeros((len(at), s.longest), U)
                keys[:, 0] = word[at]
                going = np.ones(len(at), bool)
                for i in range(1, s.longest):
                    going &= whole[np.minimum(at + i - 1, len(word) - 1)]
                    keys[going, i] = word[at[going] + i]
                found.add(*summed(keys, np.ones(len(at), np.int64)))
                if found.full():
                    yield given()
        if found.size:
            yield given()

    return rows.mapInArrow(tidied(run), "part int, packed binary")


def nodes(keys: np.ndarray, depth: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[list[int], int]]:
    """(words, occurrences) of the nodes of depth two or more of a subtree, from its leaves in order.

    A node below the depth of dealing has all its leaves here and goes if it is too rare.
    """
    out = []
    for d in range(2, keys.shape[1] + 1):
        long = np.flatnonzero(keys[:, d - 1] != 0)
        if not len(long):
            break
        own = keys[long, :d]
        cut = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(1)))
        total = np.add.reduceat(counts[long], cut)
        kept = (total >= least) | (depth[long][cut] > d)
        out += list(zip(own[cut[kept]].view(np.int64).tolist(), total[kept].tolist(), strict=True))
    return out


def _phrases(suffixes: DataFrame, s: Settings) -> DataFrame:
    """(phrase, n): sequences of word hashes with at least ``least`` occurrences, of two words or more."""
    entry = suffix_type(s)

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        leaves = np.frombuffer(b"".join(rows["packed"]), entry)
        leaves = leaves[np.lexsort(leaves["words"].T[::-1])]
        found = nodes(leaves["words"], leaves["depth"], leaves["n"], s.least)
        # A group may hold nothing but rare phrases: without rows, pandas takes a list for numbers, which no array can be made of.
        out = pd.DataFrame({"phrase": pd.Series([k for k, _ in found], dtype=object), "n": [n for _, n in found]}).astype({"n": np.int64})
        del leaves, found
        released()
        return out

    # The language is part of each word's hash.
    found = suffixes.groupBy("part").applyInPandas(tree, "phrase array<long>, n long")
    return found.groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= s.least)


def _spelled(rows: DataFrame, words: np.ndarray) -> DataFrame:
    """(word, lang, text) of the words that may be in the filter."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, U)
        for batch in batches:
            for part, data, offsets in chunks(batch, most=CHUNK):
                own, word, _, starts, ends = word_hashes(part, data, offsets)
                fresh, first = np.unique(word, return_index=True)
                new = _in(shared.value, fresh)
                new[new] = ~np.isin(fresh[new], known, assume_unique=True)
                first, low = first[new], LOWER[data].tobytes()
                text = np.searchsorted(offsets, starts[first], "right") - 1
                known = np.concatenate([known, fresh[new]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fresh[new].view(np.int64)), column(part, "lang").take(pa.array(text)),
                     pa.array([low[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], pa.string())],
                    ["word", "lang", "text"])

    return rows.mapInArrow(tidied(run), "word long, lang string, text string").groupBy("word").agg(
        F.first("lang").alias("lang"), F.first("text").alias("text"))


def _merged(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """The join by order. Both sides grow with the phrases, and Spark takes the rows of an exploded table for as few
    bytes as its file has, so that without a hint it sends millions of them to the driver and to all tasks."""
    return left.hint("merge").join(right, on, how)


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(18,0)")


def _scored(phrases: DataFrame, words: DataFrame, totals: DataFrame, s: Settings) -> DataFrame:
    """(phrase, lang, a, l, r, n, score) with the lowest-scoring cut; the first words of a phrase give its language."""
    parts = settled(phrases.union(words.select(F.array("word"), "n")), "counts")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
    cuts = cuts.select("phrase", F.col("n").alias("a"), "k", F.slice("phrase", F.lit(1), F.col("k")).alias("_l"),
                       F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")).alias("_r"))
    cuts = _merged(cuts, parts.select(F.col("phrase").alias("_l"), F.col("n").alias("l")), "_l")
    cuts = _merged(cuts, parts.select(F.col("phrase").alias("_r"), F.col("n").alias("r")), "_r")
    cuts = cuts.withColumn("word", F.col("phrase")[0]).join(words.select("word", "lang"), "word").join(totals, "lang")
    scaled = cuts.select("*", (F.lit(1000).cast("decimal(4,0)") * (_exact("a") * _exact("total")).cast("decimal(34,0)")).cast("decimal(38,0)").alias("_up"),
                         (_exact("l") * _exact("r")).alias("_down"))
    scored = scaled.withColumn("score", F.expr("_up div _down"))
    best = scored.groupBy("phrase", "lang", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("_c"))
    return best.select("phrase", "lang", "a", "_c.l", "_c.r", "n", "_c.score")


def _held(phrases: DataFrame, s: Settings) -> DataFrame:
    """The phrases that some longer phrase holds with enough of their count."""
    size = F.size("phrase")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("phrase", i, m))))
    longer = phrases.where(size > 2).select(F.col("n").alias("longer"), F.explode(F.array_distinct(inner)).alias("phrase"))
    most = longer.groupBy("phrase").agg(F.max("longer").alias("longer"))
    return _merged(phrases, most, "phrase").where(100 * F.col("longer") >= s.percent * F.col("n")).select("phrase")


def mine(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each language by score, count and text.

    A null text is empty and a null language is 'und'. Words end at blanks and tabs; nothing crosses an end mark or a
    line. Repeated rows count as often as they occur, other columns are ignored, and an empty table gives no rows.
    Equal scores and counts are ranked by the bytes of the phrase.
    """
    s, rows = settings, _rows(docs, text, lang)
    bounded_batches(docs.sparkSession)
    counted = settled(_words(rows, s), "words")
    often = counted.where(F.col("word").isNotNull() & (F.col("n") >= s.least))
    totals = counted.where("word IS NULL").select("lang", F.col("n").alias("total"))
    held = bit_filter(often, "word", hashed=True)
    pairs = settled(_pairs(rows, held, s).where(F.col("n") >= s.least), "pairs")
    # A word begins at most as many suffixes as it occurs.
    plan = vertical(_places(often, "word"), _places(pairs, "pair"), s.budget)
    suffixes = _suffixes(rows, bit_filter(pairs, "pair", hashed=True), plan, s)
    phrases = settled(_phrases(suffixes, s), "phrases")
    best = _merged(_scored(phrases, often, totals, s), _held(phrases, s), "phrase", "left_anti")
    best = settled(best, "scored")
    used = best.select(F.explode("phrase").alias("word")).distinct()
    spelled = _spelled(rows, bit_filter(used, "word", hashed=True)).select("word", "text")
    letters = _merged(best.select("phrase", F.posexplode("phrase").alias("i", "word")), spelled, "word")
    named = letters.groupBy("phrase").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]), " ").alias("name"))
    table = _merged(best, named, "phrase").select("lang", F.col("name").alias("phrase"), "a", "l", "r", "n", "score")
    return top_per_group(settled(table, "collocations"), ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], s.first).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
