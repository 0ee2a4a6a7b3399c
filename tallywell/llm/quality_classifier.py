"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text gives two streams of tokens: its words with A-Z lower-cased, and their shapes (case, digits, symbols,
closing mark, length class, whether the word repeats one of the two before it). N-grams of either stream are hashed
into ``2 ** bits`` weights; a text is a sparse vector of about unit length per stream. Every shard of the training rows runs
FTRL-proximal updates over its own rows, and the shards' weights are averaged. A score is the logistic of
a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.llm.common import LOWER, U, chunks, column, mix, released, running_hash, span_hash, tidied, words

SPECIAL = np.zeros(256, np.int64)
SPECIAL[[c for c in range(33, 127) if not chr(c).isalnum()]] = 1
UPPER, DIGIT = np.zeros(256, np.int64), np.zeros(256, np.int64)
UPPER[65:91] = 1
DIGIT[48:58] = 1


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that are learnt from, ``shards`` the tasks that learn; a task has at least
    about ``shard_rows`` of them, since the weights of a task that sees few stay near zero.

    ``shrink`` makes the vectors of very short texts short, so that the share of label 1 decides on them.
    """

    bits: int = 18
    orders: tuple[int, int] = (2, 3)
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    epochs: int = 4
    shrink: float = 4.0
    sample_rows: int = 16_000
    shards: int = 8
    shard_rows: int = 2_000


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, shape hashes, first word of each text, text of each word)."""
    lower = LOWER[data]
    starts, ends, firsts = words(lower, offsets)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    word = span_hash(running_hash(lower), starts, ends)
    if not len(word):
        return word, word, firsts, text
    # White space is of no counted kind, so sums from start to start are sums of words.
    upper, digit, special = (np.add.reduceat(kind[data], starts) for kind in (UPPER, DIGIT, SPECIAL))
    size = ends - starts
    last = np.where(SPECIAL[data[ends - 1]] > 0, data[ends - 1], 0).astype(np.int64)
    again = np.zeros(len(word), np.int64)
    for back in (1, 2):
        same = np.zeros(len(word), bool)
        same[back:] = (word[back:] == word[:-back]) & (text[back:] == text[:-back])
        again[same & (again == 0)] = back
    letters = np.maximum(size - digit - special, 0)
    case = np.where(upper == 0, 0, np.where(upper * 2 > letters, np.where(letters > 1, 3, 2), 1))
    shape = (((case * 4 + np.minimum(digit, 3)) * 5 + np.minimum(special, 4)) * 256 + last) * 3 + again
    shape = shape * 4 + np.searchsorted([4, 12, 24], size)
    return word, mix(shape.astype(U) + U(1 << 40)), firsts, text


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each text."""
    word, shape, firsts, text = _tokens(data, offsets)
    seed, out_keys, out_texts = 1, [], []
    for stream, order in ((word, settings.orders[0]), (shape, settings.orders[1])):
        gram = np.zeros(len(stream), U)
        for n in range(1, order + 1):
            if len(stream) < n:
                break
            gram = mix(gram[: len(stream) - n + 1] * U(3) + stream[n - 1:] + U(n))
            whole = text[: len(gram)] == text[n - 1:]
            out_keys.append((mix(gram[whole] + U(seed * 1000 + n)) >> U(64 - settings.bits)).astype(np.int64) * 2 + seed - 1)
            out_texts.append(text[: len(gram)][whole])
        seed += 1
    keys = np.concatenate(out_keys or [np.zeros(0, np.int64)])
    owner = np.concatenate(out_texts or [np.zeros(0, np.int64)])
    packed, counts = np.unique((owner << (settings.bits + 1)) | keys, return_counts=True)
    cuts = np.searchsorted(packed >> (settings.bits + 1), np.arange(len(offsets)))
    values = np.log1p(counts)
    out = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        place, value = packed[low:high] & ((1 << (settings.bits + 1)) - 1), values[low:high].copy()
        for stream in (0, 1):
            own = (place & 1) == stream
            value[own] /= np.sqrt((value[own] ** 2).sum() + settings.shrink)
        out.append((place >> 1, value))
    return out


class Leader:
    """FTRL-proximal state over a fixed constant, the log odds of the labels."""

    def __init__(self, settings: Settings, labels: np.ndarray) -> None:
        self.s, size = settings, 1 << settings.bits
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.constant = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, place: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(place)
        error = 1 / (1 + np.exp(-np.clip(w @ value + self.constant, -35, 35))) - label
        # A place can occur twice, once for each stream.
        g = np.bincount(np.unique(place, return_inverse=True)[1], error * value)
        place, first = np.unique(place, return_index=True)
        sigma = (np.sqrt(self.n[place] + g * g) - np.sqrt(self.n[place])) / self.s.alpha
        self.z[place] += g - sigma * w[first]
        self.n[place] += g * g


def fit(examples: DataFrame, settings: Settings = Settings(), text: str = "text", label: str = "label", id: str | None = None) -> np.ndarray:
    """Weights from (text, label 0 or 1) rows, which should be a bounded sample; rows without a label are left out.

    Shards and their order follow from hashes of ``id``, text and label, so how rows are stored does not matter; rows
    that are equal in all three are interchangeable. A null or empty text is an example without n-grams. Without
    examples all weights are 0, so any score is 0.5.
    """
    schema = "shard int, w binary"

    def learn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "label", "text"], kind="stable")
        known, labels = [], rows["label"].to_numpy(float)
        batch = pa.RecordBatch.from_arrays([pa.array(rows["text"], pa.large_string())], ["text"])
        for _, data, offsets in chunks(batch):
            known += [(p.astype(np.int32), v.astype(np.float32)) for p, v in features(data, offsets, settings)]
        leader = Leader(settings, labels)
        for _ in range(settings.epochs):
            for (place, value), y in zip(known, labels, strict=True):
                leader.learn(place, value, y)
        weights = np.append(leader.weights(), leader.constant).tobytes()
        del known, leader, batch
        released()
        return pd.DataFrame({"shard": [int(key[0])], "w": [weights]})

    order = F.xxhash64(F.col(id) if id else F.lit(0), F.col(text), F.col(label))
    known = examples.where(F.col(label).isNotNull()).select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label"), order.alias("order"))
    shards = max(1, min(settings.shards, known.count() // settings.shard_rows))
    dealt = known.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "order"), F.lit(shards)).cast("int"))
    parts = sorted((p.shard, p.w) for p in dealt.groupBy("shard").applyInPandas(learn, schema).collect())
    if not parts:
        return np.zeros((1 << settings.bits) + 1)
    return np.mean([np.frombuffer(w) for _, w in parts], axis=0)


def score(df: DataFrame, weights: np.ndarray, settings: Settings = Settings(), text: str = "text",
          keep_text: bool = False, name: str = "score") -> DataFrame:
    """``df`` with the score of each row, with the text column only if ``keep_text``; null counts as empty."""
    kept = [f for f in df.schema if f.name != name and (keep_text or f.name != text)]
    schema = T.StructType([*kept, T.StructField(name, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for rows, data, offsets in chunks(batch, text):
                dots = np.array([w[place] @ value for place, value in features(data, offsets, settings)])
                scores = 1 / (1 + np.exp(-np.clip(dots + w[-1], -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [*(column(rows, f.name) for f in kept), pa.array(scores, pa.float64())],
                    [*(f.name for f in kept), name])

    return df.mapInArrow(tidied(run), schema)


def sampled(labels: DataFrame, settings: Settings, id: str = "doc_id", label: str = "quality") -> DataFrame:
    """About ``sample_rows`` labelled rows at most, chosen by hash."""
    labels = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(id, label)
    share = min(1.0, settings.sample_rows / max(1, labels.count()))
    return labels.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id), F.col(label)), F.lit(1 << 30)) < int(share * (1 << 30)))


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep_text: bool = False,
          threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with held_out, score and predicted; learnt from labelled rows that are not held out.

    Labels are matched by doc_id. Rows without an id are held out and still scored; a repeated row counts
    as often as it occurs. Other columns stay as they are, the text only with ``keep_text``; columns of the names
    held_out, score and predicted are replaced. Scores do not depend on how the tables are stored. An empty table
    gives no rows.
    """
    known = sampled(labels.where(~held_out(F.col("doc_id"))), settings)
    text = docs.select(F.col("doc_id"), F.col("text"))
    # The sample is bounded by sample_rows, so it may be broadcast at any size of the tables.
    examples = text.join(F.broadcast(known), "doc_id").select("doc_id", "text", F.col("quality").alias("label"))
    weights = fit(examples, settings, id="doc_id")
    docs = docs.drop("held_out", "score", "predicted")
    return score(docs, weights, settings, keep_text=keep_text).select(
        "*", held_out(F.col("doc_id")).alias("held_out"), (F.col("score") >= threshold).cast("int").alias("predicted"))
