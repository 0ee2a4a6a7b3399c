"""Language-model scores by prediction by partial matching, with counts from the whole training part of a corpus.

Documents are dealt to buckets. A bucket sends its distinct codes (a byte with its context) and words, with
their training counts, to parts by key. A part adds the counts of all buckets up, works out the code lengths of its
contexts, and sends each bucket what it asked for. So a task holds the part of the model that its own
documents need, and no model is broadcast, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import (
    LOWER,
    U,
    buckets,
    chunks,
    cuts_of,
    mix,
    running_hash,
    settled,
    span_hash,
    words,
)
from tallywell.llm.ppm_model import MASK, ORDER, WIDTH, codes, log_probabilities

CODE = np.dtype([("key", "<i8"), ("count", "<i8")])
VALUE = np.dtype([("key", "<i8"), ("value", "<f8")])
SENT = "kind string, part int, bucket int, packed binary, pairs array<struct<pair:long,n:long>>"
END_KEY = -1


@dataclass(frozen=True)
class Settings:
    """``smoothing`` is of the word model; ``bucket_mb`` is text a bucket."""

    smoothing: float = 0.1
    bucket_mb: float = 10.0


def _batch(texts: pd.Series) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, cuts): the words of each text and its end, as hashes."""
    lower = LOWER[data]
    starts, ends, firsts = words(lower, offsets)
    key = (span_hash(running_hash(lower), starts, ends) >> U(1)).astype(np.int64)
    return np.insert(key, firsts[1:], END_KEY), firsts + np.arange(len(firsts))


def _counted(keys: list[np.ndarray], learnt: list[np.ndarray]) -> np.ndarray:
    """Distinct keys with the number of times they are learnt from."""
    key, flag = np.concatenate(keys), np.concatenate(learnt)
    unique, inverse = np.unique(key, return_inverse=True)
    out = np.empty(len(unique), CODE)
    out["key"], out["count"] = unique, np.bincount(inverse, flag, len(unique))
    return out


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    found = np.concatenate(parts)
    unique, inverse = np.unique(found["key"], return_inverse=True)
    out = np.empty(len(unique), CODE)
    out["key"], out["count"] = unique, np.bincount(inverse, found["count"], len(unique))
    return out


def _dealt(kind: str, bucket: int, found: np.ndarray, part: np.ndarray) -> list[tuple]:
    order = np.argsort(part, kind="stable")
    found = found[order]
    live, cuts = cuts_of(part[order])
    return [(kind, p, bucket, found[a:b].tobytes(), None) for p, a, b in zip(live.tolist(), cuts[:-1], cuts[1:], strict=True)]


def _ask(parts: int):
    def ask(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        grams, terms = [], []
        low = 0
        learn = rows["learn"].to_numpy(bool)
        for part, data, offsets in chunks(_batch(rows["text"])):
            flags = learn[low: low + part.num_rows]
            low += part.num_rows
            code, cuts = codes(data, offsets)
            grams.append(_counted([code], [np.repeat(flags, np.diff(cuts))]))
            term, cuts = _words(data, offsets)
            terms.append(_counted([term], [np.repeat(flags, np.diff(cuts))]))
        grams, terms, bucket = _merged(grams), _merged(terms), int(key[0])
        near = grams["key"] >> ((ORDER - 1) * WIDTH)
        pair = ((grams["key"] >> (ORDER * WIDTH)) << WIDTH) | (grams["key"] & MASK)
        unique, inverse = np.unique(pair, return_inverse=True)
        sums = np.bincount(inverse, grams["count"]).astype(np.int64)
        out = _dealt("code", bucket, grams, (mix(near.astype(U)) % U(parts)).astype(np.int64))
        out += _dealt("word", bucket, terms, (mix(terms["key"].view(U)) % U(parts)).astype(np.int64))
        out.append(("pairs", 0, bucket, None, [{"pair": p, "n": n} for p, n in zip(unique.tolist(), sums.tolist(), strict=True) if n]))
        return pd.DataFrame(out, columns=["kind", "part", "bucket", "packed", "pairs"])

    return ask


def _answer(pairs: np.ndarray, pair_counts: np.ndarray):
    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sent = [np.frombuffer(x, CODE) for x in rows["packed"]]
        total = _merged(sent)
        if key[0] == "code":
            value = log_probabilities(total["key"], total["count"], pairs, pair_counts)
        else:
            value = total["count"].astype(float)
        out = [(key[0], -1, None, int((total["count"] > 0).sum()))]
        for bucket, own in zip(rows["bucket"], sent, strict=True):
            found = np.empty(len(own), VALUE)
            found["key"], found["value"] = own["key"], value[np.searchsorted(total["key"], own["key"])]
            out.append((key[0], bucket, found.tobytes(), 0))
        return pd.DataFrame(out, columns=["kind", "bucket", "packed", "known"])

    return answer


def _apply(id: str, base: float, size: float):
    """Scores of the documents of a bucket; a word of count c has probability (c + base) / size."""

    def table(rows: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray]:
        found = np.concatenate([np.frombuffer(x, VALUE) for x in rows.loc[rows["kind"] == kind, "packed"]])
        found = found[np.argsort(found["key"])]
        return found["key"].copy(), found["value"].copy()

    def score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({id: docs[id], "learn": docs["learn"], "n_tokens": [], "n_known": [], "base_score": [], "score": []})
        code_keys, code_values = table(answers, "code")
        word_keys, word_values = table(answers, "word")
        scores, bases, tokens, known = [], [], [], []
        for _, data, offsets in chunks(_batch(docs["text"])):
            code, cuts = codes(data, offsets)
            scores.append(np.add.reduceat(code_values[np.searchsorted(code_keys, code)], cuts[:-1]))
            term, cuts = _words(data, offsets)
            count = word_values[np.searchsorted(word_keys, term)]
            bases.append(np.add.reduceat(np.log10((count + base) / size), cuts[:-1]))
            known.append(np.add.reduceat((count > 0).astype(np.int64), cuts[:-1]))
            tokens.append(np.diff(cuts))
        return pd.DataFrame({
            id: docs[id], "learn": docs["learn"], "n_tokens": np.concatenate(tokens), "n_known": np.concatenate(known),
            "base_score": np.concatenate(bases), "score": np.concatenate(scores)})

    return score


def score(docs: DataFrame, learn: str, s: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, learn, n_tokens, n_known, train_tokens, base_score, score) of each row.

    ``learn`` is a boolean column: the texts that the models count; null counts as false. ``score`` is the log10
    probability of the bytes and the end of the text, ``base_score`` that of its words and end under smoothed word
    counts. A null text is empty; ids may be null or repeated, and repeated rows are each learnt from and scored.
    Without training texts all bytes are equally likely.
    """
    parts = buckets(docs, s.bucket_mb, text)
    rows = docs.select(F.col(id).alias(id), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(learn), F.lit(False)).alias("learn"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(id, "text"), F.lit(parts)).cast("int"))
    asked = settled(rows.groupBy("bucket").applyInPandas(_ask(parts), SENT), "asked", "zstd")
    # At most 257 * 258 pairs.
    found = asked.where("kind = 'pairs'").select(F.explode("pairs").alias("x")).groupBy("x.pair").agg(F.sum("x.n").alias("n")).collect()
    found = sorted((r.pair, r.n) for r in found)
    pairs, counts = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)
    answered = settled(
        asked.where("kind <> 'pairs'").groupBy("kind", "part").applyInPandas(
            _answer(pairs, counts), "kind string, bucket int, packed binary, known long"), "answered", "zstd")
    distinct = answered.where("kind = 'word' AND bucket = -1").agg(F.sum("known")).first()[0] or 0
    lengths = F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")) + 1
    total = rows.where("learn").agg(F.sum(lengths)).first()[0] or 0
    size = total + s.smoothing * (distinct + 1)
    schema = f"`{id}` {docs.schema[id].dataType.simpleString()}, learn boolean, n_tokens long, n_known long, base_score double, score double"
    scored = rows.groupBy("bucket").cogroup(answered.where("bucket >= 0").groupBy("bucket")).applyInPandas(
        _apply(id, s.smoothing, size), schema)
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
