"""Quality rules: counts of words, symbols and repeats, and a hashed n-gram log-likelihood ratio.

Two kinds of n-grams are hashed into ``buckets`` counters: words, and pairs of the endings (last two characters) of
neighbouring words. A target multinomial is counted over trusted documents and a raw one over all documents.
A document's score is the mean log ratio of its n-grams, and documents under a fixed threshold are not kept.
All of it is built-in functions: a document is split once into an array and never leaves its row, and only
bucket counts are shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import unused

BLANKS = "\\x20\\x09-\\x0D"


@dataclass(frozen=True)
class Settings:
    buckets: int = 16_384
    threshold: float = -0.08
    smoothing: float = 0.5
    window: int = 5
    least_words: int = 10
    repeat_percent: int = 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), lambda w: w != "")


def _grams(words: str, buckets: int) -> Column:
    """The buckets of a document's n-grams; ``words`` must be a column of its own, which is then not split again."""
    w = F.col(words)
    single = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    pair = F.transform(w, lambda x, i: F.pmod(
        F.xxhash64(F.lit(2), F.substring(x, -2, 2), F.substring(F.get(w, i + 1), -2, 2)), F.lit(buckets)).cast("int"))
    return F.concat(single, pair)


def fit(docs: DataFrame, trusted: DataFrame, s: Settings = Settings(), id: str = "doc_id", text: str = "text") -> list[float]:
    """The log ratio of each bucket, from all documents whose ids are in ``trusted`` and from all documents.

    Without any trusted ones, all ratios are 0.
    """
    ids = trusted.select(F.col(id).alias(id)).where(F.col(id).isNotNull()).distinct().withColumn("_target", F.lit(1))
    # Texts meet their ids before they are split: an array of words is larger than its text. Both sides are dealt by
    # the id at any size, so that a large run costs what a small one foretells.
    marked = docs.select(F.col(id).alias(id), F.col(text).alias("_text")).join(ids.hint("merge"), id, "left")
    counts = (
        marked.select(F.coalesce("_target", F.lit(0)).alias("t"), words_of(F.col("_text")).alias("w"))
        .select("t", F.explode(_grams("w", s.buckets)).alias("b"))
        .groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect())
    raw, target = [0] * s.buckets, [0] * s.buckets
    for row in counts:
        raw[row.b], target[row.b] = row.raw, row.target
    if not sum(target):
        return [0.0] * s.buckets
    # The target is smoothed by the raw shares, so buckets without evidence have a ratio of about 1.
    weight = s.smoothing * s.buckets
    shares = [(r + s.smoothing) / (sum(raw) + weight) for r in raw]
    size = sum(target) + weight
    return [math.log((t + weight * share) / size / share) for t, share in zip(target, shares, strict=True)]


def _repeat_words(words: str, window: int) -> Column:
    """Words in windows that stand at least twice in a document; windows are compared by 64-bit hashes."""
    w = F.col(words)
    starts = F.when(F.size(w) >= window, F.sequence(F.lit(0), F.size(w) - window)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(window))))

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            twice = F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"]))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        sum_up = F.aggregate(
            F.transform(F.array(pairs), places)[0], F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n")),
            lambda acc: acc["n"])
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(sum_up)

    # A one-element array binds the hashes, which would otherwise be worked out at each use.
    return F.transform(F.array(hashes), covered)[0].cast("long")


def judge(docs: DataFrame, ratios: list[float], s: Settings = Settings(), text: str = "text") -> DataFrame:
    """``docs`` without the text, with the counts, base_failed, score and kept.

    A null text has no words, so it fails. An empty table gives no rows. Repeated rows are judged alike; other columns stay, and those named like
    the new ones are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    kept = [c for c in docs.columns if c != text and c not in new]
    w, total = unused(docs, "_w", "_sum")
    found = docs.select(
        *kept, words_of(F.col(text)).alias(w),
        F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"))
    found = found.select(
        "*", F.size(w).cast("long").alias("n_words"), _repeat_words(w, s.window).alias("n_repeat_words"),
        F.aggregate(_grams(w, s.buckets), F.lit(0.0), lambda acc, b: acc + F.get(table, b)).alias(total))
    score = F.when(F.col("n_words") > 0, F.col(total) / (2 * F.col("n_words"))).otherwise(0.0)
    failed = (F.col("n_words") < s.least_words) | (100 * F.col("n_repeat_words") > s.repeat_percent * F.col("n_words"))
    return found.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), score.alias("score"),
                        (~failed & (score >= s.threshold)).alias("kept"))
