"""What people write: frequent phrases, n-grams, terms that set a segment apart, and search."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.functions.text import char_ngrams, place_of, snippet
from tallywell.operators.ranked import top_per_group


def phrase_topk(df: DataFrame, phrases: str, k: int) -> DataFrame:
    """(phrase, n, rank): the k phrases most respondents used; ties go by the phrase."""
    counts = (
        df.select(F.explode(F.array_distinct(phrases)).alias("phrase"))
        .groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.orderBy(F.desc("n"), "phrase").limit(k)
    # k rows are left, so one partition is enough for numbering them.
    numbered = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "phrase"))
    return top.select("phrase", "n", numbered.cast("bigint").alias("rank"))


def phrase_topk_approx(df: DataFrame, phrases: str, k: int, max_items: int = 100_000) -> DataFrame:
    """(phrase, n) by a frequent-items sketch: one small sketch per task instead of a shuffle of
    all phrases. Counts may be too high for phrases that are not frequent."""
    return (
        df.select(F.explode(F.array_distinct(phrases)).alias("phrase"))
        .agg(F.call_function("approx_top_k", F.col("phrase"), F.lit(k), F.lit(max_items)).alias("_top"))
        .select(F.inline("_top"))
        .select(F.col("item").alias("phrase"), F.col("count").alias("n"))
    )


def phrase_sketches(df: DataFrame, phrases: str, by: Column | None = None, max_items: int = 100_000) -> DataFrame:
    """(part, sketch, n): a frequent-items sketch of the phrases for each value of ``by``, and how many it has seen.

    Sketches of one ``max_items`` can be kept, for example one a day, and be put together later by ``merged_candidates``.
    Without ``by`` the tasks of the scan share 64 parts, so that no task merges the sketches of all of them.
    """
    part = by if by is not None else F.pmod(F.spark_partition_id(), F.lit(64))
    return (
        df.select(part.alias("part"), F.explode(F.array_distinct(phrases)).alias("phrase")).filter("phrase IS NOT NULL")
        .groupBy("part").agg(
            F.call_function("approx_top_k_accumulate", F.col("phrase"), F.lit(max_items)).alias("sketch"),
            F.count(F.lit(1)).alias("n"))
    )


def merged_candidates(sketches: DataFrame, max_items: int = 100_000) -> DataFrame:
    """(phrase, estimate, total) of the phrases, at most ``max_items``, that the merged sketches hold as frequent.

    ``total`` is the number of occurrences in all sketches. A phrase of more than ``least_share`` of them is never missing.
    """
    return (
        sketches.agg(F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(max_items)).alias("sketch"),
                     F.sum("n").alias("total")).filter("total > 0")
        .select("total", F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(max_items)).alias("found"))
        .select("total", F.inline("found"))
        .select(F.col("item").alias("phrase"), F.col("count").alias("estimate"), "total")
    )


def least_share(max_items: int) -> tuple[int, int]:
    """(a, b): phrases of more than a / b of all occurrences are in the sketch for sure.

    A sketch has 2^j >= max_items / 0.75 cells and errs by at most 3.5 / 2^j of all occurrences; a phrase is reported
    if its count less the error is above the error.
    """
    return 7, 1 << (math.ceil(max_items / 0.75) - 1).bit_length()


def phrase_topk_sketched(df: DataFrame, phrases: str, k: int, max_items: int = 100_000) -> DataFrame:
    """(phrase, n, rank, sure): the k most used phrases that a sketch holds as frequent, with exact counts.

    A first scan builds sketches, a second one counts their phrases, so only counts of ``max_items`` phrases a task are
    shuffled, not all phrases. ``sure`` phrases are so frequent that the sketch cannot have missed them; if the last
    row is sure, the list is that of ``phrase_topk``.
    """
    found = merged_candidates(phrase_sketches(df, phrases, max_items=max_items), max_items)
    a, b = least_share(max_items)
    # At most max_items rows.
    counts = (
        df.select(F.explode(F.array_distinct(phrases)).alias("phrase"))
        .join(F.broadcast(found), "phrase").groupBy("phrase", "total").agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.orderBy(F.desc("n"), "phrase").limit(k)
    numbered = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "phrase"))
    return top.select("phrase", "n", numbered.cast("bigint").alias("rank"), (F.col("n") * b > F.col("total") * a).alias("sure"))


def ngram_counts(df: DataFrame, n: int = 2, text: str = "free_comment") -> DataFrame:
    """(gram, n) for every character n-gram of the texts."""
    return (
        df.select(F.explode(char_ngrams(F.col(text), n)).alias("gram"))
        .groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    )


def distinctive_terms(df: DataFrame, segment: str, terms: Column, k: int) -> DataFrame:
    """(segment, term, n, tfidf, rank): tf-idf with each segment as one document.

    A segment of very many terms is cut in parts first, for any k (``ranked.top_per_group``). A segment whose comments are all empty does not count as one.
    """
    df = df.filter(F.col(segment).isNotNull())
    counts = (
        df.select(F.col(segment).alias("segment"), F.explode(terms).alias("term"))
        .groupBy("segment", "term").agg(F.count(F.lit(1)).alias("n"))
    )
    segments = counts.agg(F.countDistinct("segment")).scalar().cast("double")
    # Joined and not windowed: a term of very many segments would fill one task.
    spread = counts.groupBy(F.col("term").alias("_term")).agg(F.count(F.lit(1)).alias("_df"))
    scored = counts.join(spread, F.col("term") == F.col("_term")).withColumn(
        "tfidf", F.round(F.col("n") * F.ln(segments / (1 + F.col("_df"))), 6))
    return top_per_group(scored, ["segment"], [F.desc("tfidf"), F.asc("term")], k).select("segment", "term", "n", "tfidf", "rank")


def comment_search(
    df: DataFrame, term: str, width: int = 20, text: str = "free_comment"
) -> DataFrame:
    """The rows whose comment holds the term, with a ``snippet`` around its first place."""
    return (
        df.filter(place_of(F.col(text), term) > 0)
        .withColumn("snippet", snippet(F.col(text), term, width))
    )


def best_examples(
    df: DataFrame, k: int, label: str, confidence: str, id: str = "id"
) -> DataFrame:
    """The k surest rows of each label, numbered in ``rank``."""
    return top_per_group(df.filter(F.col(label).isNotNull()), [label], [F.desc(confidence), F.asc(id)], k)
