"""Exact top-k inner products by term-at-a-time accumulation.

Every component of a vector is a term. A block of candidate rows is held as postings, for each term the
rows with a non-zero weight and their weights. A query scatters its weight times the postings of each of
its terms into a dense array of scores, a partition selects the k best of the block, and the best of all
blocks are merged. Queries and candidates meet block by block: a block of either side is bounded, so no
task holds a whole table, and no pair becomes a row before it is among the k best of its block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import settled

CANDIDATE_BLOCK, QUERY_BLOCK, AT_ONCE = 8192, 2048, 64
RESULT = "query_id long, query_key long, vec_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double; null where the vector may take no part."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(sound, whole)


def _postings(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per term, (rows, weights)."""
    lengths = np.array([len(v) for v in vectors])
    row = np.repeat(np.arange(len(vectors)), lengths)
    term = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weight = np.concatenate(vectors) if len(vectors) else np.zeros(0, np.int64)
    row, term, weight = row[weight != 0], term[weight != 0], weight[weight != 0]
    order = np.argsort(term, kind="stable")
    cuts = np.searchsorted(term[order], np.arange(lengths.max(initial=0) + 1))
    return [(row[order[a:b]], weight[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, ties = np.flatnonzero(scores > edge), np.flatnonzero(scores == edge)
        need = k - len(above)
        if len(ties) > need:
            ties = ties[np.argpartition(ids[ties], need - 1)[:need]] if need else ties[:0]
        at = np.concatenate([above, ties])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of a block of candidates for each query of a block."""
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    if len(candidates):
        ids = candidates["id"].to_numpy(np.int64)
        postings = _postings([np.asarray(v, np.int64) for v in candidates["v"]])
        query_ids, keys = queries["id"].to_numpy(np.int64), queries["h"].to_numpy(np.int64)
        rows = [np.asarray(v, np.int64) for v in queries["v"]]
        for low in range(0, len(rows), AT_ONCE):
            part = rows[low: low + AT_ONCE]
            weights = np.zeros((len(postings), len(part)), np.int64)
            for j, q in enumerate(part):
                weights[: min(len(q), len(postings)), j] = q[: len(postings)]
            scores = np.zeros((len(part), len(ids)), np.int64)
            for term, (row, weight) in enumerate(postings):
                for j in np.flatnonzero(weights[term]):
                    if len(row) == len(ids):
                        scores[j] += weights[term, j] * weight
                    else:
                        scores[j, row] += weights[term, j] * weight
            for j in range(len(part)):
                q, key = query_ids[low + j], keys[low + j]
                other = np.flatnonzero(ids != q)
                at = other[_best(scores[j, other], ids[other], k)]
                out.append((q, key, ids[at], scores[j, at]))
    empty = np.zeros(0, np.int64)
    return pd.DataFrame({
        "query_id": np.concatenate([np.full(len(i), q) for q, _, i, _ in out] or [empty]),
        "query_key": np.concatenate([np.full(len(i), h) for _, h, i, _ in out] or [empty]),
        "vec_id": np.concatenate([i for _, _, i, _ in out] or [empty]),
        "score": np.concatenate([s for _, _, _, s in out] or [empty]),
    })


def search(vectors: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = 5,
           scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row where ``is_query``.

    A null vector, one with a null or non-finite component, and a null id take no part. Vectors may
    differ in length; a missing component is 0. A row is no candidate of queries with its own id; of
    repeated ids each row is a candidate, and each distinct query row is answered. Sums are 64-bit and wrap as
    Spark's do. Other columns are ignored. An empty table gives no rows.
    """
    rows = settled(
        vectors.select(F.col(id).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("q"))
        .where("id IS NOT NULL AND v IS NOT NULL").withColumn("h", F.xxhash64("id", "v")),
        "topk-rows")
    n, asked = rows.agg(F.count("*"), F.count_if("q")).first()
    wide, deep = max(1, math.ceil(n / CANDIDATE_BLOCK)), max(1, math.ceil(asked / QUERY_BLOCK))
    def dealt(side: DataFrame, own: int, others: int, key: str, other: str) -> DataFrame:
        return side.select("id", "v", "h", F.pmod("h", F.lit(own)).cast("int").alias(key),
                           F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    candidates = dealt(rows, wide, deep, "c", "b")
    queries = dealt(rows.where("q").dropDuplicates(["id", "h"]), deep, wide, "b", "c")

    def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_block(left, right, k)

    found = queries.groupBy("c", "b").cogroup(candidates.groupBy("c", "b")).applyInPandas(meet, RESULT)
    by_score = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
