"""The first k rows of each group, for any k and any size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: up to here Spark itself cuts the rows of a group in every task before the exchange.
CUT_BEFORE_EXCHANGE = 1000


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """``df`` with the first ``k`` rows of each group of ``keys``, numbered from 1 in a bigint column ``rank``.

    ``order`` should be total within a group. Up to a k of 1,000 each task cuts its rows before the one exchange.
    Above it the rows of a group of n are dealt by a hash to sqrt(n / k) parts, each part is cut to k, and the parts of a
    group meet; so no task sees more than about sqrt(n * k) rows of a group, and ``df`` is read twice. A hot group is
    spread like any other. NULL keys are a group of their own.
    """
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if k > CUT_BEFORE_EXCHANGE:
        df = _cut_by_parts(df, keys, order, k)
    return df.withColumn(rank, numbered).filter(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def _cut_by_parts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    sizes = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    # The hash is of what rows can be told apart by; equal rows may stay together.
    plain = [F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    salt = F.pmod(F.xxhash64(*plain), F.ceil(F.sqrt(F.col("_n") / k)))
    dealt = df.join(sizes, same).select(*[F.col(c) for c in df.columns], salt.alias("_part"))
    first = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    return dealt.withColumn("_place", first).filter(F.col("_place") <= k).drop("_part", "_place")
