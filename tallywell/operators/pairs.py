"""Pairs of options that respondents give together, for answers of any length.

The options of an answer are dealt to blocks, as many as its own length asks for, and each two blocks of it are one
unit of work with about ``block`` squared pairs. So an answer of 20,000 options is many units among those of
short answers, which are one unit each, and nothing has to be measured or decided before the job runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64


def co_occurrence(df: DataFrame, options: str, min_n: int = 1, block: int = BLOCK) -> DataFrame:
    """(a, b, n, support, confidence, lift) of options given by the same respondent, a < b.

    ``df`` has one row per respondent and ``confidence`` is that of b given a. Only pairs with at least ``min_n``
    respondents are reported, which allows three exact savings:

    * equal answers are counted once, with the number of respondents as weight ``w``, so ids may be missing or
      repeated;
    * an option with fewer respondents than min_n is in no reported pair and goes first;
    * a reported pair has min_n respondents, so if the min_n - 1 widest answers are set aside, some other answer still
      shows it. Those widest ones never list their pairs, they are only looked up for pairs already found.

    Pairs travel as 128-bit digests of the options, which may be long phrases; answers are known by digests too. A
    digest does not depend on how rows are stored, so no table has to be written while the plan is built.
    """
    answered = df.filter(F.col(options).isNotNull())
    answers = (
        answered.groupBy(F.array_sort(F.array_compact(F.array_distinct(options))).alias("_set"))
        .agg(F.count(F.lit(1)).alias("w")).withColumn("key", _digest(F.to_json(F.struct("_set"))))
    )
    base = answers.agg(F.sum("w")).scalar().cast("double")
    entries = answers.select("key", "w", F.size("_set").alias("size"), F.explode("_set").alias("option"))
    counts = entries.groupBy("option").agg(F.sum("w").alias("n")).filter(F.col("n") >= min_n)
    numbered = entries if min_n == 1 else entries.join(counts.select("option"), "option", "left_semi")
    numbered = numbered.select("key", "w", "size", _digest(F.col("option").cast("string")).alias("no"))
    found = _counted(numbered, answers, min_n, block)

    named = counts.select(_digest(F.col("option").cast("string")).alias("no"), "option", "n")
    left = F.struct("_oa", "_na")
    right = F.struct(F.col("_ob").alias("_oa"), F.col("_nb").alias("_na"))
    ends = (
        found
        .join(named.select(F.col("no").alias("a"), F.col("option").alias("_oa"), F.col("n").alias("_na")), "a")
        .join(named.select(F.col("no").alias("b"), F.col("option").alias("_ob"), F.col("n").alias("_nb")), "b")
        .select("n", F.array_sort(F.array(left, right)).alias("_ends"))
        .select(F.col("_ends")[0]["_oa"].alias("a"), F.col("_ends")[1]["_oa"].alias("b"), "n",
                F.col("_ends")[0]["_na"].cast("double").alias("_na"),
                F.col("_ends")[1]["_na"].cast("double").alias("_nb"))
    )
    n = F.col("n").cast("double")
    return ends.select(
        "a", "b", "n",
        F.try_divide(n, base).alias("support"),
        F.try_divide(n, F.col("_na")).alias("confidence"),
        F.try_divide(n * base, F.col("_na") * F.col("_nb")).alias("lift"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def units(entries: DataFrame, block: int) -> DataFrame:
    """(key, low, high, w, left, right): two blocks of an answer, or one with itself, with the options of either.

    An option is in as many units as its answer has blocks, so the rows dealt are the pairs divided by ``block``.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = entries.withColumn("_own", F.pmod(F.xxhash64("no"), blocks).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = lambda end: F.collect_list(F.when(F.col("_own") == F.col(end), F.col("no")))
    return dealt.withColumns({"low": low, "high": high}).groupBy("key", "low", "high").agg(
        F.max("w").alias("w"), side("low").alias("left"), side("high").alias("right"))


def listed(pairs_of: DataFrame) -> DataFrame:
    """(a, b, w) with a before b."""
    one = F.col("low") == F.col("high")
    pairs = F.flatten(F.transform("left", lambda a: F.transform(
        F.filter("right", lambda b: ~one | (b > a)), lambda b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")))))
    return pairs_of.select("w", F.inline(pairs))


def _counted(numbered: DataFrame, answers: DataFrame, min_n: int, block: int) -> DataFrame:
    """(a, b, n) of the pairs that at least min_n respondents gave."""
    if min_n == 1:
        return listed(units(numbered, block)).groupBy("a", "b").agg(F.sum("w").alias("n"))
    widest = answers.select("key", "w", F.size("_set").alias("size")).orderBy(F.desc("size"), "key").limit(min_n - 1)
    aside = _lightest(widest, min_n - 1)
    shown = listed(units(numbered.join(aside, "key", "left_anti"), block)).groupBy("a", "b").agg(F.sum("w").alias("n"))
    held = numbered.join(aside, "key", "left_semi")
    more = (
        shown.select("a", "b")
        .join(held.select(F.col("no").alias("a"), "key", "w"), "a")
        .join(held.select(F.col("no").alias("b"), "key"), ["b", "key"], "left_semi")
        .groupBy("a", "b").agg(F.sum("w").alias("more"))
    )
    found = shown.join(more, ["a", "b"], "left").select("a", "b", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
    return found.filter(F.col("n") >= min_n)


def _lightest(widest: DataFrame, limit: int) -> DataFrame:
    """The keys of the widest answers whose weights together stay within ``limit``.

    At most ``limit`` rows come in, so numbering them in one partition is bounded.
    """
    so_far = F.sum("w").over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("size"), "key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return widest.withColumn("_w", so_far).filter(F.col("_w") <= limit).select("key")
