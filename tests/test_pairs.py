"""Pairs of options against counting them one by one."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallywell.operators import pairs, tabulate


def plain(answers, min_n):
    sets = [sorted(set(a) - {None}) for a in answers if a is not None]
    one = Counter(o for s in sets for o in s)
    two = Counter(p for s in sets for p in combinations(s, 2))
    n = len(sets)
    return sorted((a, b, k, round(k / n, 9), round(k / one[a], 9), round(k * n / (one[a] * one[b]), 9))
                  for (a, b), k in two.items() if k >= min_n)


def got(spark, answers, min_n, block):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "id long, options array<string>").repartition(3)
    found = pairs.co_occurrence(df, "options", min_n, block).collect()
    return sorted((r.a, r.b, r.n, round(r.support, 9), round(r.confidence, 9), round(r.lift, 9)) for r in found)


@pytest.mark.parametrize("min_n", [1, 2, 4])
@pytest.mark.parametrize("block", [3, 64])
def test_pairs_equal_counting(spark, min_n, block):
    rnd = random.Random(min_n)
    names = [f"option {i}" for i in range(40)]
    answers = [rnd.sample(names, rnd.randrange(0, 8)) for _ in range(120)]
    answers += [names, names, names[:25], None, [], ["only"], ["a", "a", None, "b"], ["option 1", "option 2"] * 3]
    assert got(spark, answers, min_n, block) == plain(answers, min_n)


def test_no_answers(spark):
    assert got(spark, [], 1, 64) == got(spark, [None, []], 2, 64) == []


def test_a_very_wide_answer_is_many_small_units(spark):
    wide = spark.range(20_000).select(F.lit(b"k").alias("key"), F.lit(1).alias("w"), F.lit(20_000).alias("size"),
                                      F.unhex(F.md5(F.col("id").cast("string"))).alias("no"))
    short = spark.range(5).select(F.lit(b"s").alias("key"), F.lit(1).alias("w"), F.lit(5).alias("size"),
                                  F.unhex(F.md5(F.col("id").cast("string"))).alias("no"))
    dealt = pairs.units(wide.union(short), 64).select(
        "key", (F.size("left") * F.size("right")).alias("cells"), F.size("left").alias("l"), (F.col("low") == F.col("high")).alias("one"))
    found = dealt.groupBy("key").agg(F.count("*").alias("units"), F.max("cells").alias("most"), F.sum(
        F.when(F.col("one"), F.col("l") * (F.col("l") - 1) / 2).otherwise(F.col("cells"))).alias("pairs")).collect()
    by_key = {bytes(r.key): r for r in found}
    assert by_key[b"k"].pairs == 20_000 * 19_999 / 2 and by_key[b"k"].most < 4 * 64 * 64
    assert by_key[b"s"].units == 1 and by_key[b"s"].pairs == 10


def test_the_plan_is_built_without_a_job(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, options array<string>")
    spark.sparkContext.setJobGroup("plan", "plan")
    pairs.co_occurrence(df, "options", 2)
    ran = spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(ran) == 0


@pytest.mark.parametrize("unit, k, days", [("day", 6, 3000), ("day", 0, 1100), ("week", 3, 9000), ("month", 2, 4000)])
def test_a_long_series_is_cut_into_slices(spark, unit, k, days):
    rnd = random.Random(k)
    rows = [(rnd.randrange(days), rnd.choice("ab")) for _ in range(400)] + [(0, "a"), (days, "a")]
    df = spark.createDataFrame(rows, "d int, label string").select(
        F.timestamp_seconds(F.col("d") * 86_400 - 400 * 86_400).alias("submitted_at"), F.lit(1).alias("satisfaction_int"), "label")
    for by in (None, "label"):
        out = tabulate.trend(df, unit, k, by)
        plan = out._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("_slice" in line.rsplit("], [", 2)[-2] for line in windows)
        series = {}
        for r in out.collect():
            series.setdefault(r[by] if by else None, []).append(r)
        for found in series.values():
            found.sort(key=lambda r: r.bucket)
            for i, r in enumerate(found):
                before = [x.n for x in found[max(0, i - k): i + 1]]
                assert r.delta == (r.n - found[i - 1].n if i else None)
                assert r.ma == pytest.approx(sum(before) / len(before))


def test_stray_dates_are_listed_and_not_filled(spark):
    df = spark.sql("SELECT timestamp(d) AS submitted_at, 3 AS satisfaction_int FROM VALUES ('1900-01-01'), ('2024-05-01'), ('2024-05-03') t(d)")
    span = ("2024-01-01", "2024-12-31")
    assert [r.n for r in tabulate.trend(df, "day", 1, between=span).orderBy("bucket").collect()] == [1, 0, 1]
    assert [(str(r.bucket)[:10], r.n) for r in tabulate.outside(df, *span).collect()] == [("1900-01-01", 1)]
