import pytest
from pyspark.sql import functions as F

from tallywell.functions import answers as a


def values(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_multi_select(spark):
    texts = [None, "", "a", "a, b,,a", "泡、味，缶", " 　 "]
    assert values(spark, texts, a.multi_select) == [None, [], ["a"], ["a", "b"], ["泡", "味", "缶"], []]


def test_satisfaction(spark):
    texts = ["4", " 4 ", "４", "4.0", "4.5", "6", "0", "abc", "", None]
    assert values(spark, texts, a.to_satisfaction) == [4, 4, 4, 4, None, None, None, None, None, None]


def test_number_in_range(spark):
    texts = ["0.0", "1.0", "1.2", "０．５", "-0.1", "NaN", "x", None]
    got = values(spark, texts, lambda c: a.to_number(c, 0.0, 1.0))
    assert got == [0.0, 1.0, None, 0.5, None, None, None, None]


def test_boolean(spark):
    texts = ["true", " YES ", "はい", "0", "いいえ", "maybe", "", None]
    assert values(spark, texts, a.to_boolean) == [True, True, True, False, False, None, None, None]


def test_submitted_at(spark):
    got = values(spark, ["2024-03-01 10:20:30", "n/a", None], lambda c: a.to_submitted_at(c).cast("string"))
    assert got == ["2024-03-01 10:20:30", None, None]
    got = values(spark, ["2024/03/01"], lambda c: a.to_submitted_at(c, "yyyy/MM/dd").cast("string"))
    assert got == ["2024-03-01 00:00:00"]


def test_text_list(spark):
    texts = ['["泡","味"]', "泡, 味", "[]", '["泡"', None, "", ' ["a, b"]', '["a"] junk', '["泡","泡",""," a ",null]', '["a"], "w": 1']
    assert values(spark, texts, a.text_list) == [
        ["泡", "味"], ["泡", "味"], [], None, None, [], ["a, b"], None, ["泡", "a"], None]
    assert values(spark, texts, a.is_damaged_list) == [False, False, False, True, None, False, False, True, False, True]


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in [None, -1.0, 199.9, 200.0, 349.0, 350.0, float("nan")]], "v double")
    got = [r[0] for r in df.select(a.band(F.col("v"), [200, 350], ["low", "mid", "high"])).collect()]
    assert got == [None, "low", "low", "mid", "mid", "high", None]
    with pytest.raises(ValueError):
        a.band(F.col("v"), [1, 2], ["x", "y"])
    with pytest.raises(ValueError):
        a.band(F.col("v"), [2, 1], ["x", "y", "z"])


def test_band_table_with_gap(spark):
    table = spark.createDataFrame([(10.0, 20.0, "b"), (0.0, 5.0, "a")], "low double, high double, code string")
    bands = a.bands_of(table)
    df = spark.createDataFrame([(v,) for v in [0.0, 4.9, 5.0, 10.0, 20.0, None]], "v double")
    assert [r[0] for r in df.select(a.band_from(F.col("v"), bands)).collect()] == ["a", "a", None, "b", None, None]
    with pytest.raises(ValueError):
        a.bands_of(table.union(spark.createDataFrame([(4.0, 6.0, "c")], table.schema)))


def test_long_band_table(spark):
    table = spark.createDataFrame([(float(i), i + 0.5, f"b{i}") for i in range(1000)], "low double, high double, code string")
    df = spark.createDataFrame([(v,) for v in [-0.1, 0.0, 500.25, 500.5, 999.49, 999.5, float("nan")]], "v double")
    got = [r[0] for r in df.select(a.band_from(F.col("v"), a.bands_of(table))).collect()]
    assert got == [None, "b0", "b500", None, "b999", None, None]


def test_rank_follows_the_documented_order(spark):
    order = ["under199", "200_249", "350plus"]
    assert values(spark, ["350plus", "under199", "x", None], lambda c: a.rank_of(c, order)) == [3, 1, None, None]
