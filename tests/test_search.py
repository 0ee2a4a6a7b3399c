"""Long lists, ranges and large k against the short forms and brute force."""

import bisect
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywell.functions.lexicon import Lexicon
from tallywell.functions.memory import ARROW_LIMIT, ARROW_MB
from tallywell.functions.search import SLICE_BYTES, Finder, TermList, label_scores, slices
from tallywell.functions.text import LETTERS
from tallywell.operators import labelling, long_lists, ranges
from tallywell.operators.ranked import top_per_group
from tallywell.schema import CATEGORIES

KANA = "あいうえおかきくけこさしすせそ"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain_hits(text, terms, whole_words):
    """The hits of the pattern that an inline list would be."""
    options = "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))
    return re.findall(f"(?<![{LETTERS}])({options})(?![{LETTERS}])" if whole_words else f"({options})", text)


@pytest.mark.parametrize("whole_words", [True, False])
def test_finder_equals_the_pattern(whole_words):
    rnd = random.Random(2)
    for _ in range(200):
        letters = "ab é-"
        terms = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 5))) for _ in range(6)})
        text = "".join(rnd.choice(letters) for _ in range(80))
        finder = Finder([TermList(tuple((t, None, 1) for t in terms), whole_words)])
        assert sorted(t for _, t in finder.terms(text)) == sorted(plain_hits(text, terms, whole_words))


def test_ten_thousand_terms_equal_inline_lists(spark):
    rnd = random.Random(3)
    terms = sorted({"".join(rnd.choice(KANA) for _ in range(rnd.randrange(2, 7))) for _ in range(12_000)})[:10_000]
    texts = ["".join(rnd.choice(KANA + "。") for _ in range(rnd.randrange(200))) for _ in range(40)]
    df = spark.createDataFrame([*enumerate(texts), (98, ""), (99, None)], "id long, free_comment string")
    table = spark.createDataFrame([(t, CATEGORIES[i % 18], 1 + i % 3) for i, t in enumerate(terms)], long_lists.LIST_SCHEMA)
    found = long_lists.extract(df, table, "p", whole_words=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "regexp_extract_all" not in plan
    for row in found.collect():
        own = [s.strip() for s in re.split("[.!?\n。！？]+", row.free_comment or "")]
        expected = [s for s in dict.fromkeys(own) if s and plain_hits(s, terms, False)]
        assert row.p == (None if row.free_comment is None else expected)


def test_one_search_serves_all_columns(spark):
    good = Lexicon.of([("good", "Aroma", 2), ("nice", "Flavor", 1)])
    df = spark.createDataFrame([(1, "Good beer. Nice? bad at home"), (2, None), (3, "none")], "id long, free_comment string")
    bad, scene = Lexicon.of([("bad", "Aroma", 1)]), Lexicon.of_terms(["home"])
    out = labelling.enrich(df, good, bad, scene)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_extract_all" not in plan
    first, second, third = out.orderBy("id").collect()
    assert first.positive_point == ["Good beer", "Nice"] and first.negative_feedback == first.scene == ["bad at home"]
    assert first.positive_point_category == "Aroma" and first.positive_point_confidence == pytest.approx(2 / 3)
    assert second.positive_point is None and second.scene is None and second.negative_feedback_category is None
    assert third.positive_point == [] and third.positive_point_category is None


def test_a_list_too_long_to_send_is_joined(spark, monkeypatch):
    words = [("aa", "Aroma", 1), ("bb", "Flavor", 2), ("aa", "Flavor", 1), ("cc", None, 1)]
    df = spark.createDataFrame([(1, "aa aa bb. cc! dd"), (2, "dd"), (3, None), (4, "Cc")], "id long, free_comment string")
    table = spark.createDataFrame(words, long_lists.LIST_SCHEMA)
    short = [rows_of(f(df, table, "p")) for f in (long_lists.classify, long_lists.extract)] + [rows_of(long_lists.feedback_rows(df, table, table))]
    monkeypatch.setattr(long_lists, "table_fits", lambda terms: False)
    long = [rows_of(f(df, table, "p")) for f in (long_lists.classify, long_lists.extract)] + [rows_of(long_lists.feedback_rows(df, table, table))]
    assert short == long


def test_label_scores_leave_out_terms_without_a_label(spark):
    found = F.from_json(F.lit('[{"no":-1,"list":0,"label":-1,"score":3},{"no":-1,"list":0,"label":1,"score":2}]'),
                        "array<struct<no:int,list:int,label:int,score:bigint>>")
    assert spark.range(1).select(label_scores(found, ("x", "y")).alias("s")).first().s[0].label == "y"


def test_band_join_equals_looking_up(spark):
    rnd = random.Random(4)
    edges = sorted(rnd.sample(range(20_000), 4_001))
    bands = [(float(a), float(b), f"c{a}") for i, (a, b) in enumerate(zip(edges, edges[1:])) if i % 5]
    values = [rnd.uniform(-50, 20_100) for _ in range(3_000)] + [float(e) for e in edges[:500]] + [7.0] * 2_000 + [None, float("nan"), float("inf")]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    table = spark.createDataFrame(bands, "low double, high double, code string")
    lows = [b[0] for b in bands]

    def code(v):
        i = bisect.bisect_right(lows, v) - 1 if v is not None and v == v else -1
        return bands[i][2] if i >= 0 and v < bands[i][1] else None

    got = {r.id: r.band for r in ranges.band_join(df, F.col("v"), table, "band").collect()}
    assert got == {i: code(v) for i, v in enumerate(values)}


def test_band_join_odd_tables(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id long, v double")
    none = spark.createDataFrame([], "low double, high double, code string")
    assert rows_of(ranges.band_join(df, F.col("v"), none, "b")) == [(1, 2.0, None), (2, None, None)]
    assert ranges.band_join(df.limit(0), F.col("v"), none, "b").collect() == []
    wrong = spark.createDataFrame([(0.0, 5.0, "a"), (4.0, 9.0, "b"), (9.0, 9.0, "c")], "low double, high double, code string")
    assert [r.code for r in ranges.check_bands(wrong).orderBy("low").collect()] == ["a", "c"]
    with pytest.raises(ValueError, match="overlap"):
        ranges.band_join(df, F.col("v"), wrong, "b")


@pytest.mark.parametrize("k", [5, 1001, 2000])
def test_top_per_group_with_a_hot_group(spark, k):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot", "hot", "hot", "x", None]), rnd.randrange(50), i) for i in range(12_000)]
    df = spark.createDataFrame(rows, "g string, v int, id long")
    got = rows_of(top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], k))
    expected = []
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:k]
        expected += [(*r, i) for i, r in enumerate(own, 1)]
    assert got == sorted(expected, key=repr)


def test_a_hot_group_is_cut_in_parts_for_a_large_k(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    plan = top_per_group(df, ["g"], [F.asc("id")], 2000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Window") + plan.count(" Window [") >= 2 and "_part" in plan


def test_slices_hold_little_text_and_all_comments():
    rows = [["aé", None, "b"], None, [], ["x" * 40], ["y"] * 30, [None], ["z"]] * 3
    batch = pa.array(rows, pa.list_(pa.string()))
    parts = list(slices(batch, 10))
    assert [x for p in parts for x in p.to_pylist()] == rows
    for p in parts:
        assert len(p) == 1 or sum(len(s.encode()) for x in p.to_pylist() for s in x or [] if s) <= 10
    assert not list(slices(batch.slice(0, 0)))


def test_search_of_more_text_than_a_slice(spark):
    before = spark.conf.get(ARROW_LIMIT)
    try:
        spark.conf.set(ARROW_LIMIT, "64m")
        long = "the " + "word " * (SLICE_BYTES // 40)
        rows = [(i, f"Of {i}. none. {long}of the. and" if i % 7 else None) for i in range(40)]
        df = spark.createDataFrame(rows, "id long, free_comment string").coalesce(1)
        got = labelling.extract(df, Lexicon.of([("of", "Aroma", 2), ("and", None, 1)]), "found")
        assert spark.conf.get(ARROW_LIMIT) == f"{ARROW_MB}m"
        got = {r.id: r.found for r in got.select("id", "found").collect()}
        assert got == {i: [f"Of {i}", f"{long}of the", "and"] if i % 7 else None for i in range(40)}
    finally:
        spark.conf.set(ARROW_LIMIT, before)
