import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywell.functions import text as t
from tallywell.operators import wording

TEXTS = ["泡が良い。味が薄い。缶が好き！", "泡", "", "泡が😀良", "a\nb", None]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id bigint, free_comment string")


def column(df, expression):
    return [r[0] for r in df.orderBy("id").select(expression).collect()]


def test_sentences(spark):
    got = column(frame(spark), t.sentences(F.col("free_comment")))
    assert got == [["泡が良い", "味が薄い", "缶が好き"], ["泡"], [], ["泡が😀良"], ["a", "b"], None]


def test_bigrams_keep_characters_whole(spark):
    got = column(frame(spark), t.char_ngrams(F.col("free_comment")))
    assert got[1:] == [[], [], ["泡が", "が😀", "😀良"], ["a\n", "\nb"], None]


def test_trigrams_and_single_characters(spark):
    df = frame(spark, ["ab😀d"])
    assert column(df, t.char_ngrams(F.col("free_comment"), 3)) == [["ab😀", "b😀d"]]
    assert column(df, t.char_ngrams(F.col("free_comment"), 1)) == [["a", "b", "😀", "d"]]


def test_ngram_counts_against_python(spark):
    texts = ["ながいなが", "😀😀😀", "aaaa", None, "x"]
    want = {}
    for x in texts:
        for i in range(len(x or "") - 1):
            want[x[i:i + 2]] = want.get(x[i:i + 2], 0) + 1
    assert {r.gram: r.n for r in wording.ngram_counts(frame(spark, texts)).collect()} == want


def test_search_and_snippet(spark):
    df = frame(spark, ["It was a long road to the OLD mill", "old", "none", None])
    got = {r.id: r.snippet for r in wording.comment_search(df, "old", width=4).collect()}
    assert got == {0: "the OLD mil", 1: "old"}


def test_best_examples(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5), (2, "a", 0.9), (3, "a", 0.9), (4, "b", 0.1), (5, None, 1.0)], "id int, label string, c double")
    got = wording.best_examples(df, 2, "label", "c").collect()
    assert sorted((r.label, r.rank, r.id) for r in got) == [("a", 1, 2), ("a", 2, 3), ("b", 1, 4)]


def test_phrase_topk_and_its_sketch(spark):
    df = spark.createDataFrame([(["x", "x", "y"],), (["x"],), (["z"],), ([],), (None,)], "p array<string>")
    got = [(r.phrase, r.n, r.rank) for r in wording.phrase_topk(df, "p", 2).orderBy("rank").collect()]
    assert got == [("x", 2, 1), ("y", 1, 2)]
    assert wording.phrase_topk_approx(df, "p", 1).collect()[0].asDict() == {"phrase": "x", "n": 2}


@pytest.mark.parametrize("by", [None, "day"])
def test_sketches_of_parts_hold_every_frequent_phrase(spark, by):
    rnd = random.Random(4)
    lists = [(i % 5, [f"p{int(rnd.paretovariate(0.7))}" for _ in range(20)]) for i in range(2000)]
    counts = Counter(x for _, p in lists for x in set(p))
    df = spark.createDataFrame([*lists, (9, None), (9, [])], "day int, p array<string>").repartition(7)
    items, total = 90, sum(counts.values())
    found = {r.phrase: r for r in wording.merged_candidates(wording.phrase_sketches(df, "p", by and F.col(by), items), items).collect()}
    a, b = wording.least_share(items)
    assert (a, b) == (7, 128) and len(counts) > 6 * b and len(found) <= items
    sure = {x for x, n in counts.items() if n * b > total * a}
    assert sure and sure <= set(found)
    for x, r in found.items():
        assert r.total == total and abs(r.estimate - counts[x]) * b <= 3.5 * total


def test_sketched_topk_is_exact_where_sure(spark):
    rnd = random.Random(5)
    lists = [([f"p{int(rnd.paretovariate(0.7))}" for _ in range(20)],) for _ in range(2000)]
    df = spark.createDataFrame(lists, "p array<string>").repartition(5)
    got = sorted(wording.phrase_topk_sketched(df, "p", 40, 700).collect(), key=lambda r: r.rank)
    want = sorted(wording.phrase_topk(df, "p", 40).collect(), key=lambda r: r.rank)
    sure = [r for r in got if r.sure]
    assert 3 <= len(sure) < 40 and [tuple(r)[:3] for r in sure] == [tuple(r) for r in want[: len(sure)]]
    assert wording.phrase_topk_sketched(df.limit(0), "p", 3).count() == 0


def test_distinctive_terms(spark):
    df = spark.createDataFrame([("en", "a b"), ("fr", "a c c"), ("de", "a"), (None, "q")], "seg string, t string")
    got = wording.distinctive_terms(df, "seg", t.words(F.col("t")), 1)
    assert {r.segment: (r.term, r.n) for r in got.collect()} == {"en": ("b", 1), "fr": ("c", 2), "de": ("a", 1)}


def test_snippet_counts_places_in_the_text_itself(spark):
    df = spark.createDataFrame([("İİİ the thes x",), ("Say THES.",), ("none",)], "t string")
    assert [r[0] for r in df.select(t.snippet(F.col("t"), "thes", 2)).collect()] == ["e thes x", "y THES.", None]
