"""Mined phrases against counting every phrase in a dictionary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallywell.llm import collocations as co
from tallywell.llm.common import ARROW_LIMIT, ARROW_MB, U

SCHEMA = "text string, lang string, word string, n long, phrase string, rank string, score string, part string"
EXTRA = ("a", 7, "b", "c", "d", "e")


def plain(rows, s):
    """[(lang, rank, phrase, a, l, r, n, score)]"""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for d in range(1, s.longest + 1):
                    if i + d <= len(words):
                        f[lang][tuple(words[i: i + d])] += 1
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= s.least}
        held = set()
        for q, b in candidates.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    if 100 * b >= s.percent * own[q[i: i + m]]:
                        held.add(q[i: i + m])
        found = []
        for p, a in candidates.items():
            if p not in held:
                cuts = [(1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((score, a, " ".join(p), own[p[:k]], own[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, l, r, n[lang], score) for i, (score, a, p, l, r) in enumerate(found[: s.first], 1)]
    return sorted(out)


def got(spark, rows, s):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    out = co.mine(df, s)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


def made(n, seed=0):
    rnd = random.Random(seed)
    vocabulary = ["The", "of", "la", "é", "日本", "x-1", "don't", " w", "new", "york", "city", "\U0001F600"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randrange(60)):
            words += rnd.choice([["new", "york", "city"], ["York"], ["as", "well", "as", "the", "other"], [rnd.choice(vocabulary)], [rnd.choice(vocabulary)]])
            if rnd.random() < 0.1:
                words[-1] += rnd.choice([".", ",", ";", "\n", "\v", "?!", "\t", " "])
        rows.append((" ".join(words), rnd.choice(["en", "en", "fr", None, ""])))
    return [*rows, (None, "en"), ("", "de"), (" .\n", None), ("la " * 3000, "en"), rows[0], rows[0]]


@pytest.mark.parametrize("s", [
    co.Settings(least=3, first=1500), co.Settings(least=8, first=20, budget=40, held=50), co.Settings(least=3, budget=5, percent=60),
    co.Settings(least=2, longest=3, first=7),
])
def test_phrases_equal_counting(spark, s):
    rows = made(90)
    assert got(spark, rows, s) == plain(rows, s)


def test_nothing(spark):
    assert got(spark, [], co.Settings()) == []
    assert got(spark, [(None, None), ("", "x"), ("a b", "x")], co.Settings()) == []


def test_ties_are_ranked_by_bytes(spark):
    rows = [(" . ".join([f"{w} end"] * 5), "x") for w in ("é", "z", "日", "\U0001F600", "a", "｡")]
    s = co.Settings(least=5, first=4)
    found = got(spark, rows, s)
    assert found == plain(rows, s) and [r[2] for r in sorted(found, key=lambda r: r[1])] == ["a end", "z end", "é end", "日 end"]


def test_scores_beyond_64_bits(spark):
    """Products of counts that no 64-bit number holds."""
    big = 9 * 10**13
    phrases = spark.createDataFrame([([1, 2], big)], "phrase array<long>, n long")
    words = spark.createDataFrame([(1, "x", big + 1), (2, "x", big + 3)], "word long, lang string, n long")
    totals = spark.createDataFrame([("x", 10**14)], "lang string, total long")
    row = co._scored(phrases, words, totals, co.Settings()).first()
    assert row.score == 1000 * big * 10**14 // ((big + 1) * (big + 3))


def test_places_above_the_budget_are_extended():
    first = np.zeros(1 << co.PLACE_BITS, np.int64)
    first[[0, 1, 2, 5]] = [3, 4, 100, 2]
    start, asked, depth, groups = co.vertical(first, first, 10)
    assert start[0] == start[1] == 0 and asked[2] == 10 and start[2] == 1 and start[5] == 11 and groups == 12
    assert depth[2] == 3 and depth[0] == 2


def test_nodes_are_sums_of_leaves():
    keys = np.array([[1, 2, 0], [1, 2, 3], [1, 2, 4], [2, 2, 0]], U)
    found = co.nodes(keys, np.array([1, 1, 1, 1]), np.array([5, 6, 7, 8]), 7)
    assert found == [([1, 2], 18), ([2, 2], 8), ([1, 2, 4], 7)]


def test_groups_of_rare_phrases_only(spark):
    """The filter of pairs lets some rare ones pass, and a group may have got no others."""
    s = co.Settings(longest=3, least=100)
    rows = []
    for part, own in enumerate([[((1, 2, 0), 99, 1)], [((3, 4, 0), 60, 1), ((3, 4, 5), 50, 1)], [((6, 7, 8), 99, 1)]]):
        rows.append((part, bytearray(np.array(own, co.suffix_type(s)).tobytes())))
    found = co._phrases(spark.createDataFrame(rows, "part int, packed binary"), s).collect()
    assert [(r.phrase, r.n) for r in found] == [([3, 4], 110)]
    assert co._phrases(spark.createDataFrame(rows[:1], "part int, packed binary"), s).collect() == []


def test_tables_of_phrases_are_not_broadcast(spark, monkeypatch):
    """Only words and languages may be; the default threshold lets Spark choose."""
    plans, settled = {}, co.settled

    def noted(df, name, *more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return settled(df, name, *more)

    monkeypatch.setattr(co, "settled", noted)
    s, rows = co.Settings(least=3, first=1500), made(30)
    assert got(spark, rows, s) == plain(rows, s)
    assert "SortMergeJoin" in plans["collocations"] and "Broadcast" not in plans["collocations"]
    keys = set(re.findall(r"(?:BroadcastHash|SortMerge)Join \[(\w+)#", plans["scored"]))
    assert keys == {"_l", "_r", "phrase", "word", "lang"}
    assert not set(re.findall(r"BroadcastHashJoin \[(\w+)#", plans["scored"])) - {"word", "lang"}


def test_batches_of_the_session_are_bounded(spark, docs):
    before = spark.conf.get(ARROW_LIMIT)
    spark.conf.set(ARROW_LIMIT, "64m")
    try:
        co.mine(docs.selectExpr("text", "'x' AS lang"), co.Settings(least=3))
        assert spark.conf.get(ARROW_LIMIT) == f"{ARROW_MB}m"
    finally:
        spark.conf.set(ARROW_LIMIT, before)
