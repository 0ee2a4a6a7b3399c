import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallywell.operators import pairs, relate


def test_join_kinds(spark):
    survey = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, s string")
    feedback = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (9, "q")], "id bigint, f string")
    rows = lambda how: sorted(tuple(r) for r in relate.join_feedback(survey, feedback, how).collect())
    assert rows("inner") == [(1, "a", "x"), (1, "a", "y"), (3, "c", "z")]
    assert rows("left") == [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (3, "c", "z")]
    assert rows("left_semi") == [(1, "a"), (3, "c")]
    assert rows("left_anti") == [(2, "b")]
    with pytest.raises(ValueError):
        rows("cross")


def test_respondent_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    b = spark.createDataFrame([(2,), (3,), (3,)], "id bigint")
    ids = lambda op: sorted(r.id for r in relate.respondent_sets(a, b, op).collect())
    assert (ids("and"), ids("minus"), ids("or")) == ([2], [1], [1, 2, 3])
    with pytest.raises(ValueError):
        ids("xor")


def test_driver_gap(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, 4, 5, None])) for _ in range(200)]
    df = spark.createDataFrame(data, "label string, satisfaction_int int")
    got = {r.label: r for r in relate.driver_gap(df, "label").collect()}
    assert set(got) == {"a", "b"}
    for label, r in got.items():
        x = [s for lab, s in data if lab == label and s]
        y = [s for lab, s in data if lab != label and s]
        gap = statistics.mean(x) - statistics.mean(y)
        t = gap / math.sqrt(statistics.variance(x) / len(x) + statistics.variance(y) / len(y))
        assert (r.n1, r.n0) == (len(x), len(y)) and math.isclose(r.gap, gap) and math.isclose(r.t, t)


def test_driver_gap_without_a_rest(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4)], "label string, satisfaction_int int")
    assert tuple(relate.driver_gap(df, "label").first()) == ("a", 2, 0, None, None)


def pairs_by_hand(rows, min_n):
    sets = [set(o for o in r if o is not None) for r in rows if r is not None]
    n = {}
    for s in sets:
        for pair in itertools.combinations(sorted(s), 2):
            n[pair] = n.get(pair, 0) + 1
    single = lambda o: sum(o in s for s in sets)
    return {p: (k, k / len(sets), k / single(p[0]), k * len(sets) / (single(p[0]) * single(p[1])))
            for p, k in n.items() if k >= min_n}


@pytest.mark.parametrize("min_n", [1, 2, 3, 5])
@pytest.mark.parametrize("wide", [2, 4, 64])
def test_co_occurrence_against_brute_force(spark, min_n, wide):
    rng = random.Random(10 * min_n + wide)
    letters = [f"o{i:02d}" for i in range(25)]
    rows = [None, [], ["o00"], ["o00", "o00", None]]
    rows += [rng.sample(letters, rng.randint(0, 3)) for _ in range(60)]
    rows += [rng.sample(letters, k) for k in (25, 25, 20, 18, 9, 8, 7, 6, 5, 5)]
    rows += [list(rows[-1])] * 2                               # an equal wide answer, weight 3
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id bigint, arr array<string>").repartition(4)
    got = {(r.a, r.b): (r.n, r.support, r.confidence, r.lift)
           for r in pairs.co_occurrence(df, "arr", min_n, block=wide).collect()}
    want = pairs_by_hand(rows, min_n)
    assert set(got) == set(want)
    for pair in want:
        assert all(math.isclose(x, y) for x, y in zip(got[pair], want[pair]))


def test_co_occurrence_with_missing_and_repeated_ids(spark):
    rows = [(None, ["a", "b"]), (None, ["c", "d"]), (7, ["a", "e"]), (7, ["c", "f"]), (8, ["a", "b"])]
    df = spark.createDataFrame(rows, "id bigint, arr array<string>")
    got = {(r.a, r.b): r.n for r in pairs.co_occurrence(df, "arr").collect()}
    assert got == {("a", "b"): 2, ("c", "d"): 1, ("a", "e"): 1, ("c", "f"): 1}


def test_respondents_of_one_table(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, None), (3, "y"), (4, "z")], "id int, t string")
    ids = lambda op: sorted(r.id for r in relate.respondents_where(df, F.col("t") == "x", F.col("t") == "y", op).collect())
    assert ids("and") == [1] and ids("minus") == [2] and ids("or") == [1, 2, 3]
