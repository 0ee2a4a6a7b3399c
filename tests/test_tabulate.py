import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tallywell.operators import tabulate


@pytest.fixture(scope="module")
def survey(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["male", "female", "no_answer", None]), rng.choice(["kanto", "kinki"]),
             rng.choice([1, 2, 3, 4, 5, None]), rng.choice(["def_buy", "maybe", "no", None]),
             rng.choice(["under199", "350plus", "200_249", "odd"]),
             rng.choice([None, [], ["beer"], ["beer", "wine"], ["wine", "wine"]])) for i in range(400)]
    return spark.createDataFrame(
        rows, "id bigint, gender string, region string, satisfaction_int int, purchase_intent string, "
              "price_band string, drinks array<string>").cache()


def test_freq_single(survey):
    rows = tabulate.freq_single(survey, "gender").collect()
    assert math.isclose(sum(r.share for r in rows), 1) and sum(r.n for r in rows) == 400 and len(rows) == 4
    valid = tabulate.freq_single(survey, "gender", "valid").collect()
    assert {r.code for r in valid} == {"male", "female"} and math.isclose(sum(r.share for r in valid), 1)
    with pytest.raises(ValueError):
        tabulate.freq_single(survey, "gender", "some")


def test_freq_multi_counts_respondents(survey):
    asked = [r.drinks for r in survey.collect() if r.drinks is not None]
    got = {r.option: (r.n, r.share) for r in tabulate.freq_multi(survey, "drinks").collect()}
    for option in ("beer", "wine"):
        n = sum(option in d for d in asked)
        assert got[option] == (n, n / len(asked))
    assert set(got) == {"beer", "wine"}


def test_crosstab_shares(survey):
    rows = tabulate.crosstab(survey, "region", "gender").collect()
    assert math.isclose(sum(r.total_share for r in rows), 1)
    for region in ("kanto", "kinki"):
        assert math.isclose(sum(r.row_share for r in rows if r.region == region), 1)
    assert math.isclose(sum(r.col_share for r in rows if r.gender is None), 1)


def test_crosstab_multi(survey):
    data = survey.collect()
    for r in tabulate.crosstab_multi(survey, "drinks", "gender").collect():
        base = [d.drinks for d in data if d.drinks is not None and d.gender == r.gender]
        assert r.n == sum(r.option in d for d in base) and math.isclose(r.share, r.n / len(base))


def test_csat(survey):
    for r in tabulate.csat(survey, "region").collect():
        s = [d.satisfaction_int for d in survey.collect() if d.region == r.region and d.satisfaction_int]
        assert r.n == len(s) and math.isclose(r["mean"], sum(s) / len(s))
        assert math.isclose(r.top2, sum(x >= 4 for x in s) / len(s)) and math.isclose(r.bottom2, sum(x <= 2 for x in s) / len(s))


def test_subtotals(survey):
    cube = tabulate.subtotals(survey, ["gender", "region"], "cube").collect()
    assert [r.n for r in cube if r.gender_total and r.region_total] == [400]
    # A missing gender and the total over genders are told apart by the flag.
    assert len([r for r in cube if r.gender is None and r.region == "kanto"]) == 2
    rollup = tabulate.subtotals(survey, ["gender", "region"]).collect()
    assert not [r for r in rollup if r.gender_total and not r.region_total]
    sets = tabulate.subtotals(survey, ["gender", "region"], "sets", [["region"], []]).collect()
    assert len(sets) == 3
    with pytest.raises(ValueError):
        tabulate.subtotals(survey, ["gender"], "sets")


def test_purchase_rate(survey):
    for r in tabulate.purchase_rate(survey, "region").collect():
        s = [d.purchase_intent for d in survey.collect() if d.region == r.region and d.purchase_intent]
        assert math.isclose(r.def_rate, s.count("def_buy") / len(s))
        assert math.isclose(r.soft_rate, (s.count("def_buy") + s.count("maybe")) / len(s))


def test_price_acceptance_is_by_rank_not_by_letter(survey):
    found = tabulate.price_acceptance(survey).collect()
    rows = {(r.intent, r.band): r.cum_share for r in found}
    assert not [b for _, b in rows if b == "odd"] and len({b for _, b in rows}) == 5
    assert all(math.isclose(rows[r.intent, "under199"] + r.unlisted_share, 1) for r in found)
    assert rows["no", "350plus"] < rows["no", "200_249"] < rows["no", "under199"]


def test_price_acceptance_has_every_listed_band(spark):
    df = spark.createDataFrame([("no", "b"), ("no", "c"), ("no", "odd"), ("no", None), ("yes", None)], "purchase_intent string, price_band string")
    got = {(r.intent, r.band): (r.n, r.cum_share, r.unlisted_share) for r in tabulate.price_acceptance(df, ["a", "b", "c"]).collect()}
    third = 1 / 3
    assert got == {("no", "a"): (0, 2 * third, third), ("no", "b"): (1, 2 * third, third), ("no", "c"): (1, third, third),
                   ("yes", "a"): (0, None, None), ("yes", "b"): (0, None, None), ("yes", "c"): (0, None, None)}


def chi_square(pairs):
    a, b, n = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs}), len(pairs)
    chi2 = 0
    for x, y in itertools.product(a, b):
        e = sum(p[0] == x for p in pairs) * sum(p[1] == y for p in pairs) / n
        chi2 += (pairs.count((x, y)) - e) ** 2 / e
    return n, chi2, (len(a) - 1) * (len(b) - 1), math.sqrt(chi2 / (n * (min(len(a), len(b)) - 1)))


def test_association_with_empty_cells(spark):
    pairs = [("a", "x")] * 5 + [("a", "y")] * 3 + [("b", "y")] * 4 + [("c", "z")] * 2
    df = spark.createDataFrame(pairs + [(None, "x")], "p string, q string")
    got = tuple(tabulate.association(df, "p", "q").first())
    assert all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(got, chi_square(pairs)))


def test_association_of_one_code_has_no_v(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "p string, q string")
    assert tuple(tabulate.association(df, "p", "q").first()) == (2, 0.0, 0, None)


def test_pivot(survey):
    rows = tabulate.pivot_table(survey, "region", "purchase_intent", ["def_buy", "unsure"]).collect()
    assert all(r.unsure == 0 and r.def_buy > 0 for r in rows)


def test_pivot_counts_every_row(spark):
    df = spark.createDataFrame([("r", "0.00%"), ("r", "zzz"), ("r", None)], "region string, code string")
    assert tabulate.pivot_table(df, "region", "code", ["0.00%"]).first().asDict() == {
        "region": "r", "0.00%": 1, "(other)": 1, "(missing)": 1}


def test_segment_index(spark):
    df = spark.createDataFrame([("s", "a")] * 3 + [("s", "b")] + [("t", "b")] * 4 + [("t", None)], "seg string, lab string")
    got = [(r.segment, r.label, r.n, r.idx, r["rank"]) for r in tabulate.segment_index(df, "seg", "lab", 1).collect()]
    assert sorted(got) == [("s", "a", 3, 200.0, 1), ("t", "b", 4, 160.0, 1)]


def test_trend(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-03", "2024-01-03"]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d string, satisfaction_int int")
    df = df.select(F.col("d").cast("timestamp").alias("submitted_at"), "satisfaction_int")
    rows = tabulate.trend(df, "day", 1).orderBy("bucket").collect()
    assert [(r.n, r.mean_score, r.delta, r.ma) for r in rows] == [(1, 0.0, None, 1.0), (2, 1.5, 1, 1.5), (3, 4.0, 1, 2.5)]


def test_trend_has_empty_buckets(spark):
    df = spark.createDataFrame([(d, 4) for d in ("2024-01-01", "2024-01-02", "2024-01-09")], "d string, satisfaction_int int")
    df = df.select(F.col("d").cast("timestamp").alias("submitted_at"), "satisfaction_int")
    rows = tabulate.trend(df, "day", 1).orderBy("bucket").collect()
    assert [r.n for r in rows] == [1, 1, 0, 0, 0, 0, 0, 0, 1] and rows[-1].delta == 1 and rows[-1].ma == 0.5
    assert tabulate.trend(df.limit(0), "month").count() == 0
    with pytest.raises(ValueError):
        tabulate.trend(df, "second")


def test_valid_base_of_a_multi_answer(spark):
    df = spark.createDataFrame([(["a", "b"],), (["no_answer"],), ([],), (None,), (["a"],)], "o array<string>")
    got = {r.option: (r.n, r.share) for r in tabulate.freq_multi(df, "o", "valid").collect()}
    assert got == {"a": (2, 1.0), "b": (1, 0.5)}
