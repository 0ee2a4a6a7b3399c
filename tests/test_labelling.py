import pytest
from pyspark.sql import functions as F

from tallywell.functions.lexicon import Lexicon, MAX_INLINE_TERMS
from tallywell.functions.text import JAPANESE_SENTENCE_END
from tallywell.operators import labelling, long_lists
from tallywell.schema import CATEGORIES

GOOD = Lexicon.of([("泡", "Appearance", 1), ("香り", "Aroma", 2), ("味", "Flavor", 1), ("後味", "DrinkabilityAftertaste", 2)],
                  whole_words=False)
BAD = Lexicon.of([("薄い", "Flavor", 1), ("高い", "PriceValue", 1)], whole_words=False)
SCENE = Lexicon.of_terms(["風呂", "昼"], whole_words=False)
TEXTS = [
    "泡が良い。味が薄い。缶が好き！",       # Appearance and Flavor tie
    "後味が良い。香りも。",                 # the longer term wins over 味
    "何もない。",
    "",
    None,
    "泡。泡。昼に飲む。高い😀香り",
]


@pytest.fixture(scope="module")
def comments(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)], "id bigint, free_comment string").cache()


def by_id(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_extract_keeps_text_order_and_drops_repeats(comments):
    got = by_id(labelling.extract(comments, GOOD, "p"), "p")
    assert got == {0: (["泡が良い", "味が薄い"],), 1: (["後味が良い", "香りも"],), 2: ([],), 3: ([],), 4: (None,),
                   5: (["泡", "高い😀香り"],)}


def test_classify(comments):
    got = by_id(labelling.classify(comments, GOOD, "p"), "p_category", "p_confidence")
    assert got[0] == ("Appearance", 0.5)                     # tie: the lower label number
    assert got[1] == ("Aroma", 0.5)                          # 香り 2, 後味 2, and no 味 inside 後味
    assert got[2] == got[3] == got[4] == (None, None)
    assert got[5] == ("Appearance", 0.5)


def test_classify_keeps_other_columns_and_filters_push_past_it(comments):
    df = labelling.classify(comments.withColumn("x", F.lit(1)), GOOD, "p")
    assert df.columns == ["id", "free_comment", "x", "p_category", "p_confidence"]
    assert df.filter("p_confidence > 0.4 AND id > 0").count() == 2


def test_enrich(comments):
    df = labelling.enrich(comments, GOOD, BAD, SCENE)
    r = df.filter("id = 5").first()
    assert (r.scene, r.negative_feedback, r.negative_feedback_category, r.negative_feedback_confidence) == (
        ["昼に飲む"], ["高い😀香り"], "PriceValue", 1.0)


def test_feedback_rows(comments):
    rows = labelling.feedback_rows(comments, GOOD, BAD).filter("id = 5").collect()
    assert sorted((r.polarity, r.phrase_no, r.phrase, r.label, r.score) for r in rows) == [
        (-1, 1, "高い😀香り", "PriceValue", 1),
        (1, 1, "泡", "Appearance", 1), (1, 2, "泡", "Appearance", 1), (1, 3, "高い😀香り", "Aroma", 2)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_long_list_of_substrings_equals_inline(spark, comments):
    table = spark.createDataFrame(GOOD.entries, long_lists.LIST_SCHEMA)
    bad = spark.createDataFrame(BAD.entries, long_lists.LIST_SCHEMA)
    assert rows_of(long_lists.classify(comments, table, "p", whole_words=False)) == rows_of(labelling.classify(comments, GOOD, "p"))
    assert rows_of(long_lists.extract(comments, table, "p", whole_words=False)) == rows_of(labelling.extract(comments, GOOD, "p"))
    assert rows_of(long_lists.feedback_rows(comments, table, bad, whole_words=False)) == rows_of(labelling.feedback_rows(comments, GOOD, BAD))


def test_long_list_of_words_equals_inline(spark):
    words = Lexicon.of([("the", "Aroma", 1), ("é", "Flavor", 2), ("then", "ABV", 1)])
    texts = ["The then the", "é é. other", "thethe", None, "then é", "", "the. the. Then"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id bigint, free_comment string")
    table = spark.createDataFrame(words.entries, long_lists.LIST_SCHEMA)
    assert rows_of(long_lists.classify(df, table, "p")) == rows_of(labelling.classify(df, words, "p"))
    assert rows_of(long_lists.extract(df, table, "p")) == rows_of(labelling.extract(df, words, "p"))
    assert rows_of(long_lists.feedback_rows(df, table, table)) == rows_of(labelling.feedback_rows(df, words, words))


def test_a_table_with_very_many_labels_is_read_whole(spark):
    labels = tuple(f"l{i}" for i in range(30))
    entries = [(f"t{i}", lab, 1) for i in range(400) for lab in labels]
    table = spark.createDataFrame(entries, long_lists.LIST_SCHEMA)
    assert len(Lexicon.from_table(table, labels=labels).entries) == 12_000


def test_a_number_with_a_point_stays_whole_with_japanese_sentence_ends(spark):
    abv = Lexicon.of([("0.00%", "ABV", 1)], whole_words=False, sentence_end=JAPANESE_SENTENCE_END)
    df = spark.createDataFrame([(1, "0.00%なのに旨い。また買う。")], "id bigint, free_comment string")
    df = labelling.classify(labelling.extract(df, abv, "p"), abv, "p")
    assert by_id(df, "p", "p_category") == {1: (["0.00%なのに旨い"], "ABV")}
    with pytest.raises(ValueError):
        Lexicon.of([("0.00%", "ABV", 1)], whole_words=False)


def test_a_term_may_score_for_two_labels(spark):
    both = Lexicon.of([("x", "Aroma", 1), ("x", "Flavor", 3)])
    df = spark.createDataFrame([(1, "x x")], "id bigint, free_comment string")
    assert by_id(labelling.classify(df, both, "p"), "p_category", "p_confidence") == {1: ("Flavor", 0.75)}


def test_scorer_hook_with_arrow_batches(spark, comments):
    def model(df):
        def score(batches):
            for pdf in batches:
                pdf = pdf[pdf.text.fillna("").str.contains("泡")]
                yield pdf.assign(label="Appearance", score=2.0)[["id", "label", "score"]]
                yield pdf.assign(label="Flavor", score=0.5)[["id", "label", "score"]]
        return df.mapInPandas(score, "id bigint, label string, score double")

    got = by_id(labelling.classify_with(comments, model), "category", "confidence")
    assert got == {0: ("Appearance", 0.8), 5: ("Appearance", 0.8)}


def test_choose_label_ignores_unknown_labels(spark):
    df = spark.createDataFrame([(1, "Nope", 9), (1, "ABV", 1), (2, "Nope", 9)], "id bigint, label string, score bigint")
    assert by_id(labelling.choose_label(df), "category", "confidence") == {1: ("ABV", 1.0), 2: (None, None)}


def test_balance_has_every_label(comments):
    df = labelling.category_balance(labelling.enrich(comments, GOOD, BAD, SCENE))
    rows = {r.label: (r.pos, r.neg, r.net) for r in df.collect()}
    assert list(rows) == CATEGORIES
    assert rows["Appearance"] == (2, 0, 1.0) and rows["PriceValue"] == (0, 1, -1.0) and rows["ABV"] == (0, 0, None)


def test_gate_and_queue(spark):
    df = spark.createDataFrame([(3, 0.2), (1, 0.2), (2, 0.1), (4, 0.9), (5, None)], "id int, c double")
    assert [r.id for r in labelling.confident(df, 0.5, "c").collect()] == [4]
    assert [r.id for r in labelling.review_queue(df, 0.5, 2, "c").collect()] == [2, 1]


def test_lexicon_refuses_bad_entries(spark):
    for entries in ([], [("", "Aroma", 1)], [("Abc", "Aroma", 1)], [("a", "Smell", 1)], [("a", "Aroma", 0)],
                    [("a", "Aroma", 1), ("a", "Aroma", 2)]):
        with pytest.raises(ValueError):
            Lexicon.of(entries)
    with pytest.raises(ValueError):
        Lexicon.of_terms([f"t{i}" for i in range(MAX_INLINE_TERMS + 1)])
    table = spark.createDataFrame([("a.b", "Aroma", 1)], long_lists.LIST_SCHEMA)
    df = spark.createDataFrame([(1, "axb"), (2, "a.b")], "id bigint, free_comment string")
    got = by_id(labelling.classify(df, Lexicon.from_table(table, whole_words=False, sentence_end=JAPANESE_SENTENCE_END), "p"), "p_category")
    assert got == {1: (None,), 2: ("Aroma",)}
