"""Every registered query: (spark, folder) -> DataFrame over the tables in that folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import answers as typed
from tallywell.functions.text import words
from tallywell.operators import labelling, long_lists, pairs, quality, ranges, relate, tabulate, wording
from tallywell.plans.adapters import (
    ANSWER_COLUMNS, NEGATIVE, POSITIVE, PRICE_CODES, PRICE_EDGES, SCENE, answers, arriving, comments,
    multi_answers, table, timeline,
)
from tallywell.schema import SURVEY_COMMENT, Rule
from tallywell.sources import dictionary, survey
from tallywell.sources.scratch import scratch_path, settled
from tallywell.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SECONDS = "yyyy-MM-dd HH:mm:ss"
SEGMENT_RULES = [
    Rule("gender", ("male", "female", "other")), Rule("purchase_intent", ("def_buy", "maybe")),
    Rule("price_band", tuple(PRICE_CODES[:3]), closed=False), Rule("satisfaction_int", low=2, high=4),
]
SEARCH_TERM = "thes"
GATE = 0.6


def query(f: Query) -> Query:
    """Register under the function's name, with the session in UTC as the jobs expect."""
    def in_utc(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, folder)

    QUERIES[f.__name__] = in_utc
    return f


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Sources, typing and checks

@query
def r01_scan_survey(spark, folder):
    df = survey.conform(answers(spark, folder, *ANSWER_COLUMNS))
    return df.select(*ANSWER_COLUMNS).withColumn("submitted_at", F.date_format("submitted_at", SECONDS))


@query
def r01_scan_survey_all(spark, folder):
    """All columns: written with lists and numbers held as text, scanned back, and listed as texts."""
    key = F.col("id")
    options = multi_answers(spark, folder).withColumnRenamed("options", "_o")
    df = answers(spark, folder, *ANSWER_COLUMNS).join(options, "id")
    as_json, as_text = F.to_json("_o"), F.array_join("_o", "、")
    stored = df.withColumns({
        "age_group": F.when(key % 3 == 0, "20s").otherwise("60plus"), "drinking_freq": F.lit("weekly"),
        "fav_alcohols_arr": F.col("_o"), "nonalc_freq": F.lit("sometimes"), "health_reasons_arr": F.slice("_o", 1, 1),
        "free_comment": F.concat(F.lit("No. "), key.cast("string")), "positive_point": as_json,
        "negative_feedback": as_text, "scene": F.when(key % 2 == 0, F.concat(as_json, F.lit(" junk"))).otherwise(as_json),
        "positive_point_category": F.lit("Aroma"), "negative_feedback_category": F.lit("ABV"),
        "positive_point_confidence": (key % 13 / 10).cast("decimal(3,1)").cast("string"),
        "negative_feedback_confidence": (key % 7 / 10).cast("decimal(3,1)").cast("string"),
    }).drop("_o")
    path = scratch_path(spark, "survey")
    survey.write_survey(stored, path)
    df = survey.scan_survey(spark, path)
    lists = [c for c, kind in df.dtypes if kind.startswith("array")]
    return df.withColumns({c: F.array_join(c, "|") for c in lists}).withColumn(
        "submitted_at", F.date_format("submitted_at", SECONDS))


@query
def r02_scan_dictionary(spark, folder):
    """Whole documents as dictionary comments: written as CSV with line breaks, then scanned."""
    docs = table(spark, folder, "documents")
    path = scratch_path(spark, "dictionary")
    dictionary.write_dictionary(docs.select(
        F.col("doc_id").cast("string").alias("column_name"), F.col("lang").alias("data_type"),
        F.col("text").alias("comment")), path)
    return dictionary.scan_dictionary(spark, path)


@query
def r03_export_dictionary(spark, folder):
    """Export the dictionary of a view, read it back, and check the whole view by its rules."""
    view = survey.conform(answers(spark, folder, *ANSWER_COLUMNS))
    name, path = "survey_answers_view", scratch_path(spark, "export")
    view.createOrReplaceTempView(name)
    dictionary.export_dictionary(spark, name, path, SURVEY_COMMENT)
    rules = dictionary.rules_of(dictionary.scan_dictionary(spark, f"{path}/columns"))
    return quality.check_domains(view, rules)


@query
def r03_export_rows(spark, folder):
    """The exported rows themselves, with the type each is read back as and what it holds in the data."""
    view = survey.conform(answers(spark, folder, *ANSWER_COLUMNS))
    name, path = "survey_answers_rows", scratch_path(spark, "export")
    view.createOrReplaceTempView(name)
    dictionary.export_dictionary(spark, name, path, SURVEY_COMMENT)
    entries = dictionary.scan_dictionary(spark, f"{path}/columns")
    read = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in dictionary.schema_of(entries)],
                                 "column_name string, read_type string")
    held = quality.completeness(view).select(F.col("column").alias("column_name"), "n")
    return entries.join(read, "column_name").join(held, "column_name").select("column_name", "data_type", "read_type", "n")


@query
def r04_type_submitted_at(spark, folder):
    key = F.col("o_orderkey")
    text = F.when(key % 10 == 0, "n/a").otherwise(F.date_format("o_orderdate", SECONDS))
    df = table(spark, folder, "orders").select(key.alias("id"), typed.to_submitted_at(text).alias("t"))
    return df.select("id", F.date_format("t", SECONDS).alias("submitted_at"),
                     F.unix_timestamp("t").alias("submitted_epoch"))


@query
def r05_type_boolean(spark, folder):
    key = F.col("o_orderkey")
    text = F.when(key % 10 == 0, "?").when(key % 2 == 0, " Yes").otherwise("no")
    return table(spark, folder, "orders").select(
        key.alias("id"), typed.to_boolean(text).alias("drives_weekly"))


@query
def r06_multi_select_to_array(spark, folder):
    text = multi_answers(spark, folder).select("id", F.array_join("options", ", ").alias("answers"))
    df = survey.multi_select_columns(text, {"options": "answers"})
    return df.select("id", F.size("options").cast("bigint").alias("n"),
                     F.array_join("options", "|").alias("options"))


@query
def r07_satisfaction_to_int(spark, folder):
    digit = F.substring("o_orderpriority", 1, 1)
    key = F.col("o_orderkey")
    text = F.when(key % 7 == 0, F.concat(digit, F.lit("0"))).when(
        key % 2 == 0, F.translate(digit, "12345", "１２３４５")).otherwise(F.concat(F.lit(" "), digit))
    return table(spark, folder, "orders").select(
        key.alias("id"), typed.to_satisfaction(text).alias("satisfaction_int"))


@query
def r08_band(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        typed.band(F.col("o_totalprice"), PRICE_EDGES, PRICE_CODES).alias("price_band"))


@query
def r08_band_table(spark, folder):
    """Bands from a table: 10,000 of them, every seventh of which is a gap."""
    low = F.col("id") * 50
    bands = spark.range(10_000).where("id % 7 <> 3").select(
        low.cast("double").alias("low"), (low + 50).cast("double").alias("high"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("code"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    return ranges.band_join(orders, F.col("o_totalprice"), bands, "price_band").select("id", "price_band")


@query
def r17_check_primary_key(spark, folder):
    return quality.check_primary_key(table(spark, folder, "lineitem"), "l_orderkey")


@query
def r18_check_domains(spark, folder):
    df = answers(spark, folder, "gender", "purchase_intent", "price_band", "satisfaction_int")
    return quality.check_domains(df, SEGMENT_RULES)


@query
def r18_check_raw_answers(spark, folder):
    """Times, booleans and scores as they come in: what typing would lose is listed."""
    key = F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1)
    raw = table(spark, folder, "orders").select(
        F.when(key % 10 == 0, "n/a").when(key % 10 == 1, "2024-13-01").otherwise(F.date_format("o_orderdate", SECONDS)).alias("submitted_at"),
        F.when(key % 10 == 2, "maybe so").when(key % 2 == 0, "Yes").otherwise("no").alias("drives_weekly"),
        F.when(key % 10 == 3, F.concat(digit, F.lit(".5"))).when(key % 10 == 4, F.concat(digit, F.lit(".0"))).when(
            key % 10 == 5, F.concat(digit, F.lit("0"))).otherwise(digit).alias("satisfaction_int"))
    return quality.check_domains(raw)


@query
def r19_reconcile_types(spark, folder):
    """Options as JSON, as separated text or cut off, by id; confidences from 0.00 to 1.29."""
    key = F.col("id")
    as_text = (F.when(key % 3 == 0, F.to_json("options"))
               .when(key % 3 == 1, F.array_join("options", "、"))
               .otherwise(F.concat(F.lit('["'), F.array_join("options", '","'))))
    number = F.concat((key % 130 / 100).cast("int").cast("string"), F.lit("."),
                      F.lpad((key % 100).cast("string"), 2, "0"))
    df = multi_answers(spark, folder).select("id", as_text.alias("options"), number.alias("confidence"))
    return survey.reconcile_types(df, ["options"], ["confidence"]).select(
        "id", F.array_join("options", "|").alias("options"), F.round("confidence", 6).alias("confidence"))


# Phrases, labels and confidences

def _phrases(spark, folder, lexicon):
    df = labelling.extract(comments(spark, folder), lexicon, "phrases")
    return df.select("id", F.size("phrases").cast("bigint").alias("n"),
                     F.array_join("phrases", " | ").alias("phrases"))


@query
def r09_extract_positive(spark, folder):
    return _phrases(spark, folder, POSITIVE)


@query
def r10_extract_negative(spark, folder):
    return _phrases(spark, folder, NEGATIVE)


@query
def r11_extract_scene(spark, folder):
    return _phrases(spark, folder, SCENE)


def labelled(spark, folder):
    """(id, segment) with the category and confidence of both polarities."""
    df = labelling.classify(comments(spark, folder), POSITIVE, "positive_point")
    return labelling.classify(df, NEGATIVE, "negative_feedback").drop("free_comment")


@query
def r12_classify_positive(spark, folder):
    df = labelling.classify(comments(spark, folder), POSITIVE, "positive_point")
    return df.select("id", "positive_point_category")


@query
def r12_classify_long_list(spark, folder):
    """The same labels from a list that is a table."""
    terms = spark.createDataFrame(POSITIVE.entries, long_lists.LIST_SCHEMA)
    df = long_lists.classify(comments(spark, folder), terms, "positive_point")
    return rounded(df.select("id", "positive_point_category", F.col("positive_point_confidence").alias("confidence")),
                   "confidence")


@query
def r09_extract_long_list(spark, folder):
    terms = spark.createDataFrame(POSITIVE.entries, long_lists.LIST_SCHEMA)
    df = long_lists.extract(comments(spark, folder), terms, "phrases")
    return df.select("id", F.size("phrases").cast("bigint").alias("n"),
                     F.array_join("phrases", " | ").alias("phrases"))


@query
def r16_feedback_rows_long_list(spark, folder):
    good, bad = (spark.createDataFrame(x.entries, long_lists.LIST_SCHEMA) for x in (POSITIVE, NEGATIVE))
    return long_lists.feedback_rows(comments(spark, folder), good, bad)


@query
def r13_classify_negative(spark, folder):
    df = labelling.classify(comments(spark, folder), NEGATIVE, "negative_feedback")
    return df.select("id", "negative_feedback_category")


@query
def r14_confidence_positive(spark, folder):
    df = labelling.classify(comments(spark, folder), POSITIVE, "positive_point")
    return rounded(df.select("id", "positive_point_confidence"), "positive_point_confidence")


@query
def r15_confidence_negative(spark, folder):
    df = labelling.classify(comments(spark, folder), NEGATIVE, "negative_feedback")
    return rounded(df.select("id", "negative_feedback_confidence"), "negative_feedback_confidence")


@query
def r15_enrich(spark, folder):
    """All derived comment columns from one search of each comment."""
    df = labelling.enrich(comments(spark, folder), POSITIVE, NEGATIVE, SCENE).drop("free_comment")
    lists = [c for c, kind in df.dtypes if kind.startswith("array")]
    return rounded(df.withColumns({c: F.array_join(c, " | ") for c in lists}),
                   "positive_point_confidence", "negative_feedback_confidence")


@query
def r16_feedback_rows(spark, folder):
    return labelling.feedback_rows(comments(spark, folder), POSITIVE, NEGATIVE)


@query
def r16_join_feedback(spark, folder):
    docs = comments(spark, folder)
    feedback = labelling.feedback_rows(docs, POSITIVE, NEGATIVE).drop("phrase")
    return relate.join_feedback(docs.select("id", "segment"), feedback, "inner")


@query
def r16_join_feedback_left(spark, folder):
    options = multi_answers(spark, folder).select("id", F.explode("options").alias("option"))
    return relate.join_feedback(answers(spark, folder, "id", "price_band"), options, "left")


@query
def r16_join_feedback_semi(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return relate.join_feedback(answers(spark, folder, "id", "price_band"), lines, "left_semi")


@query
def r16_join_feedback_anti(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return relate.join_feedback(answers(spark, folder, "id", "price_band"), lines, "left_anti")


# Tabulations

@query
def b01_freq_single(spark, folder):
    return rounded(tabulate.freq_single(answers(spark, folder, "region"), "region"), "share")


@query
def b01_freq_single_valid(spark, folder):
    return rounded(tabulate.freq_single(answers(spark, folder, "gender"), "gender", "valid"), "share")


@query
def b02_freq_multi(spark, folder):
    return rounded(tabulate.freq_multi(multi_answers(spark, folder), "options"), "share")


@query
def b03_crosstab(spark, folder):
    df = answers(spark, folder, "region", "price_band")
    return rounded(tabulate.crosstab(df, "region", "price_band"), "row_share", "col_share", "total_share")


@query
def b04_crosstab_multi(spark, folder):
    df = answers(spark, folder, "id", "price_band").join(multi_answers(spark, folder), "id", "left")
    return rounded(tabulate.crosstab_multi(df, "options", "price_band"), "share")


@query
def b05_csat(spark, folder):
    df = answers(spark, folder, "region", "satisfaction_int")
    return rounded(tabulate.csat(df, "region"), "mean", "sd", "top2", "bottom2")


SUBTOTAL_DIMS = ["region", "occupation", "purchase_intent"]


@query
def b05_csat_valid(spark, folder):
    df = answers(spark, folder, "gender", "satisfaction_int")
    return rounded(tabulate.csat(df, "gender", base="valid"), "mean", "sd", "top2", "bottom2")


@query
def b06_subtotals_rollup(spark, folder):
    return tabulate.subtotals(answers(spark, folder, *SUBTOTAL_DIMS), SUBTOTAL_DIMS, "rollup")


@query
def b06_subtotals_cube(spark, folder):
    return tabulate.subtotals(answers(spark, folder, *SUBTOTAL_DIMS), SUBTOTAL_DIMS, "cube")


@query
def b06_subtotals_sets(spark, folder):
    sets = [["region", "occupation"], ["purchase_intent"], []]
    return tabulate.subtotals(answers(spark, folder, *SUBTOTAL_DIMS), SUBTOTAL_DIMS, "sets", sets)


@query
def b07_purchase_rate(spark, folder):
    df = answers(spark, folder, "occupation", "purchase_intent")
    return rounded(tabulate.purchase_rate(df, "occupation"), "def_rate", "soft_rate")


@query
def b08_price_acceptance(spark, folder):
    df = answers(spark, folder, "purchase_intent", "price_band")
    return rounded(tabulate.price_acceptance(df, PRICE_CODES), "cum_share", "unlisted_share")


@query
def b08_price_acceptance_unlisted(spark, folder):
    """With the dearest band left out of the order and one that nobody chose."""
    df = answers(spark, folder, "purchase_intent", "price_band")
    order = ["free", *PRICE_CODES[:3]]
    return rounded(tabulate.price_acceptance(df, order), "cum_share", "unlisted_share")


@query
def b09_association(spark, folder):
    df = answers(spark, folder, "region", "price_band")
    return rounded(tabulate.association(df, "region", "price_band"), "chi2", "v")


@query
def b10_pivot_table(spark, folder):
    df = answers(spark, folder, "region", "price_band")
    return tabulate.pivot_table(df, "region", "price_band", PRICE_CODES)


@query
def b10_pivot_table_unlisted(spark, folder):
    df = answers(spark, folder, "region", "gender")
    return tabulate.pivot_table(df, "region", "gender", ["female", "0.00%"])


@query
def b11_category_balance(spark, folder):
    return rounded(labelling.category_balance(labelled(spark, folder)), "net")


def _positive(spark, folder):
    df = labelling.classify(comments(spark, folder), POSITIVE, "positive_point")
    return rounded(df, "positive_point_confidence")


@query
def b12_confidence_gate(spark, folder):
    return labelling.confident(_positive(spark, folder), GATE, "positive_point_confidence").drop("free_comment")


@query
def b12_review_queue(spark, folder):
    df = labelling.review_queue(_positive(spark, folder).drop("free_comment"), GATE, 25,
                                "positive_point_confidence")
    return df.select("id", "positive_point_category", "positive_point_confidence")


@query
def b13_segment_index(spark, folder):
    df = labelled(spark, folder)
    return tabulate.segment_index(df, "segment", "positive_point_category", 3)


@query
def b13_segment_index_all(spark, folder):
    """Every cell ranked: a k beyond what Spark cuts by itself."""
    return tabulate.segment_index(answers(spark, folder, "region", "price_band"), "region", "price_band", 5_000)


@query
def b17_distinctive_terms_many(spark, folder):
    return wording.distinctive_terms(comments(spark, folder), "segment", words(F.col("free_comment")), 2_000)


@query
def b13_segment_index_coded(spark, folder):
    return tabulate.segment_index(answers(spark, folder, "region", "price_band"), "region", "price_band", 2)


@query
def b14_co_occurrence(spark, folder):
    return rounded(pairs.co_occurrence(multi_answers(spark, folder), "options"),
                   "support", "confidence", "lift")


@query
def b14_co_occurrence_phrases(spark, folder):
    """Scene phrases named together in at least two documents."""
    # Written once, as the branches that count pairs would each search the comments again.
    df = settled(labelling.extract(comments(spark, folder), SCENE, "scene").select("scene"), "scene-phrases")
    return rounded(pairs.co_occurrence(df, "scene", min_n=2), "support", "confidence", "lift")


@query
def b15_phrase_topk(spark, folder):
    df = labelling.extract(comments(spark, folder), POSITIVE, "positive_point")
    return wording.phrase_topk(df, "positive_point", 50)


@query
def b15_phrase_topk_sketched(spark, folder):
    """The words of most comments, by a sketch of 6,000 words and a count of what it holds."""
    df = comments(spark, folder).select(words(F.col("free_comment")).alias("used"))
    return wording.phrase_topk_sketched(df, "used", 50, max_items=6_000)


@query
def b16_text_ngrams(spark, folder):
    return wording.ngram_counts(comments(spark, folder))


@query
def b17_distinctive_terms(spark, folder):
    df = comments(spark, folder)
    return wording.distinctive_terms(df, "segment", words(F.col("free_comment")), 10)


@query
def b18_trend(spark, folder):
    df = tabulate.trend(timeline(spark, folder), "week", 2, "label", score="value")
    return rounded(df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd")), "mean_score", "ma")


@query
def b18_trend_daily(spark, folder):
    df = tabulate.trend(timeline(spark, folder), "day", 6, score="value")
    return rounded(df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd")), "mean_score", "ma")


@query
def b19_driver_gap(spark, folder):
    df = answers(spark, folder, "occupation", "satisfaction_int")
    return rounded(relate.driver_gap(df, "occupation"), "gap", "t")


def _set_query(op):
    def run(spark, folder):
        lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), "l_partkey")
        parts = table(spark, folder, "part").select("p_partkey", "p_type")
        df = lines.join(parts, lines.l_partkey == parts.p_partkey)
        return relate.respondents_where(df, F.col("p_type") == "PROMO", F.col("p_type") == "ECONOMY", op)
    return run


for _op in ("and", "minus", "or"):
    _run = _set_query(_op)
    _run.__name__ = f"b20_respondent_sets_{_op}"
    query(_run)


@query
def b21_comment_search(spark, folder):
    df = wording.comment_search(comments(spark, folder), SEARCH_TERM)
    df = labelling.classify(df, POSITIVE, "positive_point")
    return df.select("id", F.col("positive_point_category").alias("label"), "snippet")


@query
def b21_best_examples(spark, folder):
    df = wording.comment_search(comments(spark, folder), SEARCH_TERM)
    df = rounded(labelling.classify(df, POSITIVE, "positive_point"), "positive_point_confidence")
    df = df.select("id", F.col("positive_point_category").alias("label"), "snippet", "positive_point_confidence")
    return wording.best_examples(df, 3, "label", "positive_point_confidence").drop("positive_point_confidence")


@query
def b22_completeness(spark, folder):
    df = survey.conform(answers(spark, folder, *ANSWER_COLUMNS))
    return rounded(quality.completeness(df), "null_rate", "empty_rate", "na_rate")


# Streams

def _run_stream(spark, stream, name):
    path = scratch_path(spark, name)
    return arrivals.run_available(stream, f"{path}/out", f"{path}/checkpoint")


@query
def s01_stream_dedupe(spark, folder):
    df = _run_stream(spark, arrivals.dedupe(arriving(spark, folder), "1 day"), "dedupe")
    return df.withColumn("submitted_at", F.date_format("submitted_at", SECONDS))


@query
def s02_stream_tally(spark, folder):
    stream = arrivals.tally(arrivals.dedupe(arriving(spark, folder), "1 day"), "label")
    df = _run_stream(spark, stream, "tally")
    return df.select(F.date_format("window_start", SECONDS).alias("window_start"), "label", "n")
