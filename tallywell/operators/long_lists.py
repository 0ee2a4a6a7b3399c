"""Term lists too long to be written into a query.

A list of up to ``search.MAX_CHARACTERS`` is read, sent to the tasks and searched for in one pass over the comments,
without an exchange. A longer one stays a table and is joined: the words of a comment that may be on the list are
counted in its task, kept apart by a filter of fixed size, and only those are exchanged.
The results equal those of an inline ``Lexicon`` with the same terms. Spark picks the kind of join by the measured size
of the list, and splits a term that fills a large part of the rows at run time. ``id`` has to be a key of the
comments, which ``quality.check_primary_key`` tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions.prefilter import likely, term_filter
from tallywell.functions.search import TermList, list_of, table_fits
from tallywell.functions.text import SENTENCE_END, char_ngrams, sentences, words
from tallywell.operators import labelling
from tallywell.operators.labelling import choose_label
from tallywell.schema import CATEGORIES

LIST_SCHEMA = "term string, label string, weight bigint"


def _sent(whole_words: bool, labels: Sequence[str], end: str, *tables: DataFrame) -> list[TermList] | None:
    """The lists, if each is small enough to be sent to the tasks; measured first."""
    if not all(table_fits(t) for t in tables):
        return None
    return [list_of(t, whole_words=whole_words, labels=tuple(labels), sentence_end=end) for t in tables]


def _sentences(df: DataFrame, key: str, text: str, end: str) -> DataFrame:
    """(key, no, phrase): the sentences of each comment, numbered in text order."""
    return df.select(F.col(key).alias("key"), F.posexplode(sentences(F.col(text), end)).alias("no", "phrase"))


def _word_hits(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, no, label, score), one row per entry of a distinct word of a sentence that is on the list."""
    counted = likely(term_filter(terms, "term"))
    found = rows.select("key", "no", F.inline(counted(words(F.col("phrase")))))
    return found.join(terms, "term").select("key", "no", "label", (F.col("weight").cast("bigint") * F.col("times")).alias("score"))


def _substring_hits(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """The same for terms found anywhere, longest first and without overlap.

    Every run of characters that is as long as some term is matched by equality. What is then gathered per sentence
    are the matches of that one sentence, which came from one row.
    """
    lengths = [r[0] for r in terms.select(F.length("term")).distinct().collect()]
    entries = terms.groupBy("term").agg(F.collect_list(F.struct("label", "weight")).alias("entries"))
    low = rows.select("key", "no", F.lower("phrase").alias("_s"))
    hits = low.select("key", "no", F.inline(F.concat(*[_runs(F.col("_s"), n) for n in sorted(lengths)]))).join(entries, "term")
    found = hits.groupBy("key", "no").agg(F.array_sort(F.collect_list(
        F.struct("at", (-F.col("len")).alias("back"), "entries"))).alias("hits"))
    return found.select("key", "no", F.inline(_without_overlap(F.col("hits")))).select(
        "key", "no", "label", F.col("weight").cast("bigint").alias("score"))


def _hits(rows: DataFrame, terms: DataFrame, whole_words: bool) -> DataFrame:
    return (_word_hits if whole_words else _substring_hits)(rows, terms)


def classify(
    df: DataFrame, terms: DataFrame, out: str, id: str = "id", text: str = "free_comment", whole_words: bool = True,
    labels: Sequence[str] = tuple(CATEGORIES), sentence_end: str = SENTENCE_END,
) -> DataFrame:
    """``df`` with ``{out}_category`` and ``{out}_confidence``, NULL without a hit."""
    short = _sent(whole_words, labels, sentence_end, terms)
    if short:
        return labelling.classify(df, short[0], out, text)
    hits = _hits(_sentences(df, id, text, sentence_end), terms, whole_words)
    chosen = choose_label(hits.select(F.col("key").alias("id"), "label", "score"), labels).select(
        F.col("id").alias(id), F.col("category").alias(f"{out}_category"), F.col("confidence").alias(f"{out}_confidence"))
    return df.join(chosen, id, "left")


def extract(
    df: DataFrame, terms: DataFrame, out: str, id: str = "id", text: str = "free_comment", whole_words: bool = True,
    sentence_end: str = SENTENCE_END,
) -> DataFrame:
    """``df`` with the distinct sentences that hold a term, in text order, as an array; a missing comment has NULL."""
    short = _sent(whole_words, tuple(CATEGORIES), sentence_end, terms)
    if short:
        return labelling.extract(df, short[0], out, text)
    rows = _sentences(df, id, text, sentence_end)
    places = _hits(rows, terms, whole_words).select("key", "no").distinct()
    found = rows.join(places, ["key", "no"]).groupBy("key").agg(F.array_distinct(F.transform(
        F.array_sort(F.collect_list(F.struct("no", "phrase"))), lambda p: p["phrase"])).alias(out))
    none = F.when(F.col(text).isNotNull(), F.array().cast("array<string>"))
    found = found.select(F.col("key").alias(id), F.col(out).alias("_found"))
    return df.join(found, id, "left").select(*[F.col(c) for c in df.columns], F.coalesce("_found", none).alias(out))


def feedback_rows(
    df: DataFrame, positive: DataFrame, negative: DataFrame, id: str = "id", text: str = "free_comment",
    whole_words: bool = True, labels: Sequence[str] = tuple(CATEGORIES), sentence_end: str = SENTENCE_END,
) -> DataFrame:
    """The long form of ``labelling.feedback_rows``: (id, polarity, phrase_no, phrase, label, score)."""
    short = _sent(whole_words, labels, sentence_end, positive, negative)
    if short:
        return labelling.feedback_rows(df, short[0], short[1], id, text)
    rows = _sentences(df, id, text, sentence_end)
    number = {label: i for i, label in enumerate(labels)}

    def one(terms: DataFrame, polarity: int) -> DataFrame:
        # A sentence that only terms without a label hold is a phrase without one.
        summed = _hits(rows, terms, whole_words).groupBy("key", "no", "label").agg(F.sum("score").alias("score"))
        place = F.coalesce(*[F.when(F.col("label") == label, -i) for label, i in number.items()])
        best = F.max(F.when(place.isNotNull(), F.struct("score", place.alias("place"), "label")))
        return summed.groupBy("key", "no").agg(best.alias("best")).select(F.lit(polarity).alias("polarity"), "key", "no", "best")

    named = one(positive, 1).union(one(negative, -1)).join(rows, ["key", "no"])
    by_comment = named.groupBy("key", "polarity").agg(F.array_sort(F.collect_list(
        F.struct("no", "phrase", F.col("best.label").alias("label"), F.col("best.score").alias("score")))).alias("all"))
    return by_comment.select(F.col("key").alias("id"), "polarity", F.posexplode("all").alias("_i", "x")).select(
        "id", "polarity", (F.col("_i") + 1).alias("phrase_no"), "x.phrase", "x.label", "x.score")


def _runs(sentence: Column, n: int) -> Column:
    return F.transform(char_ngrams(sentence, n), lambda run, i: F.struct(
        i.alias("at"), F.lit(n).alias("len"), run.alias("term")))


def _without_overlap(hits: Column) -> Column:
    """Walk the hits of a sentence from left to right and keep those that start after the last one."""
    start = F.struct(F.lit(0).alias("free"),
                     F.slice(hits[0]["entries"], 1, 0).alias("kept"))
    step = lambda acc, h: F.when(
        h["at"] >= acc["free"],
        F.struct((h["at"] - h["back"]).alias("free"), F.concat(acc["kept"], h["entries"]).alias("kept")),
    ).otherwise(acc)
    return F.aggregate(hits, start, step, lambda acc: acc["kept"])
