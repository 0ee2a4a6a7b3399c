"""Phrases, category labels and confidences from free comments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions.lexicon import Lexicon, best_label, once, score_array
from tallywell.functions.search import TermList, finder, label_scores, of_list
from tallywell.functions.text import sentences
from tallywell.schema import CATEGORIES


Terms = Lexicon | TermList


def searched(df: DataFrame, lists: Sequence[Terms], text: str = "free_comment") -> DataFrame:
    """Add ``_sentences`` and ``_found``, what one search for all lists finds in them."""
    if len({x.sentence_end for x in lists}) > 1:
        raise ValueError("lists of one search end sentences alike")
    tables = [x if isinstance(x, TermList) else TermList(x.entries, x.whole_words, x.labels, x.sentence_end) for x in lists]
    search = finder(df.sparkSession, tables)
    df = once(df, _sentences=sentences(F.col(text), lists[0].sentence_end))
    found = df.withColumn("_hits", search(F.transform("_sentences", F.lower)))
    return once(found, _found=F.col("_hits")).drop("_hits")


def _phrases(number: int) -> Column:
    """The distinct sentences with a hit of a list, in text order."""
    places = F.transform(of_list(F.col("_found"), number, whole=False), lambda x: x["no"])
    return F.array_distinct(F.transform(places, lambda no: F.get("_sentences", no)))


def extract(df: DataFrame, lexicon: Terms, out: str, text: str = "free_comment") -> DataFrame:
    """Add the distinct sentences that hold a term, in text order, as an array."""
    found = searched(df, [lexicon], text)
    return found.select(*[F.col(c) for c in df.columns], _phrases(0).alias(out))


def classify(df: DataFrame, lexicon: Terms, out: str, text: str = "free_comment") -> DataFrame:
    """Add ``{out}_category`` and ``{out}_confidence``; both are NULL without a hit.

    A narrow projection: no join and no exchange. A short list is matched inside the JVM, a ``TermList`` by ``searched``.
    """
    columns = [F.col(c) for c in df.columns]
    if isinstance(lexicon, TermList):
        found = searched(df, [lexicon], text)
        scored = _scored(found, label_scores(of_list(F.col("_found"), 0, whole=True), lexicon.labels))
    else:
        df = df.withColumn("_hits", lexicon.hits(F.col(text)))
        scored = _scored(df, lexicon.scores(F.col("_hits")))
    return scored.select(
        *columns,
        F.col("_best.label").alias(f"{out}_category"),
        F.col("_best.confidence").alias(f"{out}_confidence"),
    )


def _scored(df: DataFrame, scores: Column) -> DataFrame:
    """Add the ``_best`` label. Scores are a column of their own, as they are read several times."""
    return once(df.withColumn("_scores", scores), _best=best_label(F.col("_scores")))


def enrich(
    df: DataFrame, positive: Terms, negative: Terms, scene: Terms, text: str = "free_comment"
) -> DataFrame:
    """All derived comment columns of the survey table from one search of each comment."""
    names = ("positive_point", "negative_feedback", "scene")
    found = searched(df, (positive, negative, scene), text)
    scored = found.withColumns({f"_s{i}": label_scores(of_list(F.col("_found"), i, whole=True), x.labels)
                                for i, x in enumerate((positive, negative))})
    best = once(scored, _b0=best_label(F.col("_s0")), _b1=best_label(F.col("_s1")))
    return best.select(
        *[F.col(c) for c in df.columns], *[_phrases(i).alias(name) for i, name in enumerate(names)],
        *[F.col(f"_b{i}.{field}").alias(f"{name}_{column}") for i, name in enumerate(names[:2])
          for field, column in (("label", "category"), ("confidence", "confidence"))])


def feedback_rows(
    df: DataFrame, positive: Terms, negative: Terms, id: str = "id", text: str = "free_comment"
) -> DataFrame:
    """The long form: one row per phrase and polarity, repeated phrases kept.

    (id, polarity 1 / -1, phrase_no in text order, phrase, label, score of that label)
    """
    def numbered(number: int, polarity: int, labels: Sequence[str]) -> Column:
        names = F.array(*[F.lit(x) for x in labels])
        return F.transform(of_list(F.col("_found"), number, whole=False), lambda x, i: F.struct(
            F.lit(polarity).alias("polarity"), (i + 1).alias("phrase_no"), F.get("_sentences", x["no"]).alias("phrase"),
            F.when(x["label"] >= 0, F.get(names, x["label"])).alias("label"),
            F.when(x["label"] >= 0, x["score"]).alias("score")))

    found = searched(df.select(F.col(id).alias("id"), F.col(text).alias("_text")), (positive, negative), "_text")
    return found.select("id", F.inline(F.concat(numbered(0, 1, positive.labels), numbered(1, -1, negative.labels))))


def choose_label(scores: DataFrame, labels: Sequence[str] = tuple(CATEGORIES)) -> DataFrame:
    """(id, label, score) rows to (id, category, confidence), one row per id.

    One conditional sum per label keeps this at a single exchange of pre-summed rows, and the top
    label is then found inside the row. A label outside ``labels`` does not count.
    """
    sums = [F.sum(F.when(F.col("label") == label, F.col("score"))).alias(f"_s{i}")
            for i, label in enumerate(labels)]
    columns = {label: F.coalesce(F.col(f"_s{i}"), F.lit(0)) for i, label in enumerate(labels)}
    return (
        scores.groupBy("id").agg(*sums)
        .select("id", score_array(columns, labels).alias("_scores"))
        .select("id", best_label(F.col("_scores")).alias("_best"))
        .select("id", F.col("_best.label").alias("category"),
                F.col("_best.confidence").alias("confidence"))
    )


def classify_with(
    df: DataFrame, scorer: Callable[[DataFrame], DataFrame], id: str = "id",
    text: str = "free_comment",
) -> DataFrame:
    """Label by a user's model: ``scorer`` takes (id, text) and gives (id, label, score).

    A scorer is usually a ``mapInPandas`` call, which moves Arrow batches, not rows.
    """
    return choose_label(scorer(df.select(F.col(id).alias("id"), F.col(text).alias("text"))))


def category_balance(
    df: DataFrame, labels: Sequence[str] = tuple(CATEGORIES),
    positive: str = "positive_point_category", negative: str = "negative_feedback_category",
) -> DataFrame:
    """(label_no, label, pos, neg, net) for every label of the list, also those with no rows.

    Both polarities are counted as 2 * len(labels) conditional counts of one pass, so that only
    one row per task is exchanged.
    """
    counted = df.agg(F.array(*[
        F.struct(
            F.lit(i).alias("label_no"), F.lit(label).alias("label"),
            F.count_if(F.col(positive) == label).alias("pos"),
            F.count_if(F.col(negative) == label).alias("neg"),
        )
        for i, label in enumerate(labels, 1)
    ]).alias("_rows"))
    pos, neg = F.col("pos"), F.col("neg")
    return (
        counted.select(F.inline("_rows"))
        .withColumn("net", F.try_divide((pos - neg).cast("double"), (pos + neg).cast("double")))
    )


def confident(df: DataFrame, threshold: float, confidence: str) -> DataFrame:
    """Rows whose label is at least that sure."""
    return df.filter(F.col(confidence) >= threshold)


def review_queue(
    df: DataFrame, threshold: float, k: int, confidence: str, id: str = "id"
) -> DataFrame:
    """The k least sure rows below the threshold; a distributed top-k, not a full sort."""
    return df.filter(F.col(confidence) < threshold).orderBy(confidence, id).limit(k)
