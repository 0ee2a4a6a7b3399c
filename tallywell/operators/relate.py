"""Jobs that relate tables, respondents and answers to each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_feedback(
    survey: DataFrame, feedback: DataFrame, how: str = "inner", id: str = "id"
) -> DataFrame:
    """Responses with their feedback rows; ``how`` is inner, left, left_semi or left_anti.

    One response may own a large part of the feedback. The inner join can be split on either side
    at run time. The others would need all feedback of an id in one task, so they look at distinct
    ids only, which are collapsed before the exchange.
    """
    ids = feedback.select(id).distinct()
    if how == "inner":
        return survey.join(feedback, id, "inner")
    if how in ("left_semi", "left_anti"):
        return survey.join(ids, id, how)
    if how == "left":
        alone = survey.join(ids, id, "left_anti")
        return survey.join(feedback, id, "inner").unionByName(alone, allowMissingColumns=True)
    raise ValueError(f"join kind {how!r} is not supported")


def respondent_sets(a: DataFrame, b: DataFrame, op: str, id: str = "id") -> DataFrame:
    """Distinct ids of both (and), of a alone (minus) or of either (or), from one grouping of both sides."""
    tagged = a.select(id, F.lit(True).alias("_a")).union(b.select(id, F.lit(False)))
    return respondents_where(tagged, F.col("_a"), ~F.col("_a"), op, id)


def respondents_where(df: DataFrame, a: Column, b: Column, op: str, id: str = "id") -> DataFrame:
    """The same for the rows of one table, read once, where ``a`` holds and where ``b`` holds."""
    keep = {"and": F.col("_in_a") & F.col("_in_b"), "minus": F.col("_in_a") & ~F.col("_in_b"), "or": F.lit(True)}
    if op not in keep:
        raise ValueError(f"op is 'and', 'minus' or 'or', not {op!r}")
    sides = df.filter(a | b).groupBy(id).agg(
        F.coalesce(F.bool_or(a), F.lit(False)).alias("_in_a"), F.coalesce(F.bool_or(b), F.lit(False)).alias("_in_b"))
    return sides.filter(keep[op] & F.col(id).isNotNull() if op == "and" else keep[op]).select(id)


def driver_gap(
    df: DataFrame, label: str, score: str = "satisfaction_int"
) -> DataFrame:
    """(label, n1, n0, gap, t): mean score with the label minus without it, and Welch's t.

    Scores are whole numbers, so sums and sums of squares are exact, and the responses without a
    label are the total less those with it: one grouped pass and one small total.
    """
    s = F.col(score).cast("bigint")
    groups = df.filter(s.isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(s).alias("n"), F.sum(s).alias("s"), F.sum(s * s).alias("q"),
        F.count(label).alias("labelled"))
    # A filter on the count of labels stays above the grouping, so both readers share its exchange.
    total = groups.agg(F.struct(*[F.sum(c).alias(c) for c in ("n", "s", "q", "labelled")])).scalar()

    def mean_and_error(n: Column, s: Column, q: Column) -> tuple[Column, Column]:
        mean = F.try_divide(s, n)
        variance = F.when(n > 1, F.try_divide(q - F.try_divide(s * s, n), n - 1))
        return mean, F.try_divide(variance, n)

    as_double = lambda c: c.cast("double")
    rest = groups.filter(F.col("labelled") > 0).withColumn("_t", total).select(
        "label", *[as_double(F.col(c)).alias(f"{c}1") for c in ("n", "s", "q")],
        *[as_double(F.col(f"_t.{c}") - F.col(c)).alias(f"{c}0") for c in ("n", "s", "q")],
    )
    mean1, error1 = mean_and_error(F.col("n1"), F.col("s1"), F.col("q1"))
    mean0, error0 = mean_and_error(F.col("n0"), F.col("s0"), F.col("q0"))
    return rest.select(
        "label", F.col("n1").cast("bigint").alias("n1"), F.col("n0").cast("bigint").alias("n0"),
        (mean1 - mean0).alias("gap"),
        F.try_divide(mean1 - mean0, F.sqrt(error1 + error0)).alias("t"),
    )
