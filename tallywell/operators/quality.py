"""Checks: the key, the code lists and ranges, and how complete each column is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions.answers import is_damaged_list, strip, to_boolean, to_number, to_satisfaction, to_submitted_at
from tallywell.functions.answers import whole_number
from tallywell.schema import NO_ANSWER, SURVEY_RULES, Rule


def check_primary_key(df: DataFrame, id: str = "id") -> DataFrame:
    """(id, n) for every id that is NULL or occurs more than once."""
    return (
        df.groupBy(F.col(id).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) | F.col("id").isNull())
    )


def _finding(rule: Rule, dtype: T.DataType) -> Column | None:
    value = F.col(rule.column)
    if rule.codes:
        kind, bad = "violation" if rule.closed else "unlisted", ~value.isin(*rule.codes)
    elif rule.text_list:
        if not isinstance(dtype, T.StringType):
            return None
        kind, bad = "damaged", is_damaged_list(value)
    elif rule.typed:
        if not isinstance(dtype, T.StringType):
            return None
        kind = "unreadable"
        bad = value.isNotNull() & {"timestamp": to_submitted_at, "boolean": to_boolean}[rule.typed](value).isNull()
    else:
        # The same functions as those that type a column, so what typing loses is a finding.
        if isinstance(dtype, T.StringType):
            number = to_satisfaction(value, rule.low, rule.high) if rule.whole else to_number(value, rule.low, rule.high)
        elif rule.whole:
            number = whole_number(value.cast("double"), rule.low, rule.high)
        else:
            number = F.when(value.cast("double").between(rule.low, rule.high), value)
        kind, bad = "violation", value.isNotNull() & number.isNull()
    return F.when(bad, F.struct(
        F.lit(rule.column).alias("column"), F.lit(kind).alias("kind"),
        value.cast("string").alias("value"),
    ))


def check_domains(df: DataFrame, rules: Sequence[Rule] = tuple(SURVEY_RULES)) -> DataFrame:
    """(column, kind, value, n) of the values the rules do not allow.

    ``violation`` breaks a closed list or a range, ``unlisted`` is new in an open list, ``damaged``
    is a text-held list that cannot be read, ``unreadable`` a time or boolean that cannot. NULL is never reported. A row is tested inside the
    scan stage and only its findings are grouped, so clean rows are not shuffled.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    findings = [_finding(r, types[r.column]) for r in rules if r.column in types]
    findings = [f for f in findings if f is not None]
    if not findings:
        raise ValueError("no rule names a column of this table")
    return (
        df.select(F.inline(F.array_compact(F.array(*findings))))
        .groupBy("column", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n, null_rate, empty_rate, na_rate) per column, from one pass over the table."""
    types = {f.name: f.dataType for f in df.schema.fields}
    stats = []
    for name in columns or df.columns:
        value, dtype = F.col(name), types[name]
        nulls = F.count_if(value.isNull())
        if isinstance(dtype, T.StringType):
            empty, declined = F.count_if(strip(value) == ""), F.count_if(value == NO_ANSWER)
        elif isinstance(dtype, T.ArrayType):
            empty, declined = F.count_if(F.size(value) == 0), F.lit(0)
        else:
            empty, declined = F.lit(0), F.lit(0)
        stats.append(F.struct(
            F.lit(name).alias("column"), F.count(F.lit(1)).alias("n"), nulls.alias("_null"),
            empty.cast("bigint").alias("_empty"), declined.cast("bigint").alias("_na"),
        ))
    rate = lambda c: F.try_divide(F.col(c).cast("double"), F.col("n").cast("double"))
    return (
        df.agg(F.array(*stats).alias("_rows")).select(F.inline("_rows"))
        .select("column", "n", rate("_null").alias("null_rate"), rate("_empty").alias("empty_rate"),
                rate("_na").alias("na_rate"))
    )
