"""The survey table as a source and a sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions.answers import multi_select, text_list, to_boolean, to_number
from tallywell.functions.answers import to_satisfaction, to_submitted_at, whole_number
from tallywell.schema import SURVEY_RULES, SURVEY_SCHEMA


BOUNDS = {r.column: (r.low, r.high) for r in SURVEY_RULES if r.low is not None}


def _typed(name: str, have: T.DataType, want: T.DataType) -> Column:
    column, bounds = F.col(name), BOUNDS.get(name, ())
    if isinstance(have, T.NumericType) and isinstance(want, T.IntegerType):
        return whole_number(column.cast("double"), *bounds)
    if isinstance(have, T.NumericType) and isinstance(want, T.DoubleType) and bounds:
        number = column.cast("double")
        return F.when(number.between(*bounds), number)
    if have == want:
        return column
    if isinstance(have, T.StringType):
        if isinstance(want, T.TimestampType):
            return to_submitted_at(column)
        if isinstance(want, T.BooleanType):
            return to_boolean(column)
        if isinstance(want, T.IntegerType):
            return to_satisfaction(column)
        if isinstance(want, T.DoubleType):
            return to_number(column, *bounds)
        if isinstance(want, T.ArrayType):
            return text_list(column)
    return column.try_cast(want)


def conform(df: DataFrame, schema: T.StructType = SURVEY_SCHEMA) -> DataFrame:
    """Bring a frame to the survey schema: order, types and comments; absent columns are NULL.

    This is where text-held lists and numbers become arrays and doubles. It is a projection, so a
    query that reads three of the columns still scans three.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in schema.fields:
        column = (_typed(field.name, have[field.name], field.dataType)
                  if field.name in have else F.lit(None).cast(field.dataType))
        out.append(column.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def reconcile_types(
    df: DataFrame, lists: Sequence[str] = (), numbers: Sequence[str] = (),
    low: float = 0.0, high: float = 1.0,
) -> DataFrame:
    """Turn text-held lists into arrays and text-held numbers into doubles, in place."""
    changes = {c: text_list(F.col(c)) for c in lists}
    changes |= {c: to_number(F.col(c), low, high) for c in numbers}
    return df.withColumns(changes)


def scan_survey(
    spark: SparkSession, path: str, format: str = "parquet",
    columns: Mapping[str, str] | None = None, schema: T.StructType | None = None, **options: str,
) -> DataFrame:
    """Read survey responses from files or, with format 'table', from a catalog table.

    ``columns`` gives the stored name of a survey column where they differ. ``schema`` declares
    the stored types; text formats need it, since nothing is inferred.
    """
    if format == "table":
        df = spark.table(path)
    else:
        reader = spark.read.format(format).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
    for name, stored in (columns or {}).items():
        df = df.withColumnRenamed(stored, name)
    return conform(df)


def write_survey(
    df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    df.write.format(format).mode(mode).partitionBy(*partition_by).save(path)


def multi_select_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add an array column for each {array column: text column}."""
    return df.withColumns({out: multi_select(F.col(text)) for out, text in columns.items()})
