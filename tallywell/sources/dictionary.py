"""Data dictionaries: a CSV of (column_name, data_type, comment) and a text with the table comment.

Comments may hold quotes, separators and line breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.schema import Rule

DICTIONARY_SCHEMA = "column_name string, data_type string, comment string"
# A quote inside a field is doubled; blanks at the ends of a field belong to it.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


# Fixed names: the forms in which a dictionary writes types that Spark calls otherwise.
WRITTEN_TYPES = {"bigint": "LONG"}
READ_TYPES = {"LONG": "bigint", "INT": "int", "ARRAY": "array<string>"}


def written_type(spark_type: str) -> str:
    """'LONG' for bigint, 'ARRAY' for a list of any element, and else Spark's name in capitals."""
    return "ARRAY" if spark_type.startswith("array<") else WRITTEN_TYPES.get(spark_type, spark_type.upper())


def schema_of(dictionary: DataFrame) -> T.StructType:
    """The schema a dictionary describes. A list whose comment says 'array<type>' has that element, else texts."""
    element = F.regexp_extract(F.lower("comment"), "array<\\s*(\\w+)\\s*>", 1)
    rows = dictionary.select("column_name", "data_type", "comment", element.alias("element")).collect()
    fields = []
    for r in rows:
        kind = f"array<{r.element}>" if r.data_type == "ARRAY" and r.element else READ_TYPES.get(r.data_type, r.data_type.lower())
        fields.append(T.StructField(r.column_name, T.DataType.fromDDL(kind), True, {"comment": r.comment or ""}))
    return T.StructType(fields)


def scan_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DICTIONARY_SCHEMA).options(multiLine="true", **CSV_OPTIONS).csv(path)


def write_dictionary(entries: DataFrame, path: str) -> None:
    entries.select("column_name", "data_type", "comment").write.options(**CSV_OPTIONS).csv(path)


def export_dictionary(
    spark: SparkSession, table: str, path: str, table_comment: str | None = None
) -> None:
    """Write ``path/columns`` (CSV) and ``path/table`` (text) for a catalog table or view.

    Only names, types and comments pass through the driver. A temporary view has no comment of its
    own, so one can be given.
    """
    rows = [(c.name, written_type(c.dataType), c.description) for c in spark.catalog.listColumns(table)]
    write_dictionary(spark.createDataFrame(rows, DICTIONARY_SCHEMA).coalesce(1), f"{path}/columns")
    text = table_comment if table_comment is not None else spark.catalog.getTable(table).description
    spark.createDataFrame([(text or "",)], "value string").coalesce(1).write.text(f"{path}/table")


def scan_table_comment(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(f"{path}/table", wholetext=True)


def rules_of(dictionary: DataFrame) -> list[Rule]:
    """Domain rules from the comments of a dictionary.

    A numbered list of labels, or codes after a colon, is a closed list; codes after 'e.g.' or
    '例' are an open one; 'low~high' is a range. Comments with none of these give no rule.
    """
    comment = F.col("comment")
    code_list = "[A-Za-z0-9_]+(?:\\s*[,、]\\s*[A-Za-z0-9_]+)+"
    number = "(\\d+(?:\\.\\d+)?)"
    labels = F.regexp_extract_all(comment, F.lit("(?m)^\\s*\\d+\\.\\s*(\\w+)\\s*[:：]"), F.lit(1))
    codes = F.regexp_extract(comment, f"[:：]\\s*({code_list})", 1)
    examples = F.regexp_extract(comment, f"(?:例\\s*[:：]|e\\.g\\.)\\s*({code_list})", 1)
    bounds = lambda i: F.regexp_extract(comment, f"{number}\\s*[~～〜]\\s*{number}", i).try_cast("double")
    plain = F.regexp_extract(comment, f"[（(]\\s*({code_list})", 1)
    as_codes = lambda c: F.split(c, "\\s*[,、]\\s*")
    found = dictionary.select(
        "column_name",
        F.when(F.size(labels) > 1, labels)
        .when(F.length(examples) > 0, as_codes(examples))
        .when(F.length(codes) > 0, as_codes(codes))
        .when(F.length(plain) > 0, as_codes(plain)).alias("codes"),
        (F.length(examples) == 0).alias("closed"),
        bounds(1).alias("low"), bounds(2).alias("high"),
    ).filter(F.col("codes").isNotNull() | F.col("low").isNotNull())
    rows = found.collect()
    return [
        Rule(r.column_name, tuple(r.codes), closed=r.closed) if r.codes
        else Rule(r.column_name, low=r.low, high=r.high)
        for r in rows
    ]
