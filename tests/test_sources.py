from dataclasses import replace

import pytest
from pyspark.sql import types as T

from tallywell.operators import quality
from tallywell.schema import CATEGORIES, SURVEY_COMMENT, SURVEY_RULES, SURVEY_SCHEMA, Rule
from tallywell.sources import dictionary, survey

STORED = ("id bigint, submitted_at string, gender string, drives_weekly string, satisfaction_int string, "
          "positive_point string, positive_point_confidence string")
ROWS = [(1, "2024-01-02 03:04:05", "male", "はい", "４", '["泡","味"]', "0.5"),
        (2, "bad", None, "?", "9", '["泡"', "1.5"),
        (3, None, "no_answer", None, None, "泡、味", None)]


def check(df):
    assert [f.name for f in df.schema] == SURVEY_SCHEMA.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in SURVEY_SCHEMA]
    got = [(r.id, str(r.submitted_at), r.gender, r.drives_weekly, r.satisfaction_int, r.positive_point,
            r.positive_point_confidence, r.scene) for r in df.orderBy("id").collect()]
    assert got == [(1, "2024-01-02 03:04:05", "male", True, 4, ["泡", "味"], 0.5, None),
                   (2, "None", None, None, None, None, None, None),
                   (3, "None", "no_answer", None, None, ["泡", "味"], None, None)]


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_scan_text_held_columns(spark, tmp_path, format):
    path = str(tmp_path / format)
    options = {"escape": '"'} if format == "csv" else {}
    spark.createDataFrame(ROWS, STORED).write.format(format).options(**options).save(path)
    schema = T.StructType.fromDDL(STORED)
    check(survey.scan_survey(spark, path, format, schema=schema, **options))


def test_scan_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, STORED).write.parquet(path)
    df = survey.scan_survey(spark, path).select("id", "gender").filter("gender = 'male'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,gender:string>" in plan and "EqualTo(gender,male)" in plan


def test_scan_renames_and_reads_catalog_tables(spark):
    spark.sql("DROP TABLE IF EXISTS stored_answers")
    spark.createDataFrame(ROWS, STORED).withColumnRenamed("id", "no").write.saveAsTable("stored_answers")
    check(survey.scan_survey(spark, "stored_answers", "table", columns={"id": "no"}))
    spark.sql("DROP TABLE stored_answers")


def test_write_and_scan_partitioned(spark, tmp_path):
    path = str(tmp_path / "p")
    df = survey.conform(spark.createDataFrame(ROWS, STORED))
    survey.write_survey(df, path, partition_by=["gender"])
    back = survey.scan_survey(spark, path)
    check(back)
    assert back.schema["gender"].metadata["comment"].startswith("Gender: male")


def test_multi_select_columns(spark):
    df = spark.createDataFrame([("a、b",), (None,)], "health_reasons string")
    got = survey.multi_select_columns(df, {"health_reasons_arr": "health_reasons"}).collect()
    assert [r.health_reasons_arr for r in got] == [["a", "b"], None]


def test_reconcile_in_place(spark):
    df = spark.createDataFrame([('["x"]', "0.25", 7)], "l string, n string, k int")
    assert tuple(survey.reconcile_types(df, ["l"], ["n"]).first()) == (["x"], 0.25, 7)


def test_dictionary_round_trip(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = [("a", "LONG", "鍵 (primary key)；参照"), ("b", "STRING", '\n"quoted", comma\r\nand 行\\末 '),
            ("c", "STRING", " 例: x, y")]
    dictionary.write_dictionary(spark.createDataFrame(rows, dictionary.DICTIONARY_SCHEMA), path)
    assert sorted(tuple(r) for r in dictionary.scan_dictionary(spark, path).collect()) == rows


def test_scan_dictionary_with_quoted_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('column_name,data_type,comment\nid,LONG,key\nk,STRING,"\nkinds:  \n1. A：x（a・b）  \n2. B：y"\n', encoding="utf-8")
    rows = dictionary.scan_dictionary(spark, str(path)).collect()
    assert [(r.column_name, r.data_type) for r in rows] == [("id", "LONG"), ("k", "STRING")]
    assert rows[1].comment == "\nkinds:  \n1. A：x（a・b）  \n2. B：y"


def test_rules_from_comments(spark):
    rows = [("id", "LONG", "識別子 (primary key)"), ("g", "STRING", "性別：male, female, no_answer"),
            ("a", "STRING", "年代（例: u19, 20s, 60plus）"), ("r", "STRING", "地域（kanto, kinki）"),
            ("s", "INT", "満足度（1～5 の整数）"), ("c", "STRING", "信頼度（0.0～1.0）"),
            ("k", "STRING", "分類、2 種類。\n1. Aroma：香り（花・果実）\n2. ABV：度数（例: 0.00%）"),
            ("o", "STRING", "Job (e.g. student, other)"), ("t", "STRING", "感想"), ("n", "STRING", None)]
    rules = {r.column: r for r in dictionary.rules_of(spark.createDataFrame(rows, dictionary.DICTIONARY_SCHEMA))}
    assert rules == {
        "g": Rule("g", ("male", "female", "no_answer")), "a": Rule("a", ("u19", "20s", "60plus"), closed=False),
        "r": Rule("r", ("kanto", "kinki")), "s": Rule("s", low=1.0, high=5.0), "c": Rule("c", low=0.0, high=1.0),
        "k": Rule("k", ("Aroma", "ABV")), "o": Rule("o", ("student", "other"), closed=False)}


def test_own_comments_give_the_documented_rules(spark):
    rows = [(f.name, f.dataType.simpleString(), f.metadata["comment"]) for f in SURVEY_SCHEMA]
    got = {r.column: r for r in dictionary.rules_of(spark.createDataFrame(rows, dictionary.DICTIONARY_SCHEMA))}
    assert got == {r.column: replace(r, whole=False) for r in SURVEY_RULES if not r.text_list and not r.typed}
    assert got["positive_point_category"].codes == tuple(CATEGORIES)


def test_export_of_a_commented_table(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.sql("DROP TABLE IF EXISTS commented")
    survey.conform(spark.createDataFrame(ROWS, STORED)).write.saveAsTable("commented")
    spark.sql("COMMENT ON TABLE commented IS '回答、\"加工\"済み'")
    dictionary.export_dictionary(spark, "commented", path)
    entries = {r.column_name: (r.data_type, r.comment) for r in dictionary.scan_dictionary(spark, f"{path}/columns").collect()}
    assert list(entries) == SURVEY_SCHEMA.fieldNames()
    assert entries["scene"] == ("ARRAY", SURVEY_SCHEMA["scene"].metadata["comment"])
    assert dictionary.scan_table_comment(spark, path).first()[0].strip() == '回答、"加工"済み'
    spark.sql("DROP TABLE commented")


def test_export_of_a_view_feeds_the_domain_check(spark, tmp_path):
    path = str(tmp_path / "v")
    view = survey.conform(spark.createDataFrame([(1, "robot")], "id bigint, gender string"))
    view.createOrReplaceTempView("a_view")
    dictionary.export_dictionary(spark, "a_view", path, SURVEY_COMMENT)
    rules = dictionary.rules_of(dictionary.scan_dictionary(spark, f"{path}/columns"))
    assert [tuple(r) for r in quality.check_domains(view, rules).collect()] == [("gender", "violation", "robot", 1)]
    assert dictionary.scan_table_comment(spark, path).first()[0].strip() == SURVEY_COMMENT


def test_ranges_hold_for_numbers(spark):
    df = spark.createDataFrame([(1, 9, 1.7), (2, 5, 0.5), (3, None, None)], "id bigint, satisfaction_int int, positive_point_confidence double")
    got = [(r.satisfaction_int, r.positive_point_confidence) for r in survey.conform(df).orderBy("id").collect()]
    assert got == [(None, None), (5, 0.5), (None, None)]
    df = spark.createDataFrame([(1, 4.7), (2, 4.0)], "id bigint, satisfaction_int double")
    assert [r.satisfaction_int for r in survey.conform(df).orderBy("id").collect()] == [None, 4]


def test_a_dictionary_gives_a_schema_with_elements(spark):
    rows = [("id", "LONG", None), ("n", "INT", ""), ("a", "ARRAY", "list, array<int>"), ("b", "ARRAY", "list"), ("t", "TIMESTAMP", "")]
    got = dictionary.schema_of(spark.createDataFrame(rows, dictionary.DICTIONARY_SCHEMA))
    assert [f.dataType.simpleString() for f in got] == ["bigint", "int", "array<int>", "array<string>", "timestamp"]
