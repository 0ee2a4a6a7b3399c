from tallywell.operators import quality
from tallywell.schema import Rule, SURVEY_RULES


def findings(df, rules):
    return sorted((r.column, r.kind, r.value, r.n) for r in quality.check_domains(df, rules).collect())


def test_primary_key(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    assert sorted(quality.check_primary_key(df).collect(), key=str) == [(2, 2), (None, 1)]


def test_domains(spark):
    df = spark.createDataFrame(
        [("male", "20s", 5, "1.2", '["a"'), ("男", "70s", 6, "x", '["a"]'), ("男", None, 0, "0.3", "a, b"), (None,) * 5],
        "gender string, age_group string, satisfaction_int int, positive_point_confidence string, positive_point string")
    assert findings(df, SURVEY_RULES) == [
        ("age_group", "unlisted", "70s", 1), ("gender", "violation", "男", 2),
        ("positive_point", "damaged", '["a"', 1),
        ("positive_point_confidence", "violation", "1.2", 1), ("positive_point_confidence", "violation", "x", 1),
        ("satisfaction_int", "violation", "0", 1), ("satisfaction_int", "violation", "6", 1)]


def test_clean_frame_has_no_findings(spark):
    df = spark.createDataFrame([("no_answer", "hokkaido_to_hoku", 1.0)],
                               "gender string, region string, positive_point_confidence double")
    assert findings(df, SURVEY_RULES) == []


def test_not_a_number_is_outside_a_range(spark):
    df = spark.createDataFrame([(float("nan"),)], "x double")
    assert findings(df, [Rule("x", low=0, high=1)]) == [("x", "violation", "NaN", 1)]


def test_completeness(spark):
    df = spark.createDataFrame(
        [(1, "no_answer", []), (2, " ", ["a"]), (3, None, None), (4, "x", None)], "id int, g string, a array<string>")
    got = {r["column"]: tuple(r)[1:] for r in quality.completeness(df).collect()}
    assert got == {"id": (4, 0.0, 0.0, 0.0), "g": (4, 0.25, 0.25, 0.25), "a": (4, 0.5, 0.25, 0.0)}


def test_completeness_of_an_empty_table(spark):
    got = quality.completeness(spark.createDataFrame([], "id int")).collect()
    assert [tuple(r) for r in got] == [("id", 0, None, None, None)]


def test_what_typing_loses_is_found(spark):
    df = spark.createDataFrame(
        [("4.0", "2024-01-01", "yes"), ("4.5", "n/a", "maybe so"), ("abc", "2024-13-01", "x"), ("9", None, None)],
        "satisfaction_int string, submitted_at string, drives_weekly string")
    assert findings(df, SURVEY_RULES) == [
        ("drives_weekly", "unreadable", "maybe so", 1), ("drives_weekly", "unreadable", "x", 1),
        ("satisfaction_int", "violation", "4.5", 1), ("satisfaction_int", "violation", "9", 1), ("satisfaction_int", "violation", "abc", 1),
        ("submitted_at", "unreadable", "2024-13-01", 1), ("submitted_at", "unreadable", "n/a", 1)]


def test_full_width_blanks_are_empty(spark):
    got = quality.completeness(spark.createDataFrame([("　",), ("x",)], "g string")).first()
    assert got.empty_rate == 0.5
