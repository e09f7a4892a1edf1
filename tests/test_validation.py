import pytest
from conftest import plan

from pollstone.operators import validation as v


def survey(spark, data):
    return spark.createDataFrame(data, "response_id string, country string, gender string, age int")


def failed(report):
    return sorted((r.rule, r.target) for r in report.filter("NOT passed").collect())


def test_valid_survey_passes(spark):
    df = survey(spark, [("1", "A", "Male", 20), ("2", "A", "Female", 30)])
    assert failed(v.validate_dataset(df, "survey_responses")) == []
    assert v.require_valid(df, "survey_responses") is df
    assert v.pass_rate(v.validate_dataset(df, "survey_responses")).first().meets_threshold


def test_each_rule_can_fail(spark):
    df = survey(spark, [("1", None, "Male", 20), ("1", "A", "Male", 17), (None, "B", None, None)])
    assert failed(v.validate_dataset(df, "survey_responses")) == [
        ("null_share", "age"),
        ("null_share", "country"),
        ("null_share", "gender"),
        ("null_share", "response_id"),
        ("out_of_range", "age"),
        ("surplus_keys", "response_id"),
    ]
    with pytest.raises(v.ValidationError, match="survey_responses"):
        v.require_valid(df, "survey_responses")


def test_empty_and_missing_columns_fail(spark):
    empty = survey(spark, [])
    assert ("null_share", "age") in failed(v.validate_dataset(empty, "survey_responses"))
    narrow = spark.createDataFrame([("1",)], "response_id string")
    assert ("required_column", "age") in failed(v.validate_dataset(narrow, "survey_responses"))
    assert ("out_of_range", "age") in failed(v.validate_dataset(narrow, "survey_responses"))
    keyless = spark.createDataFrame([(1,)], "x int")
    assert ("surplus_keys", "a,b") in failed(v.validation_report(keyless, v.Rules(unique=("a", "b"))))


def test_null_keys_count_as_one_value(spark):
    assert v.keys_unique(survey(spark, [(None, "A", "x", 1), ("1", "A", "x", 1)]), ["response_id"])
    assert not v.keys_unique(survey(spark, [(None, "A", "x", 1), (None, "A", "x", 1)]), ["response_id"])


def test_single_checks(spark):
    df = survey(spark, [("1", "A", "x", None), ("2", "A", "x", 50)])
    assert v.has_columns(df, ["age"]) and not v.has_columns(df, ["agee"])
    assert v.nulls_within(df, {"age": 0.5}) and not v.nulls_within(df, {"age": 0.4})
    assert v.numbers_within(df, {"age": (18, 100)}) and not v.numbers_within(df, {"age": (60, 100)})


def test_all_rules_take_one_scan(spark, folder):
    df = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "CAST(o_orderkey AS STRING) response_id", "o_orderstatus country", "o_orderpriority gender", "20 age"
    )
    report = v.validate_dataset(df, "survey_responses")
    report.collect()
    assert plan(report).count("FileScan") == 1


def test_extensions(spark):
    assert v.extension_allowed("a/b.CSV") and not v.extension_allowed("a/b.txt")
    files = spark.createDataFrame([("a/b.csv",), ("a/c.txt",), ("a/d",)], "path string")
    assert [r.reject_reason is None for r in v.with_extension_check(files).collect()] == [True, False, False]


def test_unknown_dataset(spark):
    with pytest.raises(ValueError):
        v.rules_for("x")
