from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pollstone import fixtures
from pollstone.operators import cleaning


def test_trim_and_blank(spark):
    df = spark.createDataFrame([(" a ", 1), ("  ", 2), (None, 3)], "t string, n int")
    assert [r.t for r in cleaning.trim_text(df).collect()] == ["a", "", None]
    assert [r.t for r in cleaning.blank_to_null(df).collect()] == [" a ", None, None]


def test_gender(spark):
    df = spark.createDataFrame([("MALE",), ("m",), ("f",), ("Female",), ("x",), (None,)], "gender string")
    assert [r[0] for r in cleaning.clean_gender(df).collect()] == [
        "Male",
        "Male",
        "Female",
        "Female",
        "Unknown",
        "Unknown",
    ]
    assert cleaning.clean_gender(df.toDF("sex")).columns == ["sex"]


def test_age_limits(spark):
    df = spark.createDataFrame([(17.0,), (18.0,), (73.0,), (100.0,), (101.0,), (None,)], "age double")
    out = cleaning.clean_age(df)
    assert [r.age for r in out.collect()] == [None, 18, 73, 100, None, None]
    assert dict(out.dtypes)["age"] == "int"


def test_age_text_is_read_as_number(spark):
    df = spark.createDataFrame([("73.0",), ("abc",), ("17",)], "age string")
    assert [r.age for r in cleaning.clean_age(df).collect()] == [73, None, None]


def test_title_case_splits_on_blanks_only(spark):
    df = spark.createDataFrame([("self-employed",), (" côte d'ivoire ",), ("VERY  good",)], "region string")
    assert [r.region for r in cleaning.clean_categorical_columns(df).collect()] == [
        "Self-employed",
        "Côte D'ivoire",
        "Very  Good",
    ]


def test_survey_cleaning_is_idempotent(spark, folder):
    once = cleaning.clean_survey_responses(fixtures.survey_raw(spark, folder))
    twice = cleaning.clean_survey_responses(once)
    assert rows(once) == rows(twice)


def test_bad_values_do_not_fail_the_job(spark):
    df = spark.createDataFrame([("x", "not a date", "oops")], "response_id string, submission_timestamp string, income string")
    out = cleaning.clean_survey_responses(df).first()
    assert out.submission_timestamp is None and out.income is None


def test_population_records(spark):
    record = (
        "named_struct('id','NG','value',' nigeria ') country, 'nga ' countryiso3code, '2024' date, {v} value, "
        "named_struct('id','POP','value','Population, total') indicator, '' obs_status, '' unit, 0L decimal"
    )
    df = spark.sql("SELECT " + record.format(v="-5L")).unionByName(spark.sql("SELECT " + record.format(v="7L")))
    out = cleaning.clean_world_bank_population(df).collect()
    assert [(r.country, r.country_code, r.year, r.population, r.unit) for r in out] == [
        ("Nigeria", "NGA", 2024, None, None),
        ("Nigeria", "NGA", 2024, 7, None),
    ]


def test_metadata_and_dispatch(spark):
    df = spark.createDataFrame([("1",)], "response_id string")
    stamp = F.lit(datetime(2024, 1, 2))
    out = cleaning.clean_dataset(df, " Survey_Responses ", stamp).first()
    assert (out.silver_processed_at, out.source_layer, out.target_layer) == (datetime(2024, 1, 2), "bronze", "silver")
    with pytest.raises(ValueError):
        cleaning.clean_dataset(df, "other")
