from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from acceptance.queries import silver
from pollstone.contracts import catalog
from pollstone.operators import quality, reference


def small(spark, data):
    df = spark.createDataFrame(data, "response_id string, completion_status string, silver_processed_at timestamp")
    others = [name for name in quality.TRACKED_COLUMNS if name not in df.columns]
    return df.withColumns({name: F.lit("x") for name in others})


T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1, 30)


def test_scores(spark):
    df = small(spark, [("1", "Completed", T0), (None, "Completed", T1), ("3", None, T1), ("4", "Partial", T1)])
    profile = quality.response_profile(df)
    q = quality.data_quality_summary(profile).first()
    assert (q.total_records, q.valid_records, q.invalid_records, q.missing_value_count) == (4, 2, 1, 2)
    assert (q.completeness_percentage, q.validity_percentage, q.uniqueness_percentage) == (95.45, 50.0, 100.0)
    assert q.quality_status == "Poor"
    r = quality.reliability_index(profile).first()
    assert (r.overall_reliability_index, r.reliability_status) == (81.82, "Fair")
    run = quality.pipeline_runtime(profile).first()
    assert (run.runtime_seconds, run.runtime_minutes, run.records_processed) == (90.0, 1.5, 4)
    s = quality.pipeline_status(profile).first()
    assert (s.pipeline_status, s.successful_jobs, s.failed_jobs, s.warning_jobs, s.overall_health_score) == ("SUCCESS", 2, 1, 0, 50.0)


def test_empty_input(spark):
    profile = quality.response_profile(small(spark, []))
    q = quality.data_quality_summary(profile).first()
    assert (q.total_records, q.valid_records, q.completeness_percentage, q.quality_status) == (0, None, None, "Poor")
    assert quality.pipeline_status(profile).first().pipeline_status == "FAILED"
    assert quality.data_freshness(profile).first().freshness_status == "Very Stale"


def test_freshness_uses_the_exact_age(spark):
    profile = quality.response_profile(small(spark, [("1", "Completed", T0)]))
    at = lambda *args: F.lit(datetime(*args))
    fresh = quality.data_freshness(profile, now=at(2024, 1, 2, 0, 0, 0)).first()
    stale = quality.data_freshness(profile, now=at(2024, 1, 2, 0, 0, 1)).first()
    assert (fresh.freshness_hours, fresh.freshness_status) == (24.0, "Fresh")
    assert (stale.freshness_hours, stale.freshness_status) == (24.0, "Stale")


def test_known_copies_lower_uniqueness(spark):
    df = small(spark, [("1", "Completed", T0), ("2", "Completed", T0)]).withColumn("copies", F.lit(2))
    q = quality.data_quality_summary(quality.response_profile(df)).first()
    assert (q.duplicate_records, q.uniqueness_percentage) == (2, 50.0)
    r = quality.reliability_index(quality.response_profile(df)).first()
    assert r.overall_reliability_index == 83.33


def test_quality_by_country(spark):
    df = small(spark, [("1", "Completed", T0), ("1", "Completed", T0), ("2", "Partial", None)]).withColumn("country", F.lit("Mali"))
    out = quality.quality_by_country(df).first()
    assert (out.duplicate_rate, out.completeness_score, out.null_percentage) == (33.33, 96.97, 3.03)
    assert (out.validation_status, out.failed_checks) == ("failed", ["duplicates", "validity"])


def test_row_checks(spark):
    df = spark.createDataFrame(
        [("1", "A", "x", 20, 1, T0), ("2", None, "x", 20, 3, T0)],
        "response_id string, country string, gender string, age int, copies bigint, submission_timestamp timestamp",
    )
    out = rows(reference.with_row_checks(df).select("response_id", "duplicate_flag", "validation_status", "age_group"))
    assert out == [("1", False, "valid", "18-24"), ("2", True, "invalid", "18-24")]


def test_contract_columns(spark, folder):
    profile = quality.response_profile(silver(spark, folder))
    for name, table in {
        "data_quality_summary_gold": quality.data_quality_summary(profile),
        "reliability_index_gold": quality.reliability_index(profile),
        "pipeline_runtime_gold": quality.pipeline_runtime(profile),
        "pipeline_status_gold": quality.pipeline_status(profile),
        "data_freshness_gold": quality.data_freshness(profile),
    }.items():
        want = {f.name: f.spark_type.simpleString() for f in catalog.GOLD[name].fields}
        assert dict(table.dtypes) == want, name
