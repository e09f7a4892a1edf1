from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from acceptance.queries import countries_silver, population_silver, silver
from pollstone.contracts import catalog
from pollstone.operators import reference, rollups

SURVEY = (
    "country string, region string, gender string, age int, education_level string, employment_status string, "
    "completion_status string, submission_timestamp timestamp, q1_democracy int, q3_trust_govt int, q4_corruption string, "
    "q5_election_fairness int"
)


def survey(spark):
    def row(country, region, status, day, score, corruption="High"):
        return (country, region, "Male", 30, "Primary", "Employed", status, datetime(2024, 1, day, 9), score, score, corruption, score)

    return spark.createDataFrame(
        [
            row("Mali", "A", "Completed", 1, 1),
            row("Mali", "A", "completed", 1, 5, "Low"),
            row("Mali", "A", "Completed", 2, None, "Medium"),
            row("Mali", "A", "Partial", 2, 5),
            row("Mali", "B", None, 2, 5),
            row("Ghana", None, "Completed", 1, 3, None),
        ],
        SURVEY,
    )


def refs(spark):
    cref = spark.createDataFrame(
        [("mali", "West"), ("Mali", "West"), ("GHANA", "Coast")], "country_name string, subregion string"
    )
    wb = spark.createDataFrame(
        [("MALI", 2020, 1000), ("Mali", 2021, None), ("Ghana", 2020, 0)], "country string, year int, population bigint"
    )
    return cref, wb


def test_kpis_keep_null_semantics_and_do_not_fan_out(spark):
    out = rollups.country_survey_kpis(survey(spark), *refs(spark)).drop("gold_processed_at")
    assert rows(out) == sorted(
        [
            ("Ghana", None, "Coast", 1, 1, 0, 100.0, 1, 0, 0, 0, None, "silver", "gold"),
            ("Mali", "A", "West", 4, 3, 1, 75.0, 3, 1, 0, 1000, 4000.0, "silver", "gold"),
            ("Mali", "B", "West", 1, 0, 0, 0.0, 0, 0, 0, 1000, 1000.0, "silver", "gold"),
        ],
        key=str,
    )


def test_perception_counts_add_up(spark):
    out = rollups.governance_trust(survey(spark)).filter("country = 'Mali'").first()
    assert (out.total_responses, out.average_trust_score, out.trust_index) == (2, 3.0, 0.0)
    assert out.low_trust_count + out.medium_trust_count + out.high_trust_count == out.total_responses


def test_corruption_words_and_numbers_only(spark):
    words = {r.country: r for r in rollups.corruption_perception(survey(spark)).collect()}
    assert set(words) == {"Mali"}
    mali = words["Mali"]
    assert (mali.total_responses, mali.average_corruption_score, mali.corruption_level) == (3, 3.0, "High")
    assert (mali.low_corruption_count, mali.medium_corruption_count, mali.high_corruption_count) == (1, 1, 1)
    assert mali.corruption_index == 33.33
    numbers = rollups.corruption_perception(survey(spark), levels=None).first()
    assert (numbers.average_corruption_score, numbers.corruption_index, numbers.corruption_level) == (None, 0.0, "Low")


def test_corruption_levels(spark):
    out = rollups.corruption_levels(survey(spark)).select("country", "corruption_level", "corruption_percentage", "corruption_index")
    assert rows(out) == [("Mali", "High", 33.33, 33.33), ("Mali", "Low", 33.33, 33.33), ("Mali", "Medium", 33.33, 33.33)]


def test_trends_running_total(spark):
    out = rollups.response_volume_trends(survey(spark)).select(
        "submission_date", "country", "region", "daily_response_count", "completed_response_count", "cumulative_response_count"
    )
    assert rows(out) == sorted(
        [
            (date(2024, 1, 1), "Ghana", None, 1, 1, 1),
            (date(2024, 1, 1), "Mali", "A", 2, 2, 2),
            (date(2024, 1, 2), "Mali", "A", 2, 1, 4),
            (date(2024, 1, 2), "Mali", "B", 1, 0, 5),
        ],
        key=str,
    )


def test_last_running_total_is_the_country_count(spark, folder):
    rows_in = silver(spark, folder)
    counts = {r[0]: r[1] for r in rows_in.groupBy("country").count().collect()}
    last = rollups.response_volume_trends(rows_in).groupBy("country").agg(F.max("cumulative_response_count"))
    assert {r[0]: r[1] for r in last.collect()} == counts


def test_coverage_bands(spark):
    out = {r.country: r for r in rollups.population_coverage(survey(spark), refs(spark)[1]).collect()}
    assert (out["Mali"].responses_per_million, out["Mali"].coverage_band) == (3000.0, "Very High")
    assert (out["Ghana"].responses_per_million, out["Ghana"].coverage_band) == (None, "Very Low")


def test_demographics_shares(spark):
    out = rollups.demographic_distribution(survey(spark))
    assert out.agg(F.sum("response_count")).first()[0] == 6
    assert {r.percentage_of_total for r in out.filter("region = 'A'").collect()} == {66.67}


def test_demographics_read_the_responses_once(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "o_orderstatus country", "o_orderpriority region", "'x' gender", "30 age", "'p' education_level", "'e' employment_status"
    )
    out = rollups.demographic_distribution(orders)
    out.collect()
    assert "ReusedExchange" in plan(out) or plan(out).count("FileScan") == 1


@pytest.mark.parametrize("table", rollups.PERCEPTIONS)
def test_rollup_gives_the_same_tables(spark, folder, table):
    rows_in = silver(spark, folder)
    rollup = rollups.place_rollup(rows_in)
    direct = rollups.perception_table(rows_in, rollups.PERCEPTIONS[table])
    derived = rollups.perception_from_rollup(rollup, table)
    assert direct.columns == derived.columns
    drop = "gold_processed_at"
    assert rows(direct.drop(drop)) == rows(derived.drop(drop))


def test_dimension_joins_are_broadcast_after_measuring(spark, folder):
    out = rollups.country_survey_kpis(silver(spark, folder), countries_silver(spark, folder), population_silver(spark, folder))
    out.collect()
    assert "SortMergeJoin" not in plan(out)


def test_responses_are_not_shuffled_for_a_small_reference_table(spark, folder, tmp_path):
    population_silver(spark, folder).write.parquet(str(tmp_path / "population"))
    population = spark.read.parquet(str(tmp_path / "population"))
    coded = reference.with_country_codes(silver(spark, folder), population)
    assert "BroadcastHashJoin" in plan(coded) and "SortMergeJoin" not in plan(coded)


def test_columns_match_the_contracts(spark, folder):
    survey_rows = silver(spark, folder)
    tables = {
        "country_survey_kpis_gold": rollups.country_survey_kpis(
            survey_rows, countries_silver(spark, folder), population_silver(spark, folder)
        ),
        "demographic_distribution_gold": rollups.demographic_distribution(survey_rows),
        "response_volume_trends_gold": rollups.response_volume_trends(survey_rows),
        "population_coverage_gold": rollups.population_coverage(survey_rows, population_silver(spark, folder)),
        **{name: rollups.perception_table(survey_rows, asked) for name, asked in rollups.PERCEPTIONS.items()},
    }
    for name, table in tables.items():
        assert sorted(table.columns) == sorted(catalog.GOLD[name].columns), name
        have = dict(table.dtypes)
        want = {f.name: f.spark_type.simpleString() for f in catalog.GOLD[name].fields}
        assert have == want, name
