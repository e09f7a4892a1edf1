"""Contracts of the raw, clean and business tables.

Fixed values: column names, types and required marks of every table.
"""

from __future__ import annotations

from pollstone.contracts.model import Contract

LAYER_MARKS = {"source_layer": "string!", "target_layer": "string!"}
SILVER_MARKS = {"silver_processed_at": "timestamp!", **LAYER_MARKS}
GOLD_TIME = {"gold_processed_at": "timestamp!"}
GOLD_MARKS = {**GOLD_TIME, **LAYER_MARKS}
PLACE = {"country": "string!", "region": "string"}

BRONZE_SURVEY = Contract.of(
    "survey_responses_bronze",
    {
        "response_id": "string!",
        "respondent_id": "string!",
        "survey_id": "string!",
        "country": "string!",
        "region": "string",
        "gender": "string!",
        "age": "integer",
        "education_level": "string",
        "employment_status": "string",
        "completion_status": "string!",
        "submission_timestamp": "timestamp!",
        "source_system": "string!",
        "q1_democracy": "integer",
        "q2_economy": "string",
        "q3_trust_govt": "integer",
        "q4_corruption": "string",
        "q5_election_fairness": "integer",
    },
    primary_key=["response_id"],
)

BRONZE_WORLD_BANK = Contract.of(
    "world_bank_population",
    {
        "country": "string!",
        "country_code": "string!",
        "country_iso3": "string",
        "year": "integer!",
        "population": "integer!",
        "indicator_id": "string",
        "indicator_name": "string",
        "unit": "string",
        "observation_status": "string",
        "decimal_places": "integer",
        "ingestion_timestamp": "timestamp!",
        "source_system": "string!",
    },
    primary_key=["country_code", "year"],
    defaults={"source_system": "world_bank"},
)

BRONZE_REST_COUNTRIES = Contract.of(
    "restcountries",
    {
        "country": "string!",
        "official_name": "string",
        "country_code": "string!",
        "country_iso3": "string",
        "capital": "string",
        "region": "string",
        "subregion": "string",
        "population": "integer",
        "area": "float",
        "timezone": "string",
        "latitude": "float",
        "longitude": "float",
        "source_system": "string!",
        "ingestion_timestamp": "timestamp!",
    },
    primary_key=["country_code"],
    defaults={"source_system": "restcountries"},
)

SILVER_SURVEY = Contract.of(
    "survey_responses_silver",
    {
        "response_id": "string!",
        "respondent_id": "string!",
        "survey_id": "string!",
        "country": "string!",
        "country_code": "string",
        "region": "string",
        "gender": "string!",
        "age": "integer",
        "age_group": "string",
        "education_level": "string",
        "employment_status": "string",
        "q1_democracy": "integer",
        "q2_economy": "string",
        "q3_trust_govt": "integer",
        "q4_corruption": "string",
        "q5_election_fairness": "integer",
        "completion_status": "string!",
        "submission_date": "date!",
        "submission_timestamp": "timestamp!",
        "ingestion_timestamp": "timestamp!",
        "duplicate_flag": "boolean!",
        "validation_status": "string!",
        "source_system": "string!",
    },
    primary_key=["response_id"],
)

SILVER_POPULATION = Contract.of(
    "world_bank_population_silver",
    {
        "country": "string!",
        "country_code": "string!",
        "year": "integer!",
        "population": "long",
        "indicator": "string!",
        "obs_status": "string",
        "unit": "string",
        "decimal": "long",
        **SILVER_MARKS,
    },
)

SILVER_COUNTRIES = Contract.of(
    "country_reference_silver",
    {
        "country_name": "string!",
        "official_name": "string",
        "region": "string",
        "subregion": "string",
        "population": "long",
        "area": "double",
        **SILVER_MARKS,
    },
)

COUNTRY_SURVEY_KPIS = Contract.of(
    "country_survey_kpis_gold",
    {
        **PLACE,
        "subregion": "string",
        "total_responses": "long!",
        "completed_responses": "long!",
        "incomplete_responses": "long!",
        "completion_rate": "double!",
        "valid_responses": "long!",
        "invalid_responses": "long!",
        "duplicate_responses": "long!",
        "country_population": "long",
        "response_rate_per_million": "double",
        **GOLD_MARKS,
    },
    primary_key=["country", "region"],
)

DEMOGRAPHICS = Contract.of(
    "demographic_distribution_gold",
    {
        **PLACE,
        "gender": "string!",
        "age_group": "string",
        "education_level": "string",
        "employment_status": "string",
        "response_count": "long!",
        "percentage_of_total": "double!",
        **GOLD_MARKS,
    },
)

RESPONSE_TRENDS = Contract.of(
    "response_volume_trends_gold",
    {
        "submission_date": "date!",
        **PLACE,
        "daily_response_count": "long!",
        "completed_response_count": "long!",
        "duplicate_response_count": "long!",
        "valid_response_count": "long!",
        "cumulative_response_count": "long!",
        **GOLD_MARKS,
    },
    primary_key=["submission_date", "country", "region"],
)


def _perception(dataset: str, mean: str, counts: tuple[str, str, str], index: str, **more: str) -> Contract:
    return Contract.of(
        dataset,
        {
            **PLACE,
            "total_responses": "long!",
            mean: "double",
            **{count: "long!" for count in counts},
            index: "double",
            **more,
            **GOLD_MARKS,
        },
    )


GOVERNANCE_TRUST = _perception(
    "governance_trust_gold",
    "average_trust_score",
    ("low_trust_count", "medium_trust_count", "high_trust_count"),
    "trust_index",
)
DEMOCRACY_PERCEPTION = _perception(
    "democracy_perception_gold",
    "average_democracy_score",
    ("negative_perception_count", "neutral_perception_count", "positive_perception_count"),
    "democracy_index",
)
CORRUPTION_PERCEPTION = _perception(
    "corruption_perception_gold",
    "average_corruption_score",
    ("low_corruption_count", "medium_corruption_count", "high_corruption_count"),
    "corruption_index",
    corruption_level="string",
)
ELECTION_FAIRNESS = _perception(
    "election_fairness_gold",
    "average_fairness_score",
    ("unfair_election_count", "neutral_election_count", "fair_election_count"),
    "fairness_index",
)

# The declared form of the corruption table: one row per answer level.
CORRUPTION_LEVELS = Contract.of(
    "corruption_levels_gold",
    {
        **PLACE,
        "total_responses": "long!",
        "corruption_level": "string",
        "corruption_response_count": "long!",
        "corruption_percentage": "double",
        "corruption_index": "double",
        **GOLD_MARKS,
    },
    primary_key=["country", "region", "corruption_level"],
)

POPULATION_COVERAGE = Contract.of(
    "population_coverage_gold",
    {
        "country": "string!",
        "year": "integer",
        "population": "long",
        "total_responses": "long!",
        "responses_per_million": "double",
        "coverage_band": "string",
        **GOLD_MARKS,
    },
    primary_key=["country"],
)

DATA_QUALITY_SUMMARY = Contract.of(
    "data_quality_summary_gold",
    {
        "dataset_name": "string!",
        "total_records": "long!",
        "valid_records": "long!",
        "invalid_records": "long!",
        "duplicate_records": "long!",
        "missing_value_count": "long!",
        "completeness_percentage": "double",
        "validity_percentage": "double",
        "uniqueness_percentage": "double",
        "quality_status": "string",
        **GOLD_TIME,
    },
)

RELIABILITY_INDEX = Contract.of(
    "reliability_index_gold",
    {
        "pipeline_name": "string!",
        "execution_date": "timestamp!",
        "total_records_processed": "long!",
        "valid_records": "long!",
        "invalid_records": "long!",
        "duplicate_records": "long!",
        "completeness_score": "double",
        "validity_score": "double",
        "uniqueness_score": "double",
        "overall_reliability_index": "double",
        "reliability_status": "string",
        **GOLD_TIME,
    },
)

PIPELINE_RUNTIME = Contract.of(
    "pipeline_runtime_gold",
    {
        "pipeline_name": "string!",
        "execution_date": "timestamp!",
        "runtime_seconds": "double!",
        "runtime_minutes": "double!",
        "status": "string!",
        "records_processed": "long",
        **GOLD_TIME,
    },
)

PIPELINE_STATUS = Contract.of(
    "pipeline_status_gold",
    {
        "pipeline_name": "string!",
        "execution_date": "timestamp!",
        "pipeline_status": "string!",
        "successful_jobs": "long!",
        "failed_jobs": "long!",
        "warning_jobs": "long!",
        "overall_health_score": "double",
        **GOLD_TIME,
    },
)

DATA_FRESHNESS = Contract.of(
    "data_freshness_gold",
    {
        "dataset_name": "string!",
        "last_ingestion_timestamp": "timestamp!",
        "last_update_timestamp": "timestamp!",
        "freshness_hours": "double!",
        "freshness_status": "string!",
        "expected_refresh_frequency": "string",
        **GOLD_TIME,
    },
)

BRONZE = {
    "survey_responses": BRONZE_SURVEY,
    "world_bank": BRONZE_WORLD_BANK,
    "restcountries": BRONZE_REST_COUNTRIES,
}
SILVER = {
    "survey_responses": SILVER_SURVEY,
    "world_bank_population": SILVER_POPULATION,
    "country_reference": SILVER_COUNTRIES,
}
GOLD = {
    contract.dataset: contract
    for contract in (
        COUNTRY_SURVEY_KPIS,
        DEMOGRAPHICS,
        RESPONSE_TRENDS,
        GOVERNANCE_TRUST,
        DEMOCRACY_PERCEPTION,
        CORRUPTION_PERCEPTION,
        CORRUPTION_LEVELS,
        ELECTION_FAIRNESS,
        POPULATION_COVERAGE,
        DATA_QUALITY_SUMMARY,
        RELIABILITY_INDEX,
        PIPELINE_RUNTIME,
        PIPELINE_STATUS,
        DATA_FRESHNESS,
    )
}
