"""Which datasets exist, where they land and how they are read."""

from __future__ import annotations

from dataclasses import dataclass


# The data's own columns in landed files, where ``country`` and ``source_system`` name folders.
REPORTED_COUNTRY = "reported_country"
REPORTED_SOURCE = "reported_source"


@dataclass(frozen=True)
class Dataset:
    name: str
    input_glob: str
    output_path: str
    format: str
    source_system: str
    multi_line: bool = False


@dataclass(frozen=True)
class Lake:
    """Root folders of the layers."""

    bronze: str
    silver: str
    gold: str
    meta: str

    @classmethod
    def under(cls, root: str) -> Lake:
        base = root.rstrip("/")
        return cls(f"{base}/bronze", f"{base}/silver", f"{base}/gold", f"{base}/meta")


def bronze_datasets(lake: Lake) -> dict[str, Dataset]:
    """Raw inputs of the clean layer and where their clean tables go."""
    day = "year=*/month=*/day=*"
    return {
        "survey_responses": Dataset(
            "survey_responses",
            f"{lake.bronze}/country=*/{day}/source_system=csv",
            f"{lake.silver}/survey_responses",
            "parquet",
            "csv",
        ),
        "world_bank_population": Dataset(
            "world_bank_population",
            f"{lake.bronze}/country=global/{day}/source_system=world_bank",
            f"{lake.silver}/world_bank_population",
            "json",
            "world_bank",
        ),
        "country_reference": Dataset(
            "country_reference",
            f"{lake.bronze}/country=global/{day}/source_system=restcountries",
            f"{lake.silver}/country_reference",
            "json",
            "restcountries",
        ),
    }


def database_snapshots(lake: Lake) -> Dataset:
    """Database snapshots as one more raw source of survey responses."""
    return Dataset(
        "survey_responses",
        f"{lake.bronze}/country=global/year=*/month=*/day=*/source_system=postgres_operational",
        f"{lake.silver}/survey_responses",
        "parquet",
        "postgres_operational",
    )


# Service sources, database sources, tables that may be extracted.
API_SOURCES = {
    "world_bank": {
        "description": "World Bank Open Data API",
        "base_url": "https://api.worldbank.org/v2",
        "indicator": "SP.POP.TOTL",
        "dataset": "world_bank_population",
    },
    "restcountries": {
        "description": "REST Countries API",
        "base_url": "https://restcountries.com/v3.1",
        "endpoint": "/all?fields=name,region,subregion,population,area",
        "dataset": "country_reference",
    },
}
DB_SOURCES = {
    "survey_responses": {"table_name": "survey_responses", "source_system": "postgres_operational"},
}
EXTRACTABLE_TABLES = frozenset({"survey_responses", "afrobarometer_survey_data"})

BUSINESS_BUNDLE = {
    "country_kpis": "country_survey_kpis_gold",
    "demographics": "demographic_distribution_gold",
    "response_trends": "response_volume_trends_gold",
    "governance": "governance_trust_gold",
    "democracy": "democracy_perception_gold",
    "corruption": "corruption_perception_gold",
    "election": "election_fairness_gold",
    "population": "population_coverage_gold",
}
PLATFORM_BUNDLE = {
    "data_quality": "data_quality_summary_gold",
    "reliability": "reliability_index_gold",
    "pipeline_runtime": "pipeline_runtime_gold",
    "pipeline_status": "pipeline_status_gold",
    "data_freshness": "data_freshness_gold",
}
REPORT_BUNDLE = {
    **{name: table for name, table in BUSINESS_BUNDLE.items() if name not in ("demographics", "response_trends")},
    **PLATFORM_BUNDLE,
}
