"""Clean to business tables.

The clean responses are read for the rollup, the demographics, the daily
trends, the answers per corruption level and the one-row profile; the other
nine tables are read off the written rollup and profile.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from pollstone.contracts.catalog import GOLD
from pollstone.operators import quality, rollups
from pollstone.plans.bookkeeping import record_keys
from pollstone.sources.readers import read_silver
from pollstone.sources.registry import Lake
from pollstone.sources.writers import write_gold


# Grouped rows that three of the tables are read off.
COUNTS = {
    "demographics": rollups.demographic_counts,
    "daily": rollups.daily_responses,
    "levels": rollups.level_counts,
}


def gold_tables(
    tables: Mapping[str, DataFrame],
    rollup: DataFrame,
    profile: DataFrame,
    now: Column | None = None,
    counts: Mapping[str, DataFrame] | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each of the fourteen business tables; nothing runs before a builder is called.

    ``counts`` holds the grouped rows of the demographics, days and levels; without
    them they are grouped from ``tables["survey_responses"]``.
    """
    counts = counts or {name: group(tables["survey_responses"]) for name, group in COUNTS.items()}
    population = tables["world_bank_population"]
    countries = tables["country_reference"]
    return {
        "country_survey_kpis_gold": partial(rollups.kpis_from_rollup, rollup, countries, population, now),
        "demographic_distribution_gold": partial(rollups.demographics_from_counts, counts["demographics"], now),
        "response_volume_trends_gold": partial(rollups.trends_from_daily, counts["daily"], now),
        **{name: partial(rollups.perception_from_rollup, rollup, name, now) for name in rollups.PERCEPTIONS},
        "corruption_levels_gold": partial(rollups.levels_from_counts, counts["levels"], now),
        "population_coverage_gold": partial(rollups.coverage_from_rollup, rollup, population, now),
        "data_quality_summary_gold": partial(quality.data_quality_summary, profile, processed_at=now),
        "reliability_index_gold": partial(quality.reliability_index, profile, now=now),
        "pipeline_runtime_gold": partial(quality.pipeline_runtime, profile, now=now),
        "pipeline_status_gold": partial(quality.pipeline_status, profile, now=now),
        "data_freshness_gold": partial(quality.data_freshness, profile, now=now),
    }


def run_silver_to_gold(
    spark: SparkSession, lake: Lake, now: Column | None = None, run_id: str | None = None
) -> dict[str, int]:
    """Write every business table and return its row count; keys are checked on the written tables."""
    tables = read_silver(spark, lake.silver)
    survey = tables["survey_responses"]
    run = run_id or str(uuid.uuid4())

    def written(df: DataFrame, name: str) -> DataFrame:
        path = f"{lake.meta}/staging/{name}_{run}"
        write_gold(df, path)
        return spark.read.parquet(path)

    rollup = written(rollups.place_rollup(survey), "place_rollup")
    profile = written(quality.response_profile(survey), "response_profile")
    return write_tables(spark, lake, gold_tables(tables, rollup, profile, now), run)


def write_tables(spark: SparkSession, lake: Lake, tables: Mapping[str, Callable[[], DataFrame]], run: str) -> dict[str, int]:
    counts = {}
    for name, build in tables.items():
        path = f"{lake.gold}/{name}"
        counts[name] = write_gold(build(), path, GOLD[name])
        if GOLD[name].primary_key:
            record_keys(spark, lake, run, GOLD[name], spark.read.parquet(path))
    return counts
