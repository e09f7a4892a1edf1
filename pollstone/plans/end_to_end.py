"""The whole way in dependency order: ingestion, clean tables, business tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from pollstone.operators.reference import COUNTRIES
from pollstone.plans.bookkeeping import record_run
from pollstone.plans.gold import run_silver_to_gold
from pollstone.plans.ingest import ingest_files, ingest_payloads, ingest_table
from pollstone.plans.silver import SurveyChoices, run_bronze_to_silver
from pollstone.sources.registry import API_SOURCES, Lake


def run_all(
    spark: SparkSession,
    lake: Lake,
    raw_files: str,
    raw_answers: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    now: Column | None = None,
    choices: SurveyChoices = SurveyChoices(),
    countries: Sequence[str] | Column = COUNTRIES,
) -> dict[str, dict]:
    """Database tables, files and answers, then clean, then business tables.

    ``raw_answers`` holds one folder per service; ``tables`` are extracted
    database tables by name.
    """
    loaded = {name: ingest_table(spark, rows, lake, name) for name, rows in (tables or {}).items()}
    files = ingest_files(spark, raw_files, lake, countries=countries)
    sources = API_SOURCES if raw_answers else ()
    answers = {name: ingest_payloads(spark, f"{raw_answers}/{name}", lake, name) for name in sources}
    run = str(uuid.uuid4())
    record_run(spark, lake, run, "silver_and_gold", "running", run_type="full")
    try:
        silver = run_bronze_to_silver(spark, lake, now, with_database=bool(loaded), choices=choices, run_id=run)
        gold = run_silver_to_gold(spark, lake, now, run)
    except Exception as error:
        record_run(spark, lake, run, "silver_and_gold", "failed", error_message=str(error))
        raise
    record_run(spark, lake, run, "silver_and_gold", "success", silver["survey_responses"])
    return {"tables": loaded, "files": files, "answers": answers, "silver": silver, "gold": gold}
