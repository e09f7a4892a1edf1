"""Raw to clean: read, check the contract, clean, deduplicate, check, publish.

Raw responses that break their contract are written to
``<lake>/meta/rejects/survey_responses/run_id=...`` with what they break. They
stay in the clean table, without the unfit values, unless
``SurveyChoices.hold_back`` is set.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollstone.contracts.catalog import BRONZE_SURVEY
from pollstone.contracts.model import ERRORS
from pollstone.operators.cleaning import LOAD_TIME, clean_dataset
from pollstone.operators.dedup import COPIES, dedup_dataset, merge_survey_responses
from pollstone.operators.reference import standardize_country_names, with_country_codes, with_row_checks
from pollstone.operators.validation import ValidationError, require_valid
from pollstone.plans.bookkeeping import read_book, record_quality
from pollstone.sources.readers import JSON_RECORDS, read_bronze, union_all
from pollstone.sources.registry import Dataset, Lake, bronze_datasets, database_snapshots
from pollstone.sources.writers import default_partitions, write_silver


@dataclass(frozen=True)
class SurveyChoices:
    """How the clean responses are built.

    ``aliases`` maps other spellings of countries (a dict, or rows of ``alias``
    and ``country_name``). ``publish_copies`` keeps the number of copies per
    response, and with it the true duplicate counts in the business tables.
    ``hold_back`` leaves out raw rows that break the contract.
    """

    aliases: Mapping[str, str] | DataFrame | None = None
    publish_copies: bool = False
    hold_back: bool = False


def read_dataset(spark: SparkSession, dataset: Dataset, errors: bool = False) -> DataFrame:
    """Raw rows with declared types and the time of their file; no inference scan.

    With ``errors`` each response also lists what it breaks of its contract.
    """
    if dataset.name == "survey_responses":
        raw = read_bronze(spark, dataset.input_glob, dataset.format, BRONZE_SURVEY, file_time=True)
        check = BRONZE_SURVEY.with_errors if errors else BRONZE_SURVEY.conform
        return check(raw, keep_extra=True)
    return read_bronze(
        spark,
        dataset.input_glob,
        dataset.format,
        json_record=JSON_RECORDS.get(dataset.name),
        multi_line=dataset.multi_line,
        file_time=True,
    )


def transform_dataset(bronze: DataFrame, name: str, processed_at: Column | None = None) -> DataFrame:
    """Clean rows, the latest load per key; reference tables do not keep the load time."""
    unique = dedup_dataset(clean_dataset(bronze, name, processed_at), name)
    return unique if name == "survey_responses" else unique.drop(LOAD_TIME)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write rows to a side folder and continue from there.

    The checks and the final write then read the same finished rows, and the
    cleaning and its shuffle run once.
    """
    write_silver(df, path)
    return df.sparkSession.read.parquet(path)


def build_dataset(
    spark: SparkSession,
    lake: Lake,
    dataset: Dataset,
    processed_at: Column | None = None,
    run_id: str | None = None,
) -> int:
    """Publish one clean reference table; nothing is published when a rule fails."""
    place = f"{lake.meta}/staging/{dataset.name}_{run_id or uuid.uuid4()}"
    rows = staged(transform_dataset(read_dataset(spark, dataset), dataset.name, processed_at), place)
    require_valid(rows, dataset.name)
    return write_silver(rows, dataset.output_path, default_partitions(rows))


def build_survey(
    spark: SparkSession,
    lake: Lake,
    processed_at: Column | None = None,
    with_database: bool = False,
    choices: SurveyChoices = SurveyChoices(),
    run_id: str | None = None,
) -> int:
    """Publish the clean responses, in the declared columns; nothing is published when a rule fails.

    The raw rows are written once as typed rows with their contract errors;
    rejects and clean rows both come from that copy. Country codes come from
    the published population table, if there is one.
    """
    run = run_id or str(uuid.uuid4())
    dataset = bronze_datasets(lake)["survey_responses"]
    sources = (dataset, database_snapshots(lake)) if with_database else (dataset,)
    bronze = union_all([read_dataset(spark, part, errors=True) for part in sources])
    checked = staged(bronze, f"{lake.meta}/staging/{dataset.name}_raw_{run}")
    broken = F.size(ERRORS) > 0
    checked.filter(broken).write.mode("overwrite").parquet(f"{lake.meta}/rejects/{dataset.name}/run_id={run}")
    fit = (checked.filter(~broken) if choices.hold_back else checked).drop(ERRORS)

    cleaned = clean_dataset(fit, dataset.name, processed_at)
    if choices.aliases is not None:
        cleaned = standardize_country_names(cleaned, choices.aliases)
    rows = staged(merge_survey_responses(cleaned), f"{lake.meta}/staging/{dataset.name}_{run}")
    require_valid(rows, dataset.name)

    codes = read_book(spark, f"{lake.silver}/world_bank_population", "country string, country_code string")
    declared = with_country_codes(with_row_checks(rows), codes)
    published = declared if choices.publish_copies else declared.drop(COPIES)
    written = write_silver(published, dataset.output_path, default_partitions(published))
    record_quality(spark, lake, run, rows)
    return written


def run_bronze_to_silver(
    spark: SparkSession,
    lake: Lake,
    processed_at: Column | None = None,
    with_database: bool = False,
    choices: SurveyChoices = SurveyChoices(),
    run_id: str | None = None,
) -> dict[str, int]:
    """All clean tables; each is built on its own, failures are raised together at the end.

    The reference tables come first, the responses take their country codes from them.
    """
    run = run_id or str(uuid.uuid4())
    written: dict[str, int] = {}
    failures: dict[str, str] = {}
    datasets = bronze_datasets(lake)
    for name in sorted(datasets, key=lambda known: known == "survey_responses"):
        try:
            if name == "survey_responses":
                written[name] = build_survey(spark, lake, processed_at, with_database, choices, run)
            else:
                written[name] = build_dataset(spark, lake, datasets[name], processed_at, run)
        except (ValidationError, PySparkException) as error:
            failures[name] = f"{name}: {error}"
    if failures:
        raise ValidationError("; ".join(failures[name] for name in datasets if name in failures))
    return written
