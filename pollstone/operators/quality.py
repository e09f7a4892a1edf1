"""Data quality and platform metrics.

All one-row tables are read off one profile of the responses, a single global
aggregate, so five tables need one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollstone.functions.expr import (
    completed,
    count_where,
    freshness_band,
    percent,
    quality_band,
    scaled_ratio,
)
from pollstone.operators.dedup import COPIES
from pollstone.operators.rollups import duplicate_count, gold_marks

# Columns that count towards completeness.
TRACKED_COLUMNS = (
    "response_id",
    "respondent_id",
    "survey_id",
    "country",
    "region",
    "gender",
    "age",
    "completion_status",
    "submission_timestamp",
    "silver_processed_at",
    "source_system",
)
REFRESH = "Daily"
DATASET = "survey_responses"
PIPELINE = "survey_pipeline"
GOLD_PIPELINE = "survey_silver_to_gold"


def missing_cells(columns: Sequence[str] = TRACKED_COLUMNS) -> Column:
    """Number of NULLs in the listed columns of one row."""
    flags = [F.col(name).isNull().cast("int") for name in columns]
    return sum(flags[1:], flags[0])


def response_profile(survey: DataFrame, grain: Sequence[str] = ()) -> DataFrame:
    """One row (or one for each ``grain``): counts, missing cells and first and last processing time."""
    return survey.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("total"),
        count_where(completed()).alias("valid"),
        count_where(~completed()).alias("invalid"),
        F.coalesce(duplicate_count(survey), F.lit(0)).alias("duplicates"),
        F.sum(missing_cells()).cast("bigint").alias("missing"),
        F.min("silver_processed_at").alias("first_processed"),
        F.max("silver_processed_at").alias("last_processed"),
    )


def whole_profile(profiles: DataFrame) -> DataFrame:
    """The one row of :func:`response_profile`, from the rows of a finer grain."""
    sums = [F.sum(name).cast("bigint").alias(name) for name in ("valid", "invalid", "missing")]
    zeros = {name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in ("total", "duplicates")}
    return profiles.agg(
        zeros["total"],
        *sums[:2],
        zeros["duplicates"],
        sums[2],
        F.min("first_processed").alias("first_processed"),
        F.max("last_processed").alias("last_processed"),
    )


def _scores(profile: DataFrame) -> DataFrame:
    total, cells = F.col("total"), F.col("total") * len(TRACKED_COLUMNS)
    filled = cells - F.col("missing")
    # Duplicates were removed before, so they count against what arrived.
    unique = percent(total, total + F.col("duplicates"))
    share = len(TRACKED_COLUMNS)
    # Mean of the unrounded completeness, validity and uniqueness: one ratio
    # over a common denominator when nothing was removed.
    plain = percent(filled + share * F.col("valid") + cells, 3 * cells)
    reduced = F.round(
        (
            scaled_ratio(filled, cells, "100.0", None)
            + scaled_ratio(F.col("valid"), total, "100.0", None)
            + scaled_ratio(total, total + F.col("duplicates"), "100.0", None)
        )
        / 3,
        2,
    )
    return profile.select(
        "*",
        percent(filled, cells).alias("completeness"),
        percent(F.col("valid"), total).alias("validity"),
        F.when(F.col("duplicates") == 0, F.lit(100.0)).otherwise(unique).alias("uniqueness"),
        F.when(F.col("duplicates") == 0, plain).otherwise(reduced).alias("overall"),
    )


def data_quality_summary(
    profile: DataFrame, dataset: str = DATASET, processed_at: Column | None = None
) -> DataFrame:
    """Counts, completeness, validity and uniqueness; the status follows validity."""
    table = _scores(profile).select(
        F.lit(dataset).alias("dataset_name"),
        F.col("total").alias("total_records"),
        F.col("valid").alias("valid_records"),
        F.col("invalid").alias("invalid_records"),
        F.col("duplicates").alias("duplicate_records"),
        F.col("missing").alias("missing_value_count"),
        F.col("completeness").alias("completeness_percentage"),
        F.col("validity").alias("validity_percentage"),
        F.col("uniqueness").alias("uniqueness_percentage"),
        quality_band(F.col("validity")).alias("quality_status"),
    )
    return gold_marks(table, processed_at, layers=False)


def _now(now: Column | None) -> Column:
    return F.current_timestamp() if now is None else now


def reliability_index(
    profile: DataFrame, pipeline: str = PIPELINE, now: Column | None = None
) -> DataFrame:
    """Three scores and the band of their mean."""
    table = _scores(profile).select(
        F.lit(pipeline).alias("pipeline_name"),
        _now(now).alias("execution_date"),
        F.col("total").alias("total_records_processed"),
        F.col("valid").alias("valid_records"),
        F.col("invalid").alias("invalid_records"),
        F.col("duplicates").alias("duplicate_records"),
        F.col("completeness").alias("completeness_score"),
        F.col("validity").alias("validity_score"),
        F.col("uniqueness").alias("uniqueness_score"),
        F.col("overall").alias("overall_reliability_index"),
        quality_band(F.col("overall")).alias("reliability_status"),
    )
    return gold_marks(table, now, layers=False)


def pipeline_runtime(
    profile: DataFrame, pipeline: str = GOLD_PIPELINE, now: Column | None = None
) -> DataFrame:
    """Span between the first and last processing time of the rows."""
    seconds = F.unix_timestamp("last_processed") - F.unix_timestamp("first_processed")
    table = profile.select(
        F.lit(pipeline).alias("pipeline_name"),
        _now(now).alias("execution_date"),
        seconds.cast("double").alias("runtime_seconds"),
        scaled_ratio(seconds, F.lit(60)).alias("runtime_minutes"),
        F.lit("SUCCESS").alias("status"),
        F.col("total").alias("records_processed"),
    )
    return gold_marks(table, now, layers=False)


def pipeline_status(
    profile: DataFrame, pipeline: str = GOLD_PIPELINE, now: Column | None = None
) -> DataFrame:
    """SUCCESS when rows arrived; completed and incomplete responses stand for jobs."""
    table = profile.select(
        F.lit(pipeline).alias("pipeline_name"),
        _now(now).alias("execution_date"),
        F.when(F.col("total") > 0, "SUCCESS").otherwise("FAILED").alias("pipeline_status"),
        F.col("valid").alias("successful_jobs"),
        F.col("invalid").alias("failed_jobs"),
        F.lit(0).cast("bigint").alias("warning_jobs"),
        percent(F.col("valid"), F.col("total")).alias("overall_health_score"),
    )
    return gold_marks(table, now, layers=False)


def _freshness_columns(now: Column | None) -> list[Column]:
    age = F.unix_timestamp(_now(now)) - F.unix_timestamp("last_processed")
    return [
        F.col("first_processed").alias("last_ingestion_timestamp"),
        F.col("last_processed").alias("last_update_timestamp"),
        scaled_ratio(age, F.lit(3600)).alias("freshness_hours"),
        freshness_band(scaled_ratio(age, F.lit(3600), "1", None)).alias("freshness_status"),
        F.lit(REFRESH).alias("expected_refresh_frequency"),
    ]


def data_freshness(profile: DataFrame, dataset: str = DATASET, now: Column | None = None) -> DataFrame:
    """Hours since the last processing time, banded on the exact value."""
    table = profile.select(F.lit(dataset).alias("dataset_name"), *_freshness_columns(now))
    return gold_marks(table, now, layers=False)


def freshness_by_country(survey: DataFrame, now: Column | None = None) -> DataFrame:
    """Freshness and last submission per country, in hours and minutes."""
    spans = survey.groupBy("country").agg(
        F.min("silver_processed_at").alias("first_processed"),
        F.max("silver_processed_at").alias("last_processed"),
        F.max("submission_timestamp").alias("last_submission"),
    )
    age = F.unix_timestamp(_now(now)) - F.unix_timestamp("last_processed")
    return spans.select(
        "country",
        *_freshness_columns(now),
        scaled_ratio(age, F.lit(60)).alias("freshness_minutes"),
        "last_submission",
    )


# Checks of the per-country quality metrics: name and smallest accepted score.
COMPLETENESS_FLOOR = 95.0
DUPLICATE_CEILING = 0.0
VALIDITY_FLOOR = 70.0


def quality_by_country(
    survey: DataFrame,
    dataset: str = DATASET,
    key: str = "response_id",
    columns: Sequence[str] = TRACKED_COLUMNS,
) -> DataFrame:
    """Completeness, duplicate rate, NULL share, status and failed checks per country.

    Grouping by (country, key) first keeps a country with a third of the rows
    spread out and gives the number of distinct keys without a second pass.
    Rows that carry ``copies`` count as that many in the duplicate rate.
    """
    tracked = [name for name in columns if name in survey.columns]
    per_key = survey.groupBy("country", key).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.sum(COPIES) if COPIES in survey.columns else F.count(F.lit(1))).alias("arrived"),
        count_where(completed()).alias("valid"),
        F.sum(missing_cells(tracked)).cast("bigint").alias("missing"),
    )
    per_country = per_key.groupBy("country").agg(
        F.sum("rows").alias("rows"),
        F.sum("arrived").alias("arrived"),
        F.count(F.lit(1)).alias("keys"),
        F.sum("valid").alias("valid"),
        F.sum("missing").alias("missing"),
    )
    rows, cells = F.col("rows"), F.col("rows") * len(tracked)
    scored = per_country.select(
        "country",
        F.lit(dataset).alias("dataset_name"),
        percent(cells - F.col("missing"), cells).alias("completeness_score"),
        percent(F.col("arrived") - F.col("keys"), F.col("arrived")).alias("duplicate_rate"),
        percent(F.col("missing"), cells).alias("null_percentage"),
        percent(F.col("valid"), rows).alias("_validity"),
    )
    checks = {
        "completeness": F.col("completeness_score") < COMPLETENESS_FLOOR,
        "duplicates": F.col("duplicate_rate") > DUPLICATE_CEILING,
        "validity": F.col("_validity") < VALIDITY_FLOOR,
    }
    failed = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))
    return scored.select(
        "country",
        "dataset_name",
        "completeness_score",
        "duplicate_rate",
        "null_percentage",
        F.when(F.size(failed) == 0, "passed").otherwise("failed").alias("validation_status"),
        failed.alias("failed_checks"),
    )


def cleaning_reduction(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows deduplication by key removes, and their share of what arrived."""
    per_key = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    counts = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counts.select(
        "rows_before",
        "rows_after",
        removed.alias("duplicates_removed"),
        percent(removed, F.col("rows_before")).alias("cleaning_reduction_percentage"),
    )
