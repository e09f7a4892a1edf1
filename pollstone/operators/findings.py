"""Rule-based findings: a metric, its thresholds and the text for each severity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollstone.functions.expr import count_where, stable_mean, two_decimals


@dataclass(frozen=True)
class Outcome:
    severity: str
    title: str
    message: str
    recommendation: str


@dataclass(frozen=True)
class Check:
    """Outcomes with the limit of each one but the last, which takes the rest.

    ``test`` is ``below`` (metric < limit), ``from`` (metric >= limit),
    ``is`` or ``is_not`` (text equality without case). A NULL metric matches no
    limit and therefore takes the last outcome.
    """

    category: str
    test: str
    limits: tuple
    outcomes: tuple[Outcome, ...]


# Thresholds, titles, messages and recommendations of the report.
COMPLETION = Check(
    "Survey Participation", "below", (70, 85),
    (
        Outcome("High", "Low Average Completion Rate",
                "The average survey completion rate is {}%, which is below the recommended 70% threshold.",
                "Review survey length, respondent experience, and possible technical barriers affecting completion."),
        Outcome("Medium", "Moderate Completion Rate",
                "The average survey completion rate is {}%. This is acceptable but still has room for improvement.",
                "Monitor completion trends and identify countries or regions with lower participation quality."),
        Outcome("Low", "Strong Completion Rate",
                "The average survey completion rate is {}%, indicating strong respondent completion behavior.",
                "Maintain current survey design and continue monitoring for regional variation."),
    ),
)
TRUST = Check(
    "Governance Trust", "below", (2.5, 3.5),
    (
        Outcome("High", "Low Governance Trust",
                "The average governance trust score is {}, suggesting weak public confidence.",
                "Prioritize deeper review of countries and regions with the lowest trust scores."),
        Outcome("Medium", "Moderate Governance Trust",
                "The average governance trust score is {}, indicating mixed citizen sentiment.",
                "Track trust indicators over time and compare with democracy and corruption perception metrics."),
        Outcome("Low", "Healthy Governance Trust",
                "The average governance trust score is {}, indicating relatively positive public trust.",
                "Maintain monitoring and investigate regional differences behind the aggregate score."),
    ),
)
DEMOCRACY = Check(
    "Democracy Perception", "below", (40, 60),
    (
        Outcome("High", "Weak Democracy Perception",
                "The average democracy index is {}%, indicating weak perception of democratic quality.",
                "Identify the countries with the weakest democracy index and compare with governance trust and election fairness metrics."),
        Outcome("Medium", "Moderate Democracy Perception",
                "The average democracy index is {}%, suggesting mixed perceptions of democratic performance.",
                "Monitor democracy perception trends and investigate countries with declining sentiment."),
        Outcome("Low", "Positive Democracy Perception",
                "The average democracy index is {}%, suggesting generally positive democratic perception.",
                "Continue monitoring democracy perception alongside election fairness and governance trust."),
    ),
)
CORRUPTION = Check(
    "Corruption Perception", "from", (70, 40),
    (
        Outcome("High", "High Corruption Perception",
                "The average corruption perception index is {}%, indicating elevated perceived corruption.",
                "Prioritize deeper investigation into countries and regions with the highest corruption perception levels."),
        Outcome("Medium", "Moderate Corruption Perception",
                "The average corruption perception index is {}%, suggesting corruption perception requires monitoring.",
                "Compare corruption perception with trust and democracy scores to identify possible governance risk clusters."),
        Outcome("Low", "Low Corruption Perception",
                "The average corruption perception index is {}%, suggesting relatively lower perceived corruption.",
                "Maintain periodic monitoring and watch for regional spikes."),
    ),
)
FAIRNESS = Check(
    "Election Fairness", "below", (40, 60),
    (
        Outcome("High", "Low Election Fairness Perception",
                "The average election fairness index is {}%, indicating weak confidence in election fairness.",
                "Review countries with low fairness scores and compare them with democracy perception metrics."),
        Outcome("Medium", "Moderate Election Fairness Perception",
                "The average election fairness index is {}%, suggesting mixed citizen confidence.",
                "Track fairness perception over time and identify countries with persistent concerns."),
        Outcome("Low", "Positive Election Fairness Perception",
                "The average election fairness index is {}%, suggesting relatively positive election fairness perception.",
                "Maintain monitoring and compare results with governance trust indicators."),
    ),
)
COVERAGE = Check(
    "Population Coverage", "below", (10, 50),
    (
        Outcome("High", "Very Low Population Coverage",
                "The average survey coverage is {} responses per million people, which is very low.",
                "Increase respondent outreach and improve geographic sampling coverage."),
        Outcome("Medium", "Limited Population Coverage",
                "The average survey coverage is {} responses per million people.",
                "Expand survey distribution to improve representativeness across countries."),
        Outcome("Low", "Acceptable Population Coverage",
                "The average survey coverage is {} responses per million people.",
                "Maintain survey coverage and compare country-level sampling gaps."),
    ),
)
STATUS = Check(
    "Pipeline Health", "is_not", ("SUCCESS",),
    (
        Outcome("High", "Pipeline Execution Issue",
                "The latest pipeline status is {}, meaning the ETL process did not complete successfully.",
                "Review Airflow logs, Spark job logs, and failed task dependencies immediately."),
        Outcome("Low", "Pipeline Execution Successful",
                "The latest pipeline execution completed successfully.",
                "Continue monitoring runtime, freshness, and data quality indicators."),
    ),
)
RELIABILITY = Check(
    "Reliability", "below", (70, 85),
    (
        Outcome("High", "Low Reliability Index",
                "The overall reliability index is {}%, which is below the safe threshold.",
                "Investigate validation failures, duplicate records, and missing values in the Silver and Gold layers."),
        Outcome("Medium", "Moderate Reliability Index",
                "The overall reliability index is {}%. The platform is usable but should be monitored.",
                "Review data validation rules and monitor duplicate or invalid record trends."),
        Outcome("Low", "Strong Reliability Index",
                "The overall reliability index is {}%, indicating strong data reliability.",
                "Maintain the current validation and deduplication checks."),
    ),
)
FRESHNESS = Check(
    "Data Freshness", "is", ("very stale", "stale"),
    (
        Outcome("High", "Very Stale Dataset",
                "The dataset is marked as very stale, meaning the dashboard may not reflect recent survey activity.",
                "Trigger a new ingestion and transformation run through Airflow."),
        Outcome("Medium", "Stale Dataset",
                "The dataset is stale and may require refresh soon.",
                "Confirm whether the scheduled pipeline has run successfully within the expected refresh window."),
        Outcome("Low", "Fresh Dataset",
                "The dataset freshness status is healthy.",
                "Continue scheduled refresh monitoring."),
    ),
)
# Headline of the report per worst severity.
BANNERS = {
    "High": "The latest analytics contain high-risk findings that should be reviewed by stakeholders.",
    "Medium": "The latest analytics show moderate issues that require monitoring.",
    "Low": "The latest analytics show stable business and platform health.",
}

METRIC = "_metric"


def _holds(check: Check, limit) -> Column:
    metric = F.col(METRIC)
    if check.test == "below":
        return metric < limit
    if check.test == "from":
        return metric >= limit
    same = F.lower(metric) == str(limit).lower()
    return same if check.test == "is" else ~F.coalesce(same, F.lit(False))


def finding(metric: DataFrame, check: Check) -> DataFrame:
    """One finding from a one-row, one-column metric."""
    numeric = check.test in ("below", "from")
    shown = two_decimals(F.col(METRIC)) if numeric else F.upper(F.coalesce(F.col(METRIC), F.lit("NONE")))

    def row(outcome: Outcome) -> Column:
        before, _, after = outcome.message.partition("{}")
        message = F.concat(F.lit(before), shown, F.lit(after)) if "{}" in outcome.message else F.lit(before)
        return F.struct(
            F.lit(outcome.severity).alias("severity"),
            F.lit(check.category).alias("category"),
            F.lit(outcome.title).alias("title"),
            message.alias("message"),
            F.lit(outcome.recommendation).alias("recommendation"),
        )

    picked = [F.when(_holds(check, limit), row(outcome)) for limit, outcome in zip(check.limits, check.outcomes)]
    chosen = F.coalesce(*picked, row(check.outcomes[-1]))
    return metric.toDF(METRIC).select(chosen.alias("f")).select("f.*")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def business_findings(
    kpis: DataFrame,
    trust: DataFrame,
    democracy: DataFrame,
    corruption: DataFrame,
    fairness: DataFrame,
    coverage: DataFrame,
) -> DataFrame:
    """Six findings, each on the plain mean of a business table column."""
    measured = (
        (kpis, "completion_rate", COMPLETION),
        (trust, "average_trust_score", TRUST),
        (democracy, "democracy_index", DEMOCRACY),
        (corruption, "corruption_index", CORRUPTION),
        (fairness, "fairness_index", FAIRNESS),
        (coverage, "responses_per_million", COVERAGE),
    )
    return _union([finding(table.agg(stable_mean(column)), check) for table, column, check in measured])


def platform_findings(status: DataFrame, reliability: DataFrame, freshness: DataFrame) -> DataFrame:
    """Three findings on pipeline status, reliability and freshness."""
    return _union(
        [
            finding(status.select("pipeline_status"), STATUS),
            finding(reliability.select("overall_reliability_index"), RELIABILITY),
            finding(freshness.select("freshness_status"), FRESHNESS),
        ]
    )


def report_findings(business: DataFrame, platform: DataFrame) -> DataFrame:
    return business.withColumn("scope", F.lit("business")).unionByName(
        platform.withColumn("scope", F.lit("platform"))
    )


def risk_summary(findings: DataFrame) -> DataFrame:
    """One row: findings per severity, their total and the headline."""
    counts = findings.agg(
        *[
            F.coalesce(count_where(F.col("severity") == level), F.lit(0)).alias(f"{level.lower()}_risk_count")
            for level in ("High", "Medium", "Low")
        ],
        F.count(F.lit(1)).alias("total_findings"),
    )
    headline = (
        F.when(F.col("high_risk_count") > 0, BANNERS["High"])
        .when(F.col("medium_risk_count") > 0, BANNERS["Medium"])
        .otherwise(BANNERS["Low"])
    )
    return counts.withColumn("headline", headline)
