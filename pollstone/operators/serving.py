"""What dashboards and reports read: summaries, KPIs, rankings, chart tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pollstone.functions.expr import stable_mean


def country_summary(kpis: DataFrame) -> DataFrame:
    """Responses per country with the completion rate weighted by responses."""
    sums = kpis.groupBy("country").agg(
        F.sum("total_responses").alias("total_responses"),
        F.sum("completed_responses").alias("completed_responses"),
        F.sum("incomplete_responses").alias("incomplete_responses"),
    )
    rate = F.col("completed_responses") / F.nullif(F.col("total_responses"), F.lit(0)) * 100
    return sums.withColumn("completion_rate", rate)


def business_kpis(kpis: DataFrame, trust: DataFrame) -> DataFrame:
    """One row: responses, countries, mean completion rate and mean trust.

    The means are over table rows, not weighted by responses.
    """
    return kpis.agg(
        F.sum("total_responses").alias("total_responses"),
        F.count_distinct("country").alias("countries_covered"),
        stable_mean("completion_rate").alias("average_completion_rate"),
    ).withColumn(
        "average_governance_trust_score", trust.agg(stable_mean("average_trust_score")).scalar()
    )


def business_kpi_texts(kpis: DataFrame, trust: DataFrame) -> DataFrame:
    """The business KPIs as a report prints them."""
    return business_kpis(kpis, trust).select(
        F.format_number("total_responses", 0).alias("total_responses"),
        F.col("countries_covered").cast("string").alias("countries_covered"),
        F.format_string("%.2f%%", "average_completion_rate").alias("average_completion_rate"),
        F.format_string("%.2f", "average_governance_trust_score").alias("average_governance_trust_score"),
    )


def platform_kpis(status: DataFrame, quality: DataFrame, reliability: DataFrame, freshness: DataFrame) -> DataFrame:
    """One row: pipeline status, quality status, reliability index and freshness status."""
    return status.select(
        "pipeline_status",
        quality.select("quality_status").scalar().alias("quality_status"),
        F.format_string("%.2f%%", reliability.select("overall_reliability_index").scalar()).alias(
            "reliability_index"
        ),
        freshness.select("freshness_status").scalar().alias("freshness_status"),
    )


def country_means(table: DataFrame, score: str) -> DataFrame:
    """Mean score per country over its regions; rows without a country or score are left out."""
    known = table.dropna(subset=["country", score])
    return known.groupBy("country").agg(stable_mean(score).alias(score))


def responses_by_gender(demographics: DataFrame) -> DataFrame:
    known = demographics.dropna(subset=["gender", "response_count"])
    return known.groupBy("gender").agg(F.sum("response_count").alias("response_count"))


def ranked(table: DataFrame, score: str, key: str = "country", descending: bool = True) -> DataFrame:
    """Rows that have key and score, in rank order; equal scores by key."""
    order = F.col(score).desc() if descending else F.col(score).asc()
    return table.dropna(subset=[key, score]).orderBy(order, F.col(key).asc())


def with_rank(table: DataFrame, score: str, key: str = "country") -> DataFrame:
    """Rows that have key and score, with their place by falling score, then by key; for one row per key."""
    known = table.dropna(subset=[key, score])
    return known.withColumn("rank", F.row_number().over(Window.orderBy(F.col(score).desc(), F.col(key).asc())))


def top(table: DataFrame, score: str, n: int = 10, key: str = "country") -> DataFrame:
    return ranked(table, score, key).limit(n)


def bottom(table: DataFrame, score: str, n: int = 10, key: str = "country") -> DataFrame:
    return ranked(table, score, key, descending=False).limit(n)


def preview(table: DataFrame, n: int = 10) -> DataFrame:
    return table.limit(n)


# Order in which business tables are shown.
GOLD_ORDER: dict[str, list[tuple[str, bool]]] = {
    "response_volume_trends_gold": [("country", False), ("submission_date", False), ("region", False)],
    "governance_trust_gold": [("average_trust_score", True)],
    "democracy_perception_gold": [("average_democracy_score", True)],
    "corruption_perception_gold": [("corruption_index", True)],
    "election_fairness_gold": [("average_fairness_score", True)],
    "population_coverage_gold": [("responses_per_million", True)],
}


def in_display_order(table: DataFrame, name: str) -> DataFrame:
    """Sort when a table is read, not when it is written."""
    order = GOLD_ORDER.get(name)
    if not order:
        return table
    ties = [key for key in ("country", "region") if key in table.columns and key not in dict(order)]
    return table.orderBy(
        *[F.col(name).desc() if down else F.col(name).asc() for name, down in order], *[F.col(key) for key in ties]
    )


def as_metrics(
    table: DataFrame,
    names: Mapping[str, str],
    ids: Sequence[str] = (),
    metric: str = "metric",
    value: str = "score",
    kind: str = "double",
) -> DataFrame:
    """Named columns to (metric, value) rows."""
    wide = table.select(*ids, *[F.col(column).cast(kind).alias(label) for column, label in names.items()])
    return wide.unpivot(list(ids), list(names.values()), metric, value)


# Chart labels.
QUALITY_SCORES = {
    "completeness_percentage": "Completeness",
    "validity_percentage": "Validity",
    "uniqueness_percentage": "Uniqueness",
}
RECORD_COUNTS = {
    "valid_records": "Valid Records",
    "invalid_records": "Invalid Records",
    "duplicate_records": "Duplicate Records",
}
JOB_COUNTS = {
    "successful_jobs": "Successful Jobs",
    "failed_jobs": "Failed Jobs",
    "warning_jobs": "Warning Jobs",
}
RELIABILITY_SCORES = {
    "completeness_score": "Completeness",
    "validity_score": "Validity",
    "uniqueness_score": "Uniqueness",
    "overall_reliability_index": "Overall Reliability",
}


def quality_scores(quality: DataFrame) -> DataFrame:
    return as_metrics(quality, QUALITY_SCORES)


def record_breakdown(quality: DataFrame) -> DataFrame:
    return as_metrics(quality, RECORD_COUNTS, value="records", kind="bigint")


def job_health(status: DataFrame) -> DataFrame:
    return as_metrics(status, JOB_COUNTS, value="jobs", kind="bigint")


def reliability_breakdown(reliability: DataFrame) -> DataFrame:
    return as_metrics(reliability, RELIABILITY_SCORES)


def civic_comparison(democracy: DataFrame, fairness: DataFrame) -> DataFrame:
    """Democracy and fairness index side by side per country, as chart rows.

    Both tables are reduced to one row per country before the full join, so
    regions cannot multiply each other.
    """
    left = democracy.groupBy("country").agg(stable_mean("democracy_index").alias("democracy_index"))
    right = fairness.groupBy("country").agg(stable_mean("fairness_index").alias("fairness_index"))
    wide = left.join(right, "country", "full")
    return wide.unpivot(["country"], ["democracy_index", "fairness_index"], "metric", "score")


MAP_COLUMNS = ("country", "total_responses", "population", "responses_per_million")


def coverage_map(coverage: DataFrame) -> DataFrame:
    return coverage.select(*MAP_COLUMNS).orderBy(F.col("responses_per_million").desc(), "country")
