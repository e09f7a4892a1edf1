"""Business tables built from clean survey responses.

Rows are always grouped before anything is joined or ranked, joins carry no
broadcast hints (Spark broadcasts a side only after measuring it), and every
total is a partial aggregate. ``region`` may be nearly unique, so grouped
tables are treated as large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.functions.expr import (
    age_group,
    completed,
    corruption_band,
    count_where,
    coverage_band,
    join_key,
    per_million,
    percent,
    rounded_mean,
    scaled_ratio,
)
from pollstone.functions.running import running_total
from pollstone.operators.dedup import COPIES
from pollstone.operators.reference import KEY, latest_population, unique_countries

PLACE = ("country", "region")


def gold_marks(df: DataFrame, processed_at: Column | None = None, layers: bool = True) -> DataFrame:
    """Add the load time and, for business tables, the layer names."""
    added = {"gold_processed_at": F.current_timestamp() if processed_at is None else processed_at}
    if layers:
        added |= {"source_layer": F.lit("silver"), "target_layer": F.lit("gold")}
    return df.withColumns(added)


def duplicate_count(survey: DataFrame) -> Column:
    """Removed copies when the rows still know them (``copies``), else zero."""
    if COPIES in survey.columns:
        return F.sum(F.col(COPIES) - 1).cast("bigint")
    return F.lit(0).cast("bigint")


def response_counts(survey: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Total, completed and incomplete responses; a NULL status is neither."""
    return survey.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("total_responses"),
        count_where(completed()).alias("completed_responses"),
        count_where(~completed()).alias("incomplete_responses"),
        duplicate_count(survey).alias("duplicate_responses"),
    )


def country_survey_kpis(
    survey: DataFrame,
    reference: DataFrame,
    population: DataFrame,
    grain: Sequence[str] = PLACE,
    processed_at: Column | None = None,
) -> DataFrame:
    """Participation per country and region, with subregion and responses per million people."""
    return _kpi_columns(response_counts(survey, grain), reference, population, grain, processed_at)


def _kpi_columns(
    counts: DataFrame,
    reference: DataFrame,
    population: DataFrame,
    grain: Sequence[str],
    processed_at: Column | None,
) -> DataFrame:
    keyed = counts.withColumn("_key", join_key(F.col("country")))
    places = unique_countries(reference).withColumnRenamed(KEY, "_place_key")
    people = latest_population(population)
    joined = keyed.join(places, F.col("_key") == F.col("_place_key"), "left").join(
        people, F.col("_key") == F.col(KEY), "left"
    )
    table = joined.select(
        *grain,
        "subregion",
        "total_responses",
        "completed_responses",
        "incomplete_responses",
        percent(F.col("completed_responses"), F.col("total_responses")).alias("completion_rate"),
        F.col("completed_responses").alias("valid_responses"),
        F.col("incomplete_responses").alias("invalid_responses"),
        "duplicate_responses",
        F.col("population").alias("country_population"),
        per_million(F.col("total_responses"), F.col("population")).alias("response_rate_per_million"),
    )
    return gold_marks(table, processed_at)


def demographic_counts(survey: DataFrame) -> DataFrame:
    return survey.groupBy(
        "country",
        "region",
        "gender",
        age_group(F.col("age")).alias("age_group"),
        "education_level",
        "employment_status",
    ).agg(F.count(F.lit(1)).alias("response_count"))


def demographic_distribution(survey: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Responses per country, region, gender, age group, education and employment."""
    return demographics_from_counts(demographic_counts(survey), processed_at)


def demographics_from_counts(counts: DataFrame, processed_at: Column | None = None) -> DataFrame:
    # The total is added up from the grouped rows: Spark reuses their shuffle
    # and hands the single number over as a scalar subquery.
    total = counts.agg(F.sum("response_count")).scalar()
    return gold_marks(
        counts.withColumn("percentage_of_total", percent(F.col("response_count"), total)), processed_at
    )


def daily_responses(survey: DataFrame, day: Column | None = None) -> DataFrame:
    return (
        survey.groupBy(
            (F.to_date("submission_timestamp") if day is None else day).alias("submission_date"), *PLACE
        )
        .agg(
            F.count(F.lit(1)).alias("daily_response_count"),
            count_where(completed()).alias("completed_response_count"),
            duplicate_count(survey).alias("duplicate_response_count"),
        )
        .withColumn("valid_response_count", F.col("completed_response_count"))
    )


def response_volume_trends(survey: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Daily responses per country and region with a running total per country.

    Regions of one day are counted in name order, so the running total is the
    same on every run.
    """
    return trends_from_daily(daily_responses(survey), processed_at)


def trends_from_daily(daily: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Same table as :func:`response_volume_trends`, from the daily counts."""
    table = running_total(
        daily,
        group=["country"],
        order=["submission_date", "region"],
        value="daily_response_count",
        output="cumulative_response_count",
        block=F.trunc("submission_date", "month"),
    )
    return gold_marks(table, processed_at)


@dataclass(frozen=True)
class Perception:
    """A question scored 1 to 5 and the names of what is reported about it."""

    question: str
    mean: str
    counts: tuple[str, str, str]
    index: str
    net: bool = True
    level: str | None = None


TRUST = Perception(
    "q3_trust_govt",
    "average_trust_score",
    ("low_trust_count", "medium_trust_count", "high_trust_count"),
    "trust_index",
)
DEMOCRACY = Perception(
    "q1_democracy",
    "average_democracy_score",
    ("negative_perception_count", "neutral_perception_count", "positive_perception_count"),
    "democracy_index",
)
CORRUPTION = Perception(
    "q4_corruption",
    "average_corruption_score",
    ("low_corruption_count", "medium_corruption_count", "high_corruption_count"),
    "corruption_index",
    net=False,
    level="corruption_level",
)
FAIRNESS = Perception(
    "q5_election_fairness",
    "average_fairness_score",
    ("unfair_election_count", "neutral_election_count", "fair_election_count"),
    "fairness_index",
)

# Answer levels as scores, for a question that is answered in words.
LEVEL_SCORES = {"low": 1, "medium": 3, "high": 5}


def question_score(df: DataFrame, question: str, levels: Mapping[str, int] | None = LEVEL_SCORES) -> Column:
    """The answer as a number; words count by ``levels``, other texts give NULL.

    ``levels=None`` reads texts as numbers only, which leaves word answers NULL.
    """
    answer = F.col(question)
    if not isinstance(df.schema[question].dataType, T.StringType):
        return answer.try_cast("double")
    number = answer.try_cast("double")
    if levels is None:
        return number
    # Words first: a failed number conversion is the expensive branch.
    word = F.lower(F.trim(answer))
    return F.coalesce(*[F.when(word == name, F.lit(float(score))) for name, score in levels.items()], number)


def with_scores(df: DataFrame, asked: Sequence[Perception], levels: Mapping[str, int] | None) -> DataFrame:
    """Completion and, per question, whether it counts and its score, worked out once per row."""
    done = df.withColumn("_done", completed())
    scored = {}
    for item in asked:
        answered = F.col("_done") & F.col(item.question).isNotNull()
        scored[f"_answered_{item.question}"] = F.coalesce(answered, F.lit(False))
        scored[f"_score_{item.question}"] = F.when(answered, question_score(df, item.question, levels))
    return done.withColumns(scored)


def score_measures(asked: Perception) -> dict[str, Column]:
    """Aggregates for one question over rows from :func:`with_scores`."""
    score = F.col(f"_score_{asked.question}")
    whole = score.try_cast("int")
    low, middle, high = asked.counts
    return {
        "total_responses": F.count_if(F.col(f"_answered_{asked.question}")),
        asked.mean: rounded_mean(score),
        low: F.count_if(whole <= 2),
        middle: F.count_if(whole == 3),
        high: F.count_if(whole >= 4),
    }


def with_index(table: DataFrame, asked: Perception, keep: Sequence[str]) -> DataFrame:
    """Add the index (share of high answers, minus low ones when it is a net score) and level."""
    low, middle, high = asked.counts
    points = F.col(high) - F.col(low) if asked.net else F.col(high)
    columns = [
        *keep,
        "total_responses",
        asked.mean,
        low,
        middle,
        high,
        percent(points, F.col("total_responses")).alias(asked.index),
    ]
    if asked.level:
        columns.append(corruption_band(F.col(asked.mean)).alias(asked.level))
    return table.select(*columns)


def perception_table(
    survey: DataFrame,
    asked: Perception,
    grain: Sequence[str] = PLACE,
    levels: Mapping[str, int] | None = LEVEL_SCORES,
    processed_at: Column | None = None,
) -> DataFrame:
    """Answers, mean, low/middle/high counts and index of one question."""
    valid = survey.filter(completed() & F.col(asked.question).isNotNull())
    measures = [measure.alias(name) for name, measure in score_measures(asked).items()]
    table = with_scores(valid, [asked], levels).groupBy(*grain).agg(*measures)
    return gold_marks(with_index(table, asked, grain), processed_at)


def governance_trust(survey: DataFrame, **options) -> DataFrame:
    return perception_table(survey, TRUST, **options)


def democracy_perception(survey: DataFrame, **options) -> DataFrame:
    return perception_table(survey, DEMOCRACY, **options)


def corruption_perception(survey: DataFrame, **options) -> DataFrame:
    return perception_table(survey, CORRUPTION, **options)


def election_fairness(survey: DataFrame, **options) -> DataFrame:
    return perception_table(survey, FAIRNESS, **options)


PERCEPTIONS = {
    "governance_trust_gold": TRUST,
    "democracy_perception_gold": DEMOCRACY,
    "corruption_perception_gold": CORRUPTION,
    "election_fairness_gold": FAIRNESS,
}


def place_rollup(survey: DataFrame, levels: Mapping[str, int] | None = LEVEL_SCORES) -> DataFrame:
    """Everything the (country, region) tables need, from one scan and one shuffle.

    Columns of a question carry its table's name in front. Write this table once and derive the KPI,
    perception and coverage tables from it instead of reading all responses
    again for each of them.
    """
    measures = [
        measure.alias(f"{name}.{column}")
        for name, asked in PERCEPTIONS.items()
        for column, measure in score_measures(asked).items()
    ]
    return with_scores(survey, list(PERCEPTIONS.values()), levels).groupBy(*PLACE).agg(
        F.count(F.lit(1)).alias("total_responses"),
        F.count_if("_done").alias("completed_responses"),
        F.count_if(~F.col("_done")).alias("incomplete_responses"),
        duplicate_count(survey).alias("duplicate_responses"),
        *measures,
    )


def perception_from_rollup(rollup: DataFrame, table: str, processed_at: Column | None = None) -> DataFrame:
    asked = PERCEPTIONS[table]
    prefix = f"{table}."
    own = [
        F.col(f"`{name}`").alias(name.removeprefix(prefix)) for name in rollup.columns if name.startswith(prefix)
    ]
    answered = rollup.select(*PLACE, *own).filter(F.col("total_responses") > 0)
    return gold_marks(with_index(answered, asked, PLACE), processed_at)


def level_counts(survey: DataFrame) -> DataFrame:
    return (
        survey.filter(completed() & F.col("q4_corruption").isNotNull())
        .groupBy(*PLACE, F.col("q4_corruption").alias("corruption_level"))
        .agg(F.count(F.lit(1)).alias("corruption_response_count"))
    )


def corruption_levels(survey: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Answers per corruption level with their share of the region's answers.

    The index is the share of the level High, on every row of the region. The
    window runs over grouped rows, one per region and level.
    """
    return levels_from_counts(level_counts(survey), processed_at)


def levels_from_counts(counts: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Same table as :func:`corruption_levels`, from the counts per level."""
    level, answers = "corruption_level", "corruption_response_count"
    region = Window.partitionBy(*PLACE)
    total = F.sum(answers).over(region)
    high = F.sum(F.when(F.lower(level) == "high", F.col(answers)).otherwise(0)).over(region)
    table = counts.select(
        *PLACE,
        total.alias("total_responses"),
        level,
        answers,
        percent(F.col(answers), total).alias("corruption_percentage"),
        percent(high, total).alias("corruption_index"),
    )
    return gold_marks(table, processed_at)


def coverage_from_counts(counts: DataFrame, population: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Coverage of the population from completed responses per country.

    The band uses the exact ratio, the reported number is rounded; a country
    without a population is Very Low.
    """
    joined = counts.withColumn("_key", join_key(F.col("country"))).join(
        latest_population(population), F.col("_key") == F.col(KEY), "left"
    )
    table = joined.select(
        "country",
        "year",
        "population",
        "total_responses",
        per_million(F.col("total_responses"), F.col("population")).alias("responses_per_million"),
        coverage_band(
            scaled_ratio(F.col("total_responses"), F.col("population"), "1000000.0", None)
        ).alias("coverage_band"),
    )
    return gold_marks(table, processed_at)


def population_coverage(survey: DataFrame, population: DataFrame, processed_at: Column | None = None) -> DataFrame:
    counts = survey.filter(completed()).groupBy("country").agg(F.count(F.lit(1)).alias("total_responses"))
    return coverage_from_counts(counts, population, processed_at)


def kpis_from_rollup(
    rollup: DataFrame, reference: DataFrame, population: DataFrame, processed_at: Column | None = None
) -> DataFrame:
    """Same table as :func:`country_survey_kpis`, from the rollup."""
    return _kpi_columns(rollup, reference, population, PLACE, processed_at)


def coverage_from_rollup(rollup: DataFrame, population: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Same table as :func:`population_coverage`, from the rollup."""
    counts = (
        rollup.filter(F.col("completed_responses") > 0)
        .groupBy("country")
        .agg(F.sum("completed_responses").alias("total_responses"))
    )
    return coverage_from_counts(counts, population, processed_at)
