"""Column expressions: flags, exact ratios, bands, lenient casts, formatting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def completed(status: str = "completion_status") -> Column:
    """True for a completed response; NULL when the status is NULL."""
    return F.lower(F.col(status)) == F.lit("completed")


def count_where(condition: Column) -> Column:
    """Number of rows where the condition is true; NULL over zero rows, like SUM."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def scaled_ratio(numerator: Column, denominator: Column, scale: str = "1", digits: int | None = 2) -> Column:
    """``scale * numerator / denominator`` of two counts, rounded half up, as DOUBLE.

    The division is done in DECIMAL so that ties round the same way on every
    run; a zero denominator gives NULL. ``digits=None`` skips the rounding.
    """
    exact = (numerator.cast("decimal(20,0)") * F.lit(Decimal(scale))) / F.nullif(
        denominator.cast("decimal(20,0)"), F.lit(Decimal(0))
    )
    return (exact if digits is None else F.round(exact, digits)).cast("double")


def percent(numerator: Column, denominator: Column) -> Column:
    return scaled_ratio(numerator, denominator, "100.0")


def per_million(numerator: Column, denominator: Column, digits: int | None = 2) -> Column:
    return scaled_ratio(numerator, denominator, "1000000.0", digits)


def rounded_mean(score: Column, digits: int = 2) -> Column:
    return F.round(F.avg(score.cast("double")), digits)


def stable_mean(column: str) -> Column:
    """Mean of values that carry two decimals.

    The sum runs in DECIMAL, so the result does not depend on the order in
    which partitions are added up.
    """
    return F.sum(F.col(column).cast("decimal(28,2)")).cast("double") / F.nullif(
        F.count(F.col(column)), F.lit(0)
    )


def band(value: Column, cuts: Sequence[tuple[float, str]], default: str, compare: str = "ge") -> Column:
    """Label of the first cut that holds; NULL and everything else get the default.

    ``compare`` is ``ge`` (value >= cut), ``lt`` (value < cut) or ``le``.
    """
    tests = {
        "ge": lambda cut: value >= F.lit(cut),
        "lt": lambda cut: value < F.lit(cut),
        "le": lambda cut: value <= F.lit(cut),
    }
    if compare not in tests:
        raise ValueError(f"Unknown comparison: {compare}")
    return F.coalesce(*[F.when(tests[compare](cut), F.lit(label)) for cut, label in cuts], F.lit(default))


# Age groups.
AGE_GROUPS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST_AGE_GROUP = "55+"
UNKNOWN = "Unknown"


def age_group(age: Column) -> Column:
    return F.when(age.isNull(), F.lit(UNKNOWN)).otherwise(band(age, AGE_GROUPS, OLDEST_AGE_GROUP, "lt"))


# Quality, coverage, freshness and corruption bands.
QUALITY_CUTS = ((95, "Excellent"), (85, "Good"), (70, "Fair"))
COVERAGE_CUTS = ((500, "Very High"), (100, "High"), (50, "Medium"), (10, "Low"))
FRESHNESS_CUTS = ((24, "Fresh"), (72, "Stale"))
CORRUPTION_CUTS = ((4, "Very High"), (3, "High"), (2, "Medium"))


def quality_band(value: Column) -> Column:
    return band(value, QUALITY_CUTS, "Poor")


def coverage_band(value: Column) -> Column:
    return band(value, COVERAGE_CUTS, "Very Low")


def freshness_band(hours: Column) -> Column:
    return band(hours, FRESHNESS_CUTS, "Very Stale", "le")


def corruption_band(score: Column) -> Column:
    return band(score, CORRUPTION_CUTS, "Low")


def title_case(column: Column) -> Column:
    return F.initcap(F.trim(column))


def join_key(column: Column) -> Column:
    """Case-insensitive key for country names."""
    return F.lower(column)


def mapped(column: Column, mapping: Mapping[str, str], default: str | None) -> Column:
    """Case-insensitive category map; anything not listed, NULL included, gets the default."""
    lowered = F.lower(column)
    targets: dict[str, list[str]] = {}
    for raw, target in mapping.items():
        targets.setdefault(target, []).append(raw.lower())
    hits = [F.when(lowered.isin(*raws), F.lit(target)) for target, raws in targets.items()]
    return F.coalesce(*hits, F.lit(default))


def lenient_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast where an unreadable value becomes NULL instead of failing the job.

    Whole numbers written with a fraction (``"73.0"``) are read as numbers
    first, so text and numeric inputs give the same integer.
    """
    if source == target:
        return column
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        column = F.trim(column).try_cast("decimal(38,10)")
    return column.try_cast(target)


def two_decimals(value: Column) -> Column:
    return F.coalesce(F.format_string("%.2f", value), F.lit("nan"))


def bronze_date_parts(date_text: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of an ISO date text, by position."""
    return F.substring(date_text, 1, 4), F.substring(date_text, 6, 2), F.substring(date_text, 9, 2)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def normalized_file_name(path: Column) -> Column:
    return F.lower(F.replace(file_name(path), F.lit(" "), F.lit("_")))


def file_extension(path: Column) -> Column:
    """Lower-case extension with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))
