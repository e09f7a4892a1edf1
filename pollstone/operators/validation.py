"""Validation rules, checked in one pass, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollstone.functions.expr import count_where, file_extension

REPORT_SCHEMA = "struct<rule:string,target:string,observed:double,allowed:double,passed:boolean>"


class ValidationError(ValueError):
    """A dataset may not be written because rules failed."""


@dataclass(frozen=True)
class Rules:
    required: Sequence[str] = ()
    null_shares: Mapping[str, float] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    unique: Sequence[str] = ()


# The rules of the three datasets.
DATASET_RULES = {
    "survey_responses": Rules(
        required=("response_id", "country", "gender", "age"),
        null_shares={"response_id": 0.0, "country": 0.05, "gender": 0.10, "age": 0.15},
        ranges={"age": (18, 100)},
        unique=("response_id",),
    ),
    "world_bank_population": Rules(
        required=("country", "country_code", "year", "population"),
        null_shares={"country": 0.0, "year": 0.0, "population": 0.10},
        ranges={"year": (1960, 2100), "population": (0, 10_000_000_000)},
        unique=("country", "year", "indicator"),
    ),
    "country_reference": Rules(
        required=("country_name", "region", "population"),
        null_shares={"country_name": 0.0, "region": 0.10, "population": 0.10},
        ranges={"population": (0, 10_000_000_000), "area": (0, 20_000_000)},
    ),
}
PASS_THRESHOLD = 0.95
ALLOWED_EXTENSIONS = (".csv", ".sav", ".json", ".parquet")


def _row(rule: str, target: str, observed: Column, allowed: float | None, passed: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(target).alias("target"),
        observed.cast("double").alias("observed"),
        F.lit(allowed).cast("double").alias("allowed"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def validation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: rule, target, observed, allowed, passed.

    All counters come from a single scan. With a uniqueness rule they are
    collected per key first (combined before the shuffle, so a repeated key
    costs nothing) and then added up; without one there is no shuffle at all.
    NULL keys count as one value; NULLs are never out of range; an empty
    dataset fails its NULL rules.
    """
    have = set(df.columns)
    keys = [name for name in rules.unique if name in have]
    counters: dict[str, Column] = {"_rows": F.count(F.lit(1))}
    for name in rules.null_shares:
        if name in have:
            counters[f"_null_{name}"] = count_where(F.col(name).isNull())
    for name, (low, high) in rules.ranges.items():
        if name in have:
            counters[f"_out_{name}"] = count_where((F.col(name) < low) | (F.col(name) > high))

    named = [counter.alias(name) for name, counter in counters.items()]
    if keys:
        totals = df.groupBy(*keys).agg(*named).agg(
            *[F.sum(name).alias(name) for name in counters], F.count(F.lit(1)).alias("_keys")
        )
    else:
        totals = df.agg(*named)

    rows = F.coalesce(F.col("_rows"), F.lit(0))
    nothing = F.lit(None)
    report = [
        _row("required_column", name, F.lit(int(name in have)), 1, F.lit(name in have)) for name in rules.required
    ]
    for name, share in rules.null_shares.items():
        if name in have:
            observed = F.col(f"_null_{name}") / F.nullif(rows, F.lit(0))
            report.append(_row("null_share", name, observed, share, observed <= share))
        else:
            report.append(_row("null_share", name, nothing, share, F.lit(False)))
    for name in rules.ranges:
        if name in have:
            observed = F.coalesce(F.col(f"_out_{name}"), F.lit(0))
            report.append(_row("out_of_range", name, observed, 0, observed == 0))
        else:
            report.append(_row("out_of_range", name, nothing, 0, F.lit(False)))
    if rules.unique:
        target = ",".join(rules.unique)
        if keys:
            surplus = rows - F.col("_keys")
            report.append(_row("surplus_keys", target, surplus, 0, surplus == 0))
        else:
            report.append(_row("surplus_keys", target, nothing, 0, F.lit(False)))
    return totals.select(F.inline(F.array(*report).cast(f"array<{REPORT_SCHEMA}>")))


def rules_for(dataset: str) -> Rules:
    name = dataset.lower().strip()
    if name not in DATASET_RULES:
        raise ValueError(f"Dataset {name!r} has no rules")
    return DATASET_RULES[name]


def validate_dataset(df: DataFrame, dataset: str) -> DataFrame:
    return validation_report(df, rules_for(dataset))


def pass_rate(report: DataFrame, threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Share of passed rules and whether it reaches the overall threshold."""
    share = F.avg(F.col("passed").cast("int"))
    return report.agg(
        F.count(F.lit(1)).alias("rules"),
        count_where(F.col("passed")).alias("rules_passed"),
        share.alias("pass_rate"),
        (share >= threshold).alias("meets_threshold"),
    )


def require_valid(df: DataFrame, dataset: str) -> DataFrame:
    """The rows themselves when every rule holds, else :class:`ValidationError`.

    Only the failed rules reach the driver, never data rows.
    """
    failed = validate_dataset(df, dataset).filter(~F.col("passed")).collect()
    if failed:
        reasons = "; ".join(f"{row.rule} {row.target}: {row.observed} (allowed {row.allowed})" for row in failed)
        raise ValidationError(f"{dataset} breaks its rules and is not written [{reasons}]")
    return df


def has_columns(df: DataFrame, required: Sequence[str]) -> bool:
    return set(required) <= set(df.columns)


def nulls_within(df: DataFrame, limits: Mapping[str, float]) -> bool:
    return _all_passed(df, Rules(null_shares=limits))


def numbers_within(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> bool:
    return _all_passed(df, Rules(ranges=ranges))


def keys_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    return _all_passed(df, Rules(unique=keys))


def _all_passed(df: DataFrame, rules: Rules) -> bool:
    return validation_report(df, rules).filter(~F.col("passed")).isEmpty()


def extension_allowed(path: str, allowed: Sequence[str] = ALLOWED_EXTENSIONS) -> bool:
    return PurePosixPath(path).suffix.lower() in allowed


def with_extension_check(files: DataFrame, allowed: Sequence[str] = ALLOWED_EXTENSIONS) -> DataFrame:
    """Mark listed files whose extension is not accepted."""
    extension = file_extension(F.col("path"))
    return files.withColumn(
        "reject_reason",
        F.when(~extension.isin(*allowed), F.concat(F.lit("extension not allowed: "), extension)),
    )
