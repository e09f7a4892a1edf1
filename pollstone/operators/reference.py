"""Reference data: latest population, unique countries, aliases, country lookup in paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollstone.contracts.catalog import SILVER_SURVEY
from pollstone.functions.expr import age_group, join_key
from pollstone.operators.dedup import COPIES

KEY = "_country_key"

# Surveyed countries, in lookup order.
COUNTRIES = (
    "Algeria", "Benin", "Botswana", "Burkina Faso", "Cabo Verde", "Cameroon",
    "Congo-Brazzaville", "Côte d'Ivoire", "Eswatini", "Ethiopia", "Gabon", "Gambia", "Ghana",
    "Guinea", "Kenya", "Lesotho", "Liberia", "Madagascar", "Malawi", "Mali", "Mauritania",
    "Mauritius", "Morocco", "Mozambique", "Namibia", "Niger", "Nigeria",
    "São Tomé and Príncipe", "Senegal", "Seychelles", "Sierra Leone", "South Africa", "Sudan",
    "Tanzania", "Togo", "Tunisia", "Uganda", "Zambia", "Zimbabwe",
)


def latest_population(population: DataFrame) -> DataFrame:
    """The newest known population per country (names compared without case)."""
    known = population.filter(F.col("population").isNotNull())
    newest = F.struct("year", "population", "country")
    return (
        known.groupBy(join_key(F.col("country")).alias(KEY))
        .agg(F.max(newest).alias("_newest"))
        .select(KEY, F.col("_newest.year").alias("year"), F.col("_newest.population").alias("population"))
    )


def unique_countries(reference: DataFrame, column: str = "subregion") -> DataFrame:
    """One value per country name, so that a join on the name cannot multiply rows."""
    return reference.groupBy(join_key(F.col("country_name")).alias(KEY)).agg(F.max(column).alias(column))


def standardize_country_names(
    df: DataFrame, aliases: Mapping[str, str] | DataFrame, column: str = "country"
) -> DataFrame:
    """Replace known other spellings; unknown names stay.

    ``aliases`` is a dict or a DataFrame with ``alias`` and ``country_name``.
    The join carries no broadcast hint: Spark decides by the alias table's
    measured size.
    """
    if isinstance(aliases, Mapping):
        if not aliases:
            return df
        pairs = [F.lit(text) for alias, name in aliases.items() for text in (alias.lower(), name)]
        known = F.try_element_at(F.create_map(*pairs), join_key(F.col(column)))
        return df.withColumn(column, F.coalesce(known, F.col(column)))
    lookup = aliases.groupBy(F.lower("alias").alias("_alias")).agg(F.max("country_name").alias("_known"))
    return (
        df.join(lookup, F.lower(F.col(column)) == F.col("_alias"), "left")
        .withColumn(column, F.coalesce("_known", column))
        .drop("_alias", "_known")
    )


def _name_array(countries: Sequence[str] | Column) -> Column:
    return countries if isinstance(countries, Column) else F.array(*[F.lit(name) for name in countries])


def longest_first(countries: Sequence[str]) -> list[str]:
    return sorted(countries, key=len, reverse=True)


def country_in_path(
    path: Column, countries: Sequence[str] | Column = COUNTRIES, longest: bool = True, default: str | None = "unknown"
) -> Column:
    """Country named in a path: the first path part that contains one decides.

    Inside that part the longest name wins (``nigeria`` is not taken for
    ``niger``); ``longest=False`` takes the first in list order instead. An
    array column of names is used in the order it has.
    """
    if longest and not isinstance(countries, Column):
        countries = longest_first(countries)
    names = _name_array(countries)
    hits = F.flatten(
        F.transform(
            F.split(F.lower(path), "/"),
            lambda part: F.filter(names, lambda name: F.contains(part, F.lower(name))),
        )
    )
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(default))


def country_in_file_name(name: Column, countries: Sequence[str] | Column = COUNTRIES) -> Column:
    """First listed country whose name, or its first two letters, occurs in a file name."""
    lowered = F.lower(name)
    hits = F.filter(
        _name_array(countries),
        lambda country: F.contains(lowered, F.lower(country))
        | F.contains(lowered, F.lower(F.substring(country, 1, 2))),
    )
    return F.get(hits, F.lit(0))


def with_names_found(
    texts: DataFrame, column: str, patterns: DataFrame, output: str, split: str | None = "/"
) -> DataFrame:
    """Add the name whose pattern occurs in a text, for tables of names of any size.

    ``patterns`` has ``pattern``, ``name`` and a sortable ``rank``; case does not
    matter and blank patterns find nothing. The first part of the text (between
    ``split``) that holds a pattern decides; in it the smallest rank wins, then
    the smallest name. A text without a name, or NULL, gets NULL.

    Each distinct part is looked up once: its substrings of the lengths that
    patterns have meet the patterns in an equi-join, so parts and names are not
    compared pair by pair.
    """
    known = patterns.select(F.lower("pattern").alias("_piece"), F.col("name").alias("_name"), F.col("rank").alias("_rank"))
    known = known.filter(F.trim("_piece") != "")
    lengths = known.select(F.length("_piece").alias("n")).distinct().agg(F.collect_list("n"))

    whole = texts.select(F.col(column).alias("_text")).dropna().distinct()
    parts = F.split(F.lower("_text"), split) if split else F.array(F.lower("_text"))
    placed = whole.select("_text", F.posexplode(parts).alias("_place", "_part"))
    sized = placed.select("_part").distinct().withColumn("_size", F.explode(lengths.scalar()))
    sized = sized.filter(F.length("_part") >= F.col("_size"))
    starts = sized.withColumn("_start", F.explode(F.sequence(F.lit(1), F.length("_part") - F.col("_size") + 1)))
    pieces = starts.select("_part", F.substring(F.col("_part"), F.col("_start"), F.col("_size")).alias("_piece")).distinct()
    best = pieces.join(known, "_piece").groupBy("_part").agg(F.min(F.struct("_rank", "_name")).alias("_best"))
    found = placed.join(best, "_part").groupBy("_text").agg(F.min(F.struct("_place", "_best")).alias("_found"))
    found = found.select("_text", F.col("_found._best._name").alias(output))
    return texts.join(found, texts[column] == found["_text"], "left").drop("_text")


def with_row_checks(survey: DataFrame) -> DataFrame:
    """Add the declared row columns: duplicate flag, validation status, age group, submission date."""
    known = F.lit(True)
    for name in ("response_id", "country", "gender", "age"):
        known = known & F.col(name).isNotNull()
    flag = F.col(COPIES) > 1 if COPIES in survey.columns else F.lit(False)
    return survey.withColumns(
        {
            "duplicate_flag": flag,
            "validation_status": F.when(known, "valid").otherwise("invalid"),
            "age_group": age_group(F.col("age")),
            "submission_date": F.to_date("submission_timestamp"),
        }
    )


def with_country_codes(df: DataFrame, population: DataFrame) -> DataFrame:
    """Add ``country_code`` from the population table, matched by name without case."""
    codes = population.groupBy(join_key(F.col("country")).alias(KEY)).agg(F.max("country_code").alias("country_code"))
    keyed = df.withColumn("_key", join_key(F.col("country")))
    return keyed.join(codes, F.col("_key") == F.col(KEY), "left").drop("_key", KEY)


def declared_survey(survey: DataFrame, population: DataFrame) -> DataFrame:
    """Clean responses in the full declared form of the clean layer.

    Adds country code, age group, submission date, duplicate flag and
    validation status; ``ingestion_timestamp`` comes from the raw file when the
    rows carry it, else from the processing time.
    """
    checked = with_row_checks(survey)
    if "ingestion_timestamp" not in survey.columns:
        checked = checked.withColumn("ingestion_timestamp", F.col("silver_processed_at"))
    return SILVER_SURVEY.conform(with_country_codes(checked, population))
