"""Raw rows to clean rows. Every step is one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.functions.expr import UNKNOWN, lenient_cast, mapped, title_case
from pollstone.functions.names import plain_name, rename_columns, snake_case

# Gender spellings, categorical columns, survey column types.
GENDERS = {"male": "Male", "m": "Male", "female": "Female", "f": "Female"}
CATEGORICAL_COLUMNS = (
    "education_level",
    "employment_status",
    "marital_status",
    "completion_status",
    "region",
    "subregion",
)
SURVEY_TYPES: dict[str, T.DataType] = {
    "age": T.IntegerType(),
    "response_id": T.StringType(),
    "respondent_id": T.StringType(),
    "country": T.StringType(),
    "country_code": T.StringType(),
    "submission_timestamp": T.TimestampType(),
    "survey_year": T.IntegerType(),
    "household_size": T.IntegerType(),
    "income": T.DoubleType(),
    "latitude": T.DoubleType(),
    "longitude": T.DoubleType(),
}


def _text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]


def _rewrite(df: DataFrame, columns: Sequence[str], change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({name: change(F.col(name)) for name in columns if name in df.columns})


def standardize_column_names(df: DataFrame) -> DataFrame:
    return rename_columns(df, snake_case)


def trim_text(df: DataFrame) -> DataFrame:
    return _rewrite(df, _text_columns(df), F.trim)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Blank texts become NULL; other texts keep their surrounding spaces."""
    return _rewrite(df, _text_columns(df), lambda text: F.when(F.trim(text) != "", text))


def map_categories(df: DataFrame, column: str, mapping: Mapping[str, str], default: str | None) -> DataFrame:
    return _rewrite(df, [column], lambda text: mapped(text, mapping, default))


def clean_gender(df: DataFrame, column: str = "gender") -> DataFrame:
    """Male/m and Female/f in any case; everything else, NULL included, is Unknown."""
    return map_categories(df, column, GENDERS, UNKNOWN)


def null_out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Read the column as a whole number and drop values outside [low, high]."""
    if column not in df.columns:
        return df
    number = lenient_cast(F.col(column), df.schema[column].dataType, T.IntegerType())
    return df.withColumn(column, F.when(number.between(low, high), number))


def clean_age(df: DataFrame, column: str = "age", min_age: int = 18, max_age: int = 100) -> DataFrame:
    return null_out_of_range(df, column, min_age, max_age)


def clean_country_names(df: DataFrame, column: str = "country") -> DataFrame:
    return _rewrite(df, [column], title_case)


def clean_categorical_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _rewrite(df, CATEGORICAL_COLUMNS if columns is None else columns, title_case)


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast the listed columns that exist; unreadable values become NULL."""
    return df.withColumns(
        {
            name: lenient_cast(F.col(name), df.schema[name].dataType, kind)
            for name, kind in types.items()
            if name in df.columns
        }
    )


def cast_survey_columns(df: DataFrame) -> DataFrame:
    return cast_columns(df, SURVEY_TYPES)


def clean_survey_responses(df: DataFrame) -> DataFrame:
    return (
        df.transform(standardize_column_names)
        .transform(trim_text)
        .transform(blank_to_null)
        .transform(clean_gender)
        .transform(clean_age)
        .transform(clean_country_names)
        .transform(clean_categorical_columns)
        .transform(cast_survey_columns)
    )


LOAD_TIME = "ingestion_timestamp"


def _load_time(df: DataFrame) -> list[str]:
    """The load time, carried along when the raw rows have it, for deduplication."""
    return [LOAD_TIME] if LOAD_TIME in df.columns else []


def clean_world_bank_population(df: DataFrame) -> DataFrame:
    """Nested population records to flat rows; negative populations become NULL."""
    flat = df.select(
        F.col("country.value").alias("country"),
        F.col("countryiso3code").alias("country_code"),
        F.col("date").alias("year"),
        F.col("value").alias("population"),
        F.col("indicator.value").alias("indicator"),
        "obs_status",
        "unit",
        "decimal",
        *_load_time(df),
    )
    cleaned = (
        flat.transform(standardize_column_names)
        .transform(trim_text)
        .transform(blank_to_null)
        .transform(clean_country_names)
        .transform(cast_columns, {"year": T.IntegerType(), "population": T.LongType()})
    )
    return cleaned.withColumns(
        {
            "country_code": F.upper(F.trim("country_code")),
            "population": F.when(F.col("population") >= 0, F.col("population")),
        }
    )


def clean_country_reference(df: DataFrame) -> DataFrame:
    """Nested country records to flat rows."""
    return (
        df.select(
            F.col("name.common").alias("country_name"),
            F.col("name.official").alias("official_name"),
            "region",
            "subregion",
            "population",
            "area",
            *_load_time(df),
        )
        .transform(standardize_column_names)
        .transform(trim_text)
        .transform(blank_to_null)
        .transform(clean_categorical_columns, ["region", "subregion"])
        .transform(cast_columns, {"population": T.LongType(), "area": T.DoubleType()})
    )


def clean_loaded_table(df: DataFrame) -> DataFrame:
    """Minimal cleaning before a direct table load: plain names and no exact copies."""
    return rename_columns(df, plain_name).dropDuplicates()


def add_silver_metadata(
    df: DataFrame,
    source_layer: str = "bronze",
    target_layer: str = "silver",
    processed_at: Column | None = None,
) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumns(
        {
            "silver_processed_at": stamp,
            "source_layer": F.lit(source_layer),
            "target_layer": F.lit(target_layer),
        }
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "survey_responses": clean_survey_responses,
    "world_bank_population": clean_world_bank_population,
    "country_reference": clean_country_reference,
}


def clean_dataset(df: DataFrame, dataset: str, processed_at: Column | None = None) -> DataFrame:
    name = dataset.lower().strip()
    if name not in CLEANERS:
        raise ValueError(f"No cleaning steps for dataset: {name}")
    return add_silver_metadata(CLEANERS[name](df), processed_at=processed_at)
