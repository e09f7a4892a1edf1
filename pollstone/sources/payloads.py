"""Service answers that were landed as text, parsed inside Spark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.functions.expr import lenient_cast

NAMED_VALUE = "struct<id:string,value:string>"
WORLD_BANK_RECORD = (
    f"struct<indicator:{NAMED_VALUE},country:{NAMED_VALUE},countryiso3code:string,date:string,"
    "value:bigint,unit:string,obs_status:string,decimal:bigint>"
)
COUNTRY_RECORD = (
    "struct<name:struct<common:string,official:string>,cca3:string,region:string,subregion:string,"
    "population:bigint,area:double>"
)

#: Where answers have the columns that the contracts require of them. The code of a country may be absent.
ANSWER_FIELDS = {
    "world_bank": {
        "country": ("country", "value"),
        "country_code": ("countryiso3code",),
        "year": ("date",),
        "population": ("value",),
    },
    "restcountries": {"country": ("name", "common")},
}


def _records_text(text: Column) -> Column:
    """The record array of ``[page info, [records]]`` or of a bare record array, else NULL."""
    parts = F.from_json(text, "array<string>")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    paged = (F.size(parts) > 1) & F.startswith(F.ltrim(second), F.lit("["))
    bare = F.get_json_object(first, "$.indicator").isNotNull()
    return F.when(paged, second).when(bare, text)


def world_bank_records(payloads: DataFrame, text: str = "value") -> DataFrame:
    """Population records of all well-formed answers; error answers yield no rows."""
    records = F.from_json(_records_text(F.col(text)), f"array<{WORLD_BANK_RECORD}>")
    return payloads.select(F.inline(records))


def rejected_payloads(payloads: DataFrame, text: str = "value") -> DataFrame:
    """Answers without a record array, with the service's message when it sent one."""
    message = F.get_json_object(text, "$[0].message[0].value")
    refused = payloads.filter(_records_text(F.col(text)).isNull())
    return refused.withColumn("reject_reason", F.coalesce(message, F.lit("unexpected answer format")))


def _has(path: Sequence[str]) -> Callable[[Column], Column]:
    """Whether a record's text has a field, be its value null or not."""

    def there(record: Column) -> Column:
        found = F.lit(True)
        for depth, name in enumerate(path):
            part = record if depth == 0 else F.get_json_object(record, "$." + ".".join(path[:depth]))
            found = found & F.coalesce(F.array_contains(F.json_object_keys(part), name), F.lit(False))
        return found

    return there


def lacking_fields(body: Column, source: str) -> Column:
    """Names of the required columns that no record of an array has a field for, as text."""
    records = F.from_json(body, "array<string>")
    lacking = [F.when(~F.exists(records, _has(path)), F.lit(name)) for name, path in ANSWER_FIELDS[source].items()]
    return F.concat_ws(", ", *lacking)


def shaped(payloads: DataFrame, source: str, text: str = "value") -> DataFrame:
    """Each answer with its ``records`` array, or the reason why it isn't taken.

    The fields are looked for in the raw records, so an answer whose fields
    were renamed or dropped is refused instead of landing as NULLs.
    """
    if source == "world_bank":
        body, record = _records_text(F.col(text)), WORLD_BANK_RECORD
    else:
        body, record = F.when(F.startswith(F.ltrim(F.col(text)), F.lit("[")), F.col(text)), COUNTRY_RECORD
    records = F.from_json(body, f"array<{record}>")
    message = F.get_json_object(text, "$[0].message[0].value")
    lacking = lacking_fields(body, source)
    reason = (
        F.when(body.isNull(), F.coalesce(message, F.lit("unexpected answer format")))
        .when(F.size(records) == 0, F.lit("empty answer"))
        .when(lacking != "", F.concat(F.lit("lacks "), lacking))
    )
    return payloads.withColumns({"records": records, "reject_reason": reason})


def normalized(records: DataFrame, source: str) -> DataFrame:
    return {"world_bank": normalize_world_bank, "restcountries": normalize_countries}[source](records)


def country_records(payloads: DataFrame, text: str = "value") -> DataFrame:
    return payloads.select(F.inline(F.from_json(F.col(text), f"array<{COUNTRY_RECORD}>")))


def _load_marks(source: str, loaded_at: Column | None) -> list[Column]:
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return [F.lit(source).alias("source_system"), stamp.alias("ingestion_timestamp")]


def normalize_world_bank(records: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Flat population rows: country, code, year, population, indicator."""
    year = lenient_cast(F.nullif("date", F.lit("")), T.StringType(), T.IntegerType())
    return records.select(
        F.col("country.value").alias("country"),
        F.col("countryiso3code").alias("country_code"),
        year.alias("year"),
        F.col("value").alias("population"),
        F.col("indicator.value").alias("indicator"),
        *_load_marks("world_bank", loaded_at),
    )


def normalize_countries(records: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Flat country rows; the name may be nested or plain, the code may be absent."""
    nested = isinstance(records.schema["name"].dataType, T.StructType)
    code = F.col("cca3") if "cca3" in records.columns else F.lit(None).cast("string")
    return records.select(
        F.col("name.common" if nested else "name").alias("country"),
        code.alias("country_code"),
        "region",
        "subregion",
        "population",
        "area",
        *_load_marks("restcountries", loaded_at),
    )
