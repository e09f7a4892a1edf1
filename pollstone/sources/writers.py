"""Writing raw landings, clean tables, business tables and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pollstone.contracts.model import Contract
from pollstone.functions.expr import bronze_date_parts
from pollstone.sources.registry import REPORTED_COUNTRY, REPORTED_SOURCE

_IN_FILE = {"country": REPORTED_COUNTRY, "source_system": REPORTED_SOURCE}
_FOLDERS = {"path_country": "country", "path_source": "source_system"}
BRONZE_PARTS = ("path_country", "year", "month", "day", "path_source")


def spread_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Group rows by folder before a partitioned write, without one task per folder.

    A rebalance gathers the rows of a small folder into few files, and adaptive
    execution cuts a folder that holds a large share of the rows into several
    tasks.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns]) if columns else df


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows with a row counter that is filled while they are written."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def _rows_written(counter: Observation, df: DataFrame, path: str) -> int:
    """The counter's value; a plan found empty runs no counter, then the written files are asked."""
    try:
        return counter.get["rows"]
    except (Py4JJavaError, KeyError):
        return df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_silver(df: DataFrame, path: str, partition_columns: Sequence[str] | None = None, spread: bool = True) -> int:
    """Replace a clean table and return the number of rows, counted during the write.

    Rows that come folder by folder need no ``spread``: each task writes its own.
    """
    counted, counter = observed(df, "silver rows")
    columns = list(partition_columns or [])
    rows = spread_by(counted, columns) if spread else counted
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)
    return _rows_written(counter, df, path)


def default_partitions(df: DataFrame) -> list[str]:
    return ["country"] if "country" in df.columns else []


def write_gold(df: DataFrame, path: str, contract: Contract | None = None) -> int:
    """Replace a business table in its contract's column order and types."""
    table = contract.conform(df) if contract else df
    counted, counter = observed(table, "gold rows")
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return _rows_written(counter, table, path)


def with_bronze_parts(
    df: DataFrame, day: Column | None = None, country: Column | None = None, source: Column | None = None
) -> DataFrame:
    """Folder values of the raw layout: country in lower case, year, month, day, source."""
    stamp = F.date_format(F.current_date() if day is None else day, "yyyy-MM-dd")
    year, month, date = bronze_date_parts(stamp)
    place = F.nullif(F.trim("country"), F.lit("")) if country is None else country
    return df.withColumns(
        {
            "path_country": F.lower(place),
            "year": year,
            "month": month,
            "day": date,
            "path_source": F.col("source_system") if source is None else source,
        }
    )


def bronze_path(country: str, source_system: str, filename: str, day: str) -> str:
    """Object path of one raw file; ``day`` is an ISO date."""
    name = filename.rsplit("/", 1)[-1]
    return f"country={country.lower()}/year={day[:4]}/month={day[5:7]}/day={day[8:10]}/{source_system}/{name}"


def land_bronze(df: DataFrame, root: str, file_format: str = "csv", spread: bool = True) -> None:
    """Append rows below ``country=/year=/month=/day=/source_system=`` folders.

    Records go out as JSON lines with their own field names. In the other
    formats the data's country and source columns are kept under other names,
    because the folders carry these. Rows that come folder by folder, or all go
    to one, need no ``spread``: each task writes its own, without a shuffle.
    """
    data = [name for name in df.columns if name not in BRONZE_PARTS]
    folders = [F.col(name).alias(_FOLDERS.get(name, name)) for name in BRONZE_PARTS]
    parts = [_FOLDERS.get(name, name) for name in BRONZE_PARTS]
    if file_format == "json":
        kept = [F.to_json(F.struct(*data)).alias("value")]
    else:
        kept = [F.col(name).alias(_IN_FILE.get(name, name)) for name in data]
    rows = df.select(*kept, *folders)
    writer = (spread_by(rows, parts) if spread else rows).write.mode("append").partitionBy(*parts)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format("text" if file_format == "json" else file_format).save(root)


def write_snapshot(df: DataFrame, root: str, table: str, stamp: str) -> str:
    """Write an extracted table once under a time-stamped name."""
    path = f"{root}/{table}_{stamp}.parquet"
    df.write.mode("errorifexists").parquet(path)
    return path


def keep_payloads(payloads: DataFrame, root: str, source: str, stamp: str, country: str | None = None) -> str:
    """Keep raw service answers as text for audit."""
    middle = f"_{country.lower()}" if country else ""
    path = f"{root}/{source}/{source}{middle}_{stamp}"
    payloads.select("value").write.mode("errorifexists").text(path)
    return path
