"""Database tables over JDBC: allow-listed extract and load, and the count check."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollstone.sources.registry import EXTRACTABLE_TABLES

LOAD_BATCH = 5000


def extract_options(
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    allowed: Collection[str] = EXTRACTABLE_TABLES,
) -> dict[str, str]:
    """JDBC options for a whole-table extract, read in parallel over a numeric column."""
    if table not in allowed:
        raise ValueError(f"{table!r} is none of the declared source tables")
    options = {"dbtable": table}
    if split_column and bounds and partitions > 1:
        low, high = bounds
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def extract_table(
    spark: SparkSession, url: str, table: str, connection: Mapping[str, str] | None = None, **split
) -> DataFrame:
    options = {**(connection or {}), **extract_options(table, **split)}
    return spark.read.format("jdbc").option("url", url).options(**options).load()


def load_table(df: DataFrame, url: str, table: str, connection: Mapping[str, str] | None = None) -> None:
    """Replace a database table, in batches."""
    df.write.jdbc(url, table, "overwrite", {**(connection or {}), "batchsize": str(LOAD_BATCH)})


def count_check(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: rows sent, rows found, and whether they agree."""
    sent = source.agg(F.count(F.lit(1)).alias("rows_sent"))
    return sent.withColumn("rows_loaded", loaded.agg(F.count(F.lit(1))).scalar()).withColumn(
        "complete", F.col("rows_sent") == F.col("rows_loaded")
    )
