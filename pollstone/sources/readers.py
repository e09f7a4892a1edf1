"""Reading raw files, clean tables and business tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.contracts.model import Contract
from pollstone.sources.payloads import COUNTRY_RECORD, WORLD_BANK_RECORD
from pollstone.sources.registry import BUSINESS_BUNDLE, PLATFORM_BUNDLE, REPORT_BUNDLE, REPORTED_COUNTRY, REPORTED_SOURCE

FILE_SCHEMA = "path string, uri string, modificationTime timestamp, length bigint"

FOLDER_PARTS = ("country", "year", "month", "day", "source_system")
JSON_RECORDS = {"world_bank_population": WORLD_BANK_RECORD, "country_reference": COUNTRY_RECORD}


def missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_bronze(
    spark: SparkSession,
    path: str | Sequence[str],
    file_format: str,
    contract: Contract | None = None,
    json_record: str | None = None,
    multi_line: bool = True,
    folder_parts: bool = False,
    file_time: bool = False,
) -> DataFrame:
    """Read raw files as csv, json or parquet.

    With a contract (or a JSON record type) the schema is declared, so no scan
    is spent on inferring it and unused columns are pruned. Text columns are
    converted later, where an unreadable value becomes NULL or a reject. With
    ``folder_parts`` the Hive-style folder values come along under names of
    their own, so the folder's country cannot replace the data column;
    ``file_time`` adds the file's modification time as ``ingestion_timestamp``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if file_format == "csv":
        reader = spark.read.option("header", True)
        reader = reader.schema(contract.text_schema()) if contract else reader.option("inferSchema", True)
    elif file_format == "json":
        reader = spark.read.option("multiLine", multi_line)
        if json_record:
            reader = reader.schema(T.DataType.fromDDL(json_record))
    elif file_format == "parquet":
        reader = spark.read
    else:
        raise ValueError(f"No reader for format {file_format!r}")
    rows = reader.format(file_format).load(paths)
    where = F.col("_metadata.file_path")
    added = {}
    if file_time:
        added["ingestion_timestamp"] = F.col("_metadata.file_modification_time")
    if folder_parts:
        added |= {f"path_{part}": F.regexp_extract(where, f"/{part}=([^/]*)/", 1) for part in FOLDER_PARTS}
    renamed = {REPORTED_COUNTRY: "country", REPORTED_SOURCE: "source_system"}
    return (rows.withColumns(added) if added else rows).withColumnsRenamed(renamed)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files below a folder: path, uri, modification time, length; a missing folder has none.

    Only the listing is read, never the content. ``uri`` is the form in which
    rows read from the file name it.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(folder)
        )
    except AnalysisException as error:
        if not missing_path(error):
            raise
        return spark.createDataFrame([], FILE_SCHEMA)
    return files.select("path", F.col("_metadata.file_path").alias("uri"), "modificationTime", "length")


def file_paths(files: DataFrame) -> list[str]:
    """The paths of listed files, for a reader that takes them; one job, however many files there are."""
    return [row.path for row in files.select("path").collect()]


def file_hashes(spark: SparkSession, paths: Sequence[str], algorithm: str = "sha256") -> DataFrame:
    """Content hash per file that is not empty: uri, file_hash.

    One scan, whatever the size of a file: it is split like any text input and
    no task holds more than a line. Lines enter two pairs of sums, plain and
    times their place in the file, so their order counts and the way the file
    was split does not. The places within a split are known as it is read, and
    the lines before it are added once the splits have been summed up.
    """
    digest = {"sha256": lambda column: F.sha2(column, 256), "md5": F.md5}[algorithm]
    meta = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    # Row number within the task; 48 bits of hash leave room for sums over 10^12 lines.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = lines.select(
        meta["file_path"].alias("uri"),
        meta["file_size"].alias("size"),
        meta["file_block_start"].alias("start"),
        place.alias("place"),
        *[F.shiftright(F.xxhash64(F.lit(k), "value"), 16).cast("decimal(15,0)").alias(f"h{k}") for k in (0, 1)],
    )
    at = F.col("place").cast("decimal(10,0)")
    blocks = lines.groupBy("uri", "size", "start").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("place").cast("decimal(10,0)").alias("first"),
        *[F.sum(f"h{k}").cast("decimal(24,0)").alias(f"sum{k}") for k in (0, 1)],
        *[F.sum(F.col(f"h{k}") * at).cast("decimal(37,0)").alias(f"placed{k}") for k in (0, 1)],
    )
    earlier = Window.partitionBy("uri").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("decimal(13,0)") - F.col("first")
    whole = blocks.withColumn("shift", shift.cast("decimal(13,0)")).groupBy("uri", "size").agg(
        F.sum("n").alias("n"),
        *[F.sum(f"sum{k}").alias(f"sum{k}") for k in (0, 1)],
        *[F.sum(F.col(f"placed{k}") + F.col(f"sum{k}") * F.col("shift")).alias(f"placed{k}") for k in (0, 1)],
    )
    return whole.select(
        "uri", digest(F.concat_ws(":", "size", "n", "sum0", "sum1", "placed0", "placed1").cast("binary")).alias("file_hash")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a frame lacks are NULL."""
    if not frames:
        raise ValueError("Nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_silver(spark: SparkSession, root: str, views: bool = False) -> dict[str, DataFrame]:
    """The three clean tables, on request also as temp views."""
    names = ("survey_responses", "country_reference", "world_bank_population")
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in names}
    if views:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
    return tables


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as error:
        if missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise FileNotFoundError(f"Business table {name} has not been written yet") from error
        raise


def read_bundle(spark: SparkSession, root: str, bundle: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: read_gold(spark, root, table) for name, table in bundle.items()}


def business_bundle(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return read_bundle(spark, root, BUSINESS_BUNDLE)


def platform_bundle(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return read_bundle(spark, root, PLATFORM_BUNDLE)


def report_bundle(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return read_bundle(spark, root, REPORT_BUNDLE)
