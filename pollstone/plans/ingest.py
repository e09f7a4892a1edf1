"""Getting raw data into the lake: files, service answers, database tables.

Every job works on all its files at once and leaves one outcome row per file,
so a bad file never stops the others. Landing comes before the ledger entry: a
job that dies in between lands the file again, and the copies disappear in the
clean layer.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollstone.contracts.catalog import BRONZE_SURVEY
from pollstone.contracts.model import Contract
from pollstone.functions.durable import durable
from pollstone.operators import ledger as books
from pollstone.operators.reference import COUNTRIES, country_in_path
from pollstone.operators.validation import with_extension_check
from pollstone.plans.bookkeeping import append, processed_files, record_run
from pollstone.sources import payloads as answers
from pollstone.sources.csv_files import file_headers, parsed_rows, row_counts
from pollstone.sources.readers import file_hashes, file_paths, list_files
from pollstone.sources.registry import API_SOURCES, DB_SOURCES, Lake
from pollstone.sources.tables import extract_table
from pollstone.sources.writers import keep_payloads, land_bronze, with_bronze_parts

OUTCOME_COLUMNS = (
    "path", "file_name", "file_hash", "country", "source_system", "status", "reason", "rows_loaded", "last_modified",
    "file_size",
)


def _finish(
    spark: SparkSession, lake: Lake, outcomes: DataFrame, run_id: str, landed: str = "success"
) -> DataFrame:
    """Write the outcome rows and the ledger entries of what was landed."""
    path = f"{lake.meta}/file_outcomes/run_id={run_id}"
    outcomes.select(*OUTCOME_COLUMNS).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    entries = books.ledger_entries(written.filter(F.col("status") == landed), batch_id=run_id)
    append(entries, f"{lake.meta}/processed_files")
    return written


def _seen(spark: SparkSession, lake: Lake) -> DataFrame:
    done = processed_files(spark, lake).filter(F.col("processing_status") == books.PROCESSED)
    return done.select("file_name", "file_hash").distinct().withColumn("_seen", F.lit(True))


def check_files(
    spark: SparkSession,
    folder: str,
    lake: Lake,
    contract: Contract = BRONZE_SURVEY,
    countries: Sequence[str] | Column = COUNTRIES,
    pattern: str = "*",
) -> DataFrame:
    """Every file below a folder as failed, skipped or ready, with the reason.

    A file is known by its content: every CSV file is hashed, also one whose
    time and size are those of an earlier run. Only names pass through the
    driver, as in any read of listed files.
    """
    listed = with_extension_check(list_files(spark, folder, pattern))
    is_csv = F.endswith(F.lower("path"), F.lit(".csv"))
    to_open = listed.filter(is_csv)
    paths = file_paths(to_open)
    if paths:
        headers = durable(file_headers(spark, paths))
        files = listed.join(file_hashes(spark, paths), "uri", "left").join(headers, "uri", "left")
        if not headers.isEmpty():
            files = files.join(row_counts(spark, headers), "uri", "left")
        else:
            files = files.withColumn("usable_rows", F.lit(0).cast("bigint"))
    else:
        files = listed.selectExpr(
            "*",
            "CAST(NULL AS STRING) file_hash",
            "CAST(NULL AS ARRAY<STRING>) header",
            "true utf8",
            "false spans",
            "0L usable_rows",
        )
    files = (
        files.withColumn("file_name", F.col("path"))
        .join(_seen(spark, lake), ["file_name", "file_hash"], "left")
    )
    lacking = F.array_except(F.array(*[F.lit(name) for name in contract.required]), F.col("header"))
    reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(~is_csv, F.lit("no reader for this file type"))
        .when(F.coalesce("usable_rows", F.lit(0)) < 1, F.lit("empty file"))
        .when(F.size(lacking) > 0, F.concat(F.lit("missing columns: "), F.concat_ws(",", lacking)))
    )
    return files.select(
        "path",
        "uri",
        "file_name",
        "file_hash",
        "header",
        "utf8",
        "spans",
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("file_size"),
        country_in_path(F.col("path"), countries).alias("country"),
        F.lit("csv").alias("source_system"),
        F.col("usable_rows").alias("rows_loaded"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), "failed").when(F.col("_seen"), "skipped").otherwise("ready").alias("status"),
    )


def ingest_files(
    spark: SparkSession,
    folder: str,
    lake: Lake,
    contract: Contract = BRONZE_SURVEY,
    countries: Sequence[str] | Column = COUNTRIES,
    day: Column | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Land all new, acceptable CSV files of a folder tree, or of one country's folder in it.

    Returns one outcome row per file.
    """
    run = run_id or str(uuid.uuid4())
    record_run(spark, lake, run, "csv_ingestion", "running", run_type="full")
    try:
        stage = f"{lake.meta}/staging/files_{run}"
        checked = check_files(spark, folder, lake, contract, countries)
        checked.write.mode("overwrite").parquet(stage)
        files = spark.read.parquet(stage)
        ready = files.filter("status = 'ready'")
        if not ready.isEmpty():
            rows = parsed_rows(spark, ready, contract, keep=["country"])
            landed = with_bronze_parts(rows, day=day, country=F.col("_country"), source=F.lit("csv"))
            # Parquet, so that line ends and quotes in a value need no second parse.
            # A file has one country, so a task's rows go to few folders.
            land_bronze(landed.drop("_country", "_uri"), lake.bronze, "parquet", spread=False)
        landed_now = F.col("status") == "ready"
        outcomes = files.withColumns(
            {
                "status": F.when(landed_now, "success").otherwise(F.col("status")),
                "rows_loaded": F.when(landed_now, F.col("rows_loaded")).otherwise(0),
            }
        )
        result = _finish(spark, lake, outcomes, run)
        counts = {row.status: row["count"] for row in result.groupBy("status").count().collect()}
        record_run(
            spark, lake, run, "csv_ingestion", "success", counts.get("success", 0), rows_failed=counts.get("failed", 0)
        )
        return result
    except Exception as error:
        record_run(spark, lake, run, "csv_ingestion", "failed", error_message=str(error))
        raise


def ingest_payloads(
    spark: SparkSession,
    folder: str,
    lake: Lake,
    source: str,
    day: Column | None = None,
    run_id: str | None = None,
    pattern: str = "*.json",
) -> DataFrame:
    """Land service answers (one text file each) as record lines; returns one outcome row per answer.

    The folder is read once, into a staged copy. The answers are kept whole, one
    JSON line each, under ``<lake>/meta/answers``.
    An answer is known by its source and content, so the same answer fetched
    again under another file name is skipped. One whose records lack a field the
    contract requires fails alone, with the names of the columns.
    """
    if source not in API_SOURCES:
        raise ValueError(f"Unknown API source: {source}")
    run = run_id or str(uuid.uuid4())
    pipeline = f"api_{source}"
    record_run(spark, lake, run, pipeline, "running", run_type="api", source_system=source)
    try:
        texts = (
            spark.read.option("wholetext", True)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .text(folder)
            .select(
                "value",
                F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_modification_time").alias("last_modified"),
                F.col("_metadata.file_size").alias("file_size"),
            )
        )
        shaped = answers.shaped(texts, source)
        stage = f"{lake.meta}/staging/answers_{run}"
        hashed = shaped.withColumn("file_name", F.lit(source)).withColumn("file_hash", F.sha2("value", 256))
        hashed.write.mode("overwrite").parquet(f"{stage}/read")
        hashed = spark.read.parquet(f"{stage}/read")
        kept = hashed.select(F.to_json(F.struct("path", "file_hash", "value")).alias("value"))
        keep_payloads(kept, f"{lake.meta}/answers", source, run)
        firsts = hashed.groupBy("file_hash").agg(F.min("path").alias("path")).select("path", F.lit(True).alias("_first"))
        files = (
            hashed
            .join(_seen(spark, lake), ["file_name", "file_hash"], "left")
            .join(firsts, "path", "left")
            .select(
                "path",
                "file_name",
                "file_hash",
                "records",
                F.lit("global").alias("country"),
                F.lit(source).alias("source_system"),
                F.col("reject_reason").alias("reason"),
                F.size("records").cast("bigint").alias("rows_loaded"),
                "last_modified",
                "file_size",
                F.when(F.col("reject_reason").isNotNull(), "failed")
                .when(F.col("_seen") | F.col("_first").isNull(), "skipped")
                .otherwise("success")
                .alias("status"),
            )
        )
        files.write.mode("overwrite").parquet(f"{stage}/judged")
        staged = spark.read.parquet(f"{stage}/judged")
        records = staged.filter("status = 'success'").select(F.inline("records"))
        parts = with_bronze_parts(records, day=day, country=F.lit("global"), source=F.lit(source))
        land_bronze(parts, lake.bronze, "json")
        result = _finish(spark, lake, staged, run)
        landed = result.filter("status = 'success'").agg(F.coalesce(F.sum("rows_loaded"), F.lit(0))).first()[0]
        record_run(spark, lake, run, pipeline, "success", landed)
        return result
    except Exception as error:
        record_run(spark, lake, run, pipeline, "failed", error_message=str(error))
        raise


def ingest_table(
    spark: SparkSession,
    rows: DataFrame,
    lake: Lake,
    table: str,
    contract: Contract = BRONZE_SURVEY,
    source_system: str = "postgres_operational",
    day: Column | None = None,
    run_id: str | None = None,
) -> str:
    """Land a whole extracted table as one snapshot; returns the outcome.

    The rows are read once, into a staged copy; what is hashed is what is
    landed. The content hash is a sum over row hashes, so an unchanged table is
    recognised however it was partitioned when it was read.
    """
    run = run_id or str(uuid.uuid4())
    pipeline = f"db_{table}"
    record_run(spark, lake, run, pipeline, "running", run_type="db", source_system=source_system)
    try:
        stage = f"{lake.meta}/staging/table_{run}"
        rows.write.mode("overwrite").parquet(stage)
        rows = spark.read.schema(rows.schema).parquet(stage)
        mark = books.row_fingerprint(rows).first()
        missing = contract.missing_required(rows)
        if mark.rows == 0 or missing:
            reason = f"missing columns: {','.join(missing)}" if missing else "empty table"
            record_run(spark, lake, run, pipeline, "failed", error_message=reason)
            return "failed"
        entry = spark.createDataFrame(
            [(table, mark.file_hash, "global", source_system, mark.rows)],
            "file_name string, file_hash string, country string, source_system string, rows_loaded bigint",
        )
        if books.unseen_files(entry, processed_files(spark, lake)).isEmpty():
            record_run(spark, lake, run, pipeline, "skipped")
            return "skipped"
        parts = with_bronze_parts(rows, day=day, country=F.lit("global"), source=F.lit(source_system))
        land_bronze(parts, lake.bronze, "parquet", spread=False)
        append(books.ledger_entries(entry, batch_id=run), f"{lake.meta}/processed_files")
        record_run(spark, lake, run, pipeline, "success", mark.rows)
        return "success"
    except Exception as error:
        record_run(spark, lake, run, pipeline, "failed", error_message=str(error))
        raise


def ingest_databases(
    spark: SparkSession,
    url: str,
    lake: Lake,
    connection: dict[str, str] | None = None,
    splits: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, str]:
    """Extract and land every registered database table; tables fail independently.

    ``splits`` holds per dataset the ``split_column``, ``bounds`` and number of
    ``partitions`` of a parallel extract; a table without an entry is read by one task.
    """
    outcomes = {}
    for name, source in DB_SOURCES.items():
        try:
            rows = extract_table(spark, url, source["table_name"], connection, **(splits or {}).get(name, {}))
            outcomes[name] = ingest_table(
                spark, rows, lake, source["table_name"], source_system=source["source_system"]
            )
        except Exception as error:
            outcomes[name] = f"failed: {error}"
    return outcomes
