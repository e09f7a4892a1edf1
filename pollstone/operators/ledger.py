"""Bookkeeping tables: processed files, pipeline runs, incremental state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.operators.dedup import drop_key_copies

# Run states and their log levels; ledger columns.
RUN_LEVELS = {"success": "info", "running": "info", "skipped": "warning", "failed": "error"}
RUN_STATES = tuple(RUN_LEVELS)
PROCESSED = "processed"
PROCESSED_FILES_SCHEMA = (
    "file_id string, file_name string, file_hash string, country string, source_system string, "
    "ingestion_timestamp timestamp, processing_status string, rows_loaded bigint, batch_id string, "
    "last_modified timestamp, file_size bigint, created_at timestamp"
)
RUN_ATTRIBUTES = ("dag_id", "task_id", "pipeline_name", "run_type", "country", "source_system", "trigger_type", "environment")
RUN_EVENTS_SCHEMA = (
    "run_id string, dag_id string, task_id string, pipeline_name string, run_type string, country string, "
    "source_system string, trigger_type string, environment string, event_time timestamp, event_no int, "
    "status string, rows_processed bigint, rows_failed bigint, validation_pass_rate double, error_message string"
)
QUALITY_METRICS_SCHEMA = (
    "metric_id string, run_id string, country string, dataset_name string, completeness_score double, "
    "duplicate_rate double, null_percentage double, validation_status string, failed_checks array<string>, "
    "created_at timestamp"
)



def unseen_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose name and content hash have no processed entry yet."""
    done = ledger.filter(F.col("processing_status") == PROCESSED).select("file_name", "file_hash")
    return files.join(done, ["file_name", "file_hash"], "left_anti")


def absent_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """Rows of ``new`` whose key the table does not hold, one per key (insert if absent)."""
    return drop_key_copies(new, keys).join(existing.select(*keys), list(keys), "left_anti")


def ledger_entries(
    files: DataFrame,
    batch_id: str | None = None,
    status: str = PROCESSED,
    at: Column | None = None,
) -> DataFrame:
    """Ledger rows for files that were landed."""
    stamp = F.current_timestamp() if at is None else at
    optional = {
        "rows_loaded": "bigint",
        "last_modified": "timestamp",
        "file_size": "bigint",
    }
    extra = [
        (F.col(name) if name in files.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in optional.items()
    ]
    return files.select(
        F.uuid().alias("file_id"),
        "file_name",
        "file_hash",
        "country",
        "source_system",
        stamp.alias("ingestion_timestamp"),
        F.lit(status).alias("processing_status"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        stamp.alias("created_at"),
        *extra,
    )


def log_level(status: Column) -> Column:
    """Log level of a run state; unknown states are info."""
    pairs = [F.lit(text) for item in RUN_LEVELS.items() for text in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), status), F.lit("info"))


def valid_status(status: Column) -> Column:
    return status.isin(*RUN_STATES)


def current_runs(events: DataFrame, now: Column | None = None) -> DataFrame:
    """State of each run from its events: the first one opened it, the last one counts.

    ``events`` holds ``run_id, event_time, event_no, status, rows_processed``
    and optionally ``rows_failed, validation_pass_rate, end_time,
    duration_seconds, error_message`` and the run's attributes (name, type,
    country, source), which count from the first event. A finished run without an end time ends
    at ``now`` (by default at its last event); a missing duration is the time from start to end. Both ends
    come from one aggregate, combined before the shuffle.
    """
    kinds = {
        "status": "string",
        "rows_processed": "bigint",
        "rows_failed": "bigint",
        "validation_pass_rate": "double",
        "error_message": "string",
        "end_time": "timestamp",
        "duration_seconds": "double",
    }
    details = [
        (F.col(name) if name in events.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in kinds.items()
    ]
    known = [name for name in RUN_ATTRIBUTES if name in events.columns]
    moment = F.struct("event_time", "event_no")
    runs = events.groupBy("run_id").agg(
        F.min_by(F.struct("event_time", *known), moment).alias("_first"),
        F.min("event_time").alias("start_time"),
        F.count(F.lit(1)).alias("events"),
        F.max_by(F.struct("event_time", *details), moment).alias("_last"),
    )
    running = F.col("_last.status") == "running"
    end = F.when(~running, F.coalesce(F.col("_last.end_time"), F.col("_last.event_time") if now is None else now))
    span = (F.unix_micros(F.to_timestamp(end)) - F.unix_micros(F.to_timestamp("start_time"))) / 1_000_000
    return runs.select(
        "run_id",
        *[F.col(f"_first.{name}").alias(name) for name in known],
        "start_time",
        end.alias("end_time"),
        F.when(~running, F.coalesce(F.col("_last.duration_seconds"), span)).alias("duration_seconds"),
        F.col("_last.status").alias("status"),
        F.col("_last.rows_processed").alias("rows_processed"),
        F.coalesce(F.col("_last.rows_failed"), F.lit(0)).alias("rows_failed"),
        F.col("_last.validation_pass_rate").alias("validation_pass_rate"),
        F.col("_last.error_message").alias("error_message"),
        log_level(F.col("_last.status")).alias("log_level"),
        "events",
    )


def incremental_state(ledger: DataFrame, source: Sequence[str] = ("source_system",)) -> DataFrame:
    """Per source: last successful date, time and run, and rows loaded so far."""
    done = ledger.filter(F.col("processing_status") == PROCESSED)
    return done.groupBy(F.concat_ws("/", *source).alias("source_key")).agg(
        F.max(F.to_date("ingestion_timestamp")).alias("last_successful_date"),
        F.max("ingestion_timestamp").alias("last_ingestion_ts"),
        F.max_by("batch_id", F.struct("ingestion_timestamp", "batch_id")).alias("last_run_id"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_processed_total"),
    )


def newer_rows(
    rows: DataFrame,
    state: DataFrame,
    time: str,
    landed: DataFrame,
    keys: Sequence[str],
    source: str = "source_key",
) -> DataFrame:
    """Rows from the time of their source's last load on that have not landed; unknown sources pass whole.

    A row may come late with the very time of the mark, so such rows are told
    apart by their keys.
    """
    marks = state.select(F.col("source_key").alias("_key"), F.col("last_ingestion_ts").alias("_mark"))
    joined = rows.join(marks, rows[source] == F.col("_key"), "left")
    newer = joined.filter(F.col("_mark").isNull() | (F.col(time) >= F.col("_mark"))).drop("_key", "_mark")
    return newer.join(landed.select(*keys), list(keys), "left_anti")


def row_fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count and an order-independent hash of the content.

    Rows are hashed where they are and only the sums meet, so a table of any
    size and layout gives the same value again. Every value is hashed with the
    place of its column and a flag for NULL, as the hash itself skips NULLs: a
    value that moves to the next column changes the row. Two independent
    hashes are added up, so equal rows in any number count. Nested values,
    which can hold NULLs of their own, count as JSON.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)

    def value(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.to_json(F.struct(column), {"ignoreNullFields": "false"}) if isinstance(field.dataType, nested) else column

    cells = [cell for field in df.schema.fields for cell in (F.col(f"`{field.name}`").isNull(), value(field))]
    hashes = [F.xxhash64(F.lit(salt), *cells).cast("decimal(20,0)") for salt in (0, 1)]
    rows = df.select(*[h.alias(f"h{k}") for k, h in enumerate(hashes)])
    sums = [F.coalesce(F.sum(f"h{k}"), F.lit(0)).cast("string") for k in range(len(hashes))]
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("file_hash"))
