"""The four bookkeeping tables of a lake, kept as append-only Parquet."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.contracts.model import Contract
from pollstone.operators import ledger
from pollstone.operators.quality import quality_by_country
from pollstone.sources.registry import Lake


def read_book(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A bookkeeping table, empty before its first entry."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def processed_files(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_book(spark, f"{lake.meta}/processed_files", ledger.PROCESSED_FILES_SCHEMA)


def record_run(
    spark: SparkSession, lake: Lake, run_id: str, pipeline: str, status: str, rows_processed: int = 0, **details
) -> None:
    """Append one event of a run; its state is read with :func:`pipeline_runs`.

    ``details`` are further columns of the run events, such as ``run_type``,
    ``rows_failed`` or ``error_message``.
    """
    if status not in ledger.RUN_STATES:
        raise ValueError(f"Unknown run status: {status}")
    values = {
        "run_id": run_id,
        "dag_id": pipeline,
        "pipeline_name": pipeline,
        "event_time": datetime.now(UTC).replace(tzinfo=None),
        "event_no": ledger.RUN_STATES.index(status),
        "status": status,
        "rows_processed": rows_processed,
        **details,
    }
    names = T.StructType.fromDDL(ledger.RUN_EVENTS_SCHEMA).names
    event = spark.createDataFrame([tuple(values.get(name) for name in names)], ledger.RUN_EVENTS_SCHEMA)
    append(event.coalesce(1), f"{lake.meta}/run_events")


def pipeline_runs(spark: SparkSession, lake: Lake) -> DataFrame:
    """Current state of every run."""
    return ledger.current_runs(read_book(spark, f"{lake.meta}/run_events", ledger.RUN_EVENTS_SCHEMA))


def record_quality(spark: SparkSession, lake: Lake, run_id: str, survey: DataFrame) -> None:
    """Append the quality of the clean responses per country."""
    metrics = quality_by_country(survey).select(
        F.uuid().alias("metric_id"), F.lit(run_id).alias("run_id"), "*", F.current_timestamp().alias("created_at")
    )
    append(metrics, f"{lake.meta}/data_quality_metrics")


def data_quality_metrics(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_book(spark, f"{lake.meta}/data_quality_metrics", ledger.QUALITY_METRICS_SCHEMA)


KEY_CHECKS_SCHEMA = "run_id string, dataset_name string, key string, rows bigint, null_keys bigint, repeated_keys bigint"


def record_keys(spark: SparkSession, lake: Lake, run_id: str, contract: Contract, df: DataFrame) -> None:
    """Append how far a table keeps the primary key of its contract."""
    append(contract.key_check(df).select(F.lit(run_id).alias("run_id"), "*"), f"{lake.meta}/key_checks")


def key_checks(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_book(spark, f"{lake.meta}/key_checks", KEY_CHECKS_SCHEMA)


def rejected_rows(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """Raw rows of all runs that break the dataset's contract, with what they break."""
    return spark.read.option("mergeSchema", True).parquet(f"{lake.meta}/rejects/{dataset}")


def incremental_state(spark: SparkSession, lake: Lake) -> DataFrame:
    """Last successful load and running total per source, from the processed files."""
    return ledger.incremental_state(processed_files(spark, lake))
