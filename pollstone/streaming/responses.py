"""Incremental jobs on a stream of raw responses: clean, deduplicate, count per day.

Files are taken up exactly once: the checkpoint remembers what was read. The
ingest asks an index of the target's keys what it holds, so a response is kept
however late it comes, and the kept daily counts are corrected by late rows. The
windowed forms bound their state by a watermark instead, and rows that come
after it are left out of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from pollstone.functions.durable import durable
from pollstone.functions.expr import completed, count_where
from pollstone.operators.cleaning import add_silver_metadata, clean_survey_responses
from pollstone.operators.dedup import drop_key_copies
from pollstone.plans.parted import PART, PartedTable, part_of
from pollstone.sources.readers import missing_path
from pollstone.streaming.held_keys import LOAD, HeldKeys

EVENT_TIME = "submission_timestamp"
#: What daily counts are kept by, and the counts. The days of a quarter are rewritten together.
DAY = ("submission_date", "country", "region")
COUNTS = ("daily_response_count", "completed_response_count")
DAILY_SCHEMA = (
    "submission_quarter date, submission_date date, country string, region string, "
    "daily_response_count bigint, completed_response_count bigint"
)


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    file_format: str = "csv",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files that arrive in a folder, each one once."""
    reader = spark.readStream.schema(schema)
    if file_format == "csv":
        reader = reader.option("header", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(file_format).load(folder)


def clean_stream(responses: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return add_silver_metadata(clean_survey_responses(responses), processed_at=processed_at)


def unique_responses(responses: DataFrame, delay: str = "7 days", key: str = "response_id") -> DataFrame:
    """First arrival per response within the watermark, across batches."""
    return responses.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark([key])


def daily_volume(responses: DataFrame, delay: str = "2 days") -> DataFrame:
    """Responses per day, country and region; a day is final once the watermark passes its end."""
    return (
        responses.withWatermark(EVENT_TIME, delay)
        .groupBy(F.window(EVENT_TIME, "1 day"), "country", "region")
        .agg(
            F.count(F.lit(1)).alias("daily_response_count"),
            count_where(completed()).alias("completed_response_count"),
        )
        .select(
            F.to_date("window.start").alias("submission_date"),
            "country",
            "region",
            "daily_response_count",
            "completed_response_count",
        )
    )


def append_available(stream: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> None:
    """Process everything that has arrived, append it to a table folder, and stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(target).awaitTermination()


def _held(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Rows the target has, with the load they came in; none if there is no target yet."""
    full = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    try:
        return spark.read.schema(full).parquet(target)
    except AnalysisException as error:
        if not missing_path(error):
            raise
        return spark.createDataFrame([], full)


def _load(batch: DataFrame, number: int) -> str:
    """A name for a batch that is the same when the batch is run again."""
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"


def append_new(stream: DataFrame, target: str, checkpoint: str, key: str = "response_id") -> None:
    """Append what has arrived to a table folder, one row per key; keys the table holds are passed over.

    Each batch has a folder of its own, named by query and batch. A batch that
    is run again after a failure replaces its folder and does not look at it.
    Rows without a key count as one key. What the table holds is looked up in
    ``<target>_keys``, where a batch reads the buckets of its own keys only; the
    index is brought up to the table before the first batch of a run.
    """
    held = HeldKeys(f"{target}_keys", key, stream.schema[key].dataType)
    held.catch_up(_held(stream.sparkSession, target, stream.schema))

    def take(batch: DataFrame, number: int) -> None:
        load = _load(batch, number)
        folder = f"{target}/{LOAD}={load}"
        held.missing(drop_key_copies(batch, [key]), load).write.mode("overwrite").parquet(folder)
        held.add(batch.sparkSession.read.schema(batch.schema).parquet(folder).withColumn(LOAD, F.lit(load)))

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def daily_table(spark: SparkSession, root: str) -> PartedTable:
    return PartedTable(spark, root, T.StructType.fromDDL(DAILY_SCHEMA), ("submission_quarter",))


def kept_daily_volume(spark: SparkSession, root: str) -> DataFrame:
    """Daily counts as :func:`keep_daily_volume` left them."""
    return daily_table(spark, root).read().select(*DAY, *COUNTS)


def keep_daily_volume(responses: DataFrame, root: str, checkpoint: str) -> None:
    """Add what has arrived to the daily counts below ``root``, however late it comes.

    A batch is counted first; then the counts of the quarters it touches are
    read, added to and published by one commit, named by query and batch. A
    batch that is run again after its commit is passed over, so no row counts
    twice. Rows without a date are a day of their own. A new checkpoint reads
    all files again and needs a new ``root``.
    """

    def take(batch: DataFrame, number: int) -> None:
        table, run = daily_table(batch.sparkSession, root), _load(batch, number)
        if table.has(run):
            return
        day = F.to_date(EVENT_TIME)
        counts = (
            batch.groupBy(F.trunc(day, "quarter").alias("submission_quarter"), day.alias("submission_date"), "country", "region")
            .agg(F.count(F.lit(1)).alias(COUNTS[0]), count_where(completed()).alias(COUNTS[1]))
            .withColumn(PART, part_of(*table.by))
        )
        counts = durable(counts)
        touched = [row[PART] for row in counts.select(PART).distinct().collect()]  # quarters
        both = table.read(touched).unionByName(counts).groupBy("submission_quarter", *DAY)
        written = table.write(both.agg(*[F.sum(name).alias(name) for name in COUNTS]), run)
        table.commit(run, {row[PART]: row["count"] for row in written.groupBy(PART).count().collect()})

    writer = responses.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def ingest_responses(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    file_format: str = "csv",
    files_per_batch: int | None = None,
) -> None:
    """New raw files to clean, unique rows; run it again whenever files have arrived.

    Of a response that comes in several batches the first is kept.
    """
    raw = read_stream(spark, folder, schema, file_format, files_per_batch=files_per_batch)
    append_new(clean_stream(raw), target, checkpoint)
