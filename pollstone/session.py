"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.ignoreCorruptFiles": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "pollstone", conf: Mapping[str, str] | None = None) -> SparkSession:
    """Create or reuse a session.

    The master, memory and executor sizes are left to ``spark-submit``; only
    settings that change results (time zone), skew handling, checkpoint
    cleaning or where streaming state lives are fixed here.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
