"""Cutting lineage so that a lost executor cannot change a result."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Only a local session without one gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would be lost
    together with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if folder:
        return folder
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"Set {CHECKPOINT_SETTING} to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pollstone-"))
    return spark.sparkContext.getCheckpointDir()  # the session's from now on


def durable(df: DataFrame) -> DataFrame:
    """Write the rows once and go on from the written copy."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
