"""Helpers the corpus operators share: durable intermediate tables and binary rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollstone.functions.durable import shared_folder

#: Six white space characters of ASCII part words; nothing else does.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


_noting: list[list[str]] = []


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Adds to ``paths`` where :func:`stored` writes meanwhile."""
    _noting.append(paths)
    try:
        yield
    finally:
        _noting.pop()


def release(spark: SparkSession, paths: list[str], docs: DataFrame) -> list[str]:
    """Delete stored tables that ``docs`` doesn't read, and return the others; whatever else reads them is to be written by now."""
    if not paths:
        return []
    read = docs.inputFiles()
    wanted = [path for path in paths if any(f"/{path.rsplit('/', 1)[-1]}/" in file for file in read)]
    context = spark.sparkContext
    for path in set(paths).difference(wanted):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return wanted


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows, written once to the cluster's shared folder and read from there.

    A lost executor then costs no more than the tasks it was running.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    for paths in _noting:
        paths.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    """How many shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def frames(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Arrow batches as frames of a few megabytes, so that long texts don't pile up."""
    for batch in batches:
        size = max(1, batch.nbytes)
        step = max(1, batch.num_rows * most_bytes // size)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step).to_pandas()


def dealt(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each bucket that has rows: its number and their positions, in order."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    cuts = np.flatnonzero(np.diff(ranked)) + 1 if len(ranked) else np.zeros(0, int)
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(keys[rows[0]]), rows
