"""The keys a growing table holds, filed by hash: a batch reads only the buckets that its own keys fall into.

Keys of a load go to ``<root>/bucket=.../load=...``, so the buckets of a batch
are found by folder and the others are not even listed. Writing a load again
replaces it.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.sources.readers import missing_path

#: Folder parts: the load that rows came with, and the bucket of a key. More buckets suit larger tables and small batches.
LOAD, BUCKET = "load", "bucket"
BUCKETS = 16
_KEY, _HELD = "held_key", "_held"


@dataclass(frozen=True)
class HeldKeys:
    """Index of the column ``key``; each number of ``buckets`` has an index of its own below ``place``."""

    place: str
    key: str
    kind: T.DataType
    buckets: int = BUCKETS

    @property
    def root(self) -> str:
        return f"{self.place}/of={self.buckets}"

    def bucket(self, key: str) -> Column:
        return F.expr(f"CAST(pmod(xxhash64(`{key}`), {self.buckets}L) AS INT)")

    def read(self, spark: SparkSession, buckets: Collection[int] | None = None) -> DataFrame:
        """``held_key, bucket, load`` of the wanted buckets, of all if none are named."""
        schema = T.StructType(
            [T.StructField(_KEY, self.kind), T.StructField(BUCKET, T.IntegerType()), T.StructField(LOAD, T.StringType())]
        )
        some = "*" if buckets is None else "{" + ",".join(map(str, sorted(buckets))) + "}"
        try:
            return spark.read.schema(schema).option("basePath", self.root).parquet(f"{self.root}/{BUCKET}={some}")
        except AnalysisException as error:
            if not missing_path(error):
                raise
            return spark.createDataFrame([], schema)

    def add(self, rows: DataFrame) -> None:
        """File the keys of ``rows``, which tell their ``load``."""
        keys = rows.select(F.col(self.key).alias(_KEY), self.bucket(self.key).alias(BUCKET), LOAD)
        writer = keys.repartition(BUCKET, LOAD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET, LOAD).parquet(self.root)

    def catch_up(self, table: DataFrame) -> None:
        """File the loads of ``table`` that the index lacks or has in part: a table from before it, or a broken run's.

        Both sides are counted by load, which reads no column of the table.
        """
        count = F.count(F.lit(1))
        there = table.groupBy(LOAD).agg(count.alias("rows"))
        filed = self.read(table.sparkSession).groupBy(LOAD).agg(count.alias("keys"))
        lacking = there.join(filed, LOAD, "left").where("NOT rows <=> keys").select(LOAD)
        loads = [row[LOAD] for row in lacking.toLocalIterator()]
        if loads:
            self.add(table.where(F.col(LOAD).isin(loads)))

    def missing(self, rows: DataFrame, load: str) -> DataFrame:
        """Those of ``rows`` whose key no other load brought; no key at all counts as one key."""
        hit = [row[0] for row in rows.select(self.bucket(self.key)).distinct().collect()]  # at most ``buckets``
        if not hit:
            return rows
        held = self.read(rows.sparkSession, hit).where(F.col(LOAD) != load).select(F.col(_KEY).alias(_HELD))
        return rows.join(held, rows[self.key].eqNullSafe(held[_HELD]), "left_anti")
