"""Parquet tables that are updated by part: a run writes the parts it touches, one commit says which.

A run's rows go to ``<root>/run_id=.../part=...``, where nothing reads them yet.
Its commit, one small file in ``<root>_commits``, names the parts, how many
rows each has now, and the inputs they came from. A part's rows are those of
the newest commit that names it, so a run that breaks before its commit has
changed nothing, and parts and inputs are known together or not at all. One
run may write at a time. Folders of older runs may be removed once no reader
is left.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollstone.plans.bookkeeping import append, read_book
from pollstone.sources.writers import spread_by

COMMITS_SCHEMA = "seq bigint, run_id string, part string, rows bigint, input string"
PART, RUN = "part", "run_id"


def part_of(*columns: str) -> Column:
    """The part of a row by the values of its columns, as a folder name without special characters."""
    return F.lower(F.hex(F.xxhash64(*[cell for name in columns for cell in (F.col(name).isNull(), F.col(name))])))


@dataclass(frozen=True)
class PartedTable:
    """``by`` are the columns that give a row its part; ``log`` is the commit file of tables that are committed together."""

    spark: SparkSession
    root: str
    schema: T.StructType
    by: tuple[str, ...]
    log: str | None = None

    def _log(self) -> str:
        return self.log or f"{self.root}_commits"

    def commits(self) -> DataFrame:
        return read_book(self.spark, self._log(), COMMITS_SCHEMA)

    def inputs(self) -> DataFrame:
        """Names of all inputs that committed runs took in."""
        return self.commits().where("input IS NOT NULL").select("input").distinct()

    def has(self, run_id: str) -> bool:
        return not self.commits().where(F.col(RUN) == run_id).isEmpty()

    def newest(self) -> DataFrame:
        """``part``, ``run_id``, ``rows`` and ``seq`` of the newest commit of each part."""
        last = self.commits().where("part IS NOT NULL").groupBy(PART).agg(F.max(F.struct("seq", RUN, "rows")).alias("c"))
        return last.select(PART, f"c.{RUN}", "c.rows", "c.seq")

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The committed rows, with their ``part``; only the folders of the wanted parts are read.

        The names of parts pass the driver, rows don't.
        """
        wanted = None if parts is None else set(parts)
        runs: dict[str, list[str]] = {}
        for row in self.newest().toLocalIterator():
            if row.rows != 0 and (wanted is None or row.part in wanted):
                runs.setdefault(row.run_id, []).append(row.part)
        schema = T.StructType([*self.schema.fields, T.StructField(RUN, T.StringType()), T.StructField(PART, T.StringType())])
        if not runs:
            return self.spark.createDataFrame([], schema).drop(RUN)
        rows = self.spark.read.schema(schema).option("basePath", self.root).parquet(*[f"{self.root}/{RUN}={run}" for run in runs])
        current = [(F.col(RUN) == run) & F.col(PART).isin(some) for run, some in runs.items()]
        return rows.where(reduce(Column.__or__, current)).drop(RUN)

    def write(self, df: DataFrame, run_id: str) -> DataFrame:
        """Write a run's rows, not committed yet; returns them as written, with their ``part``."""
        path = f"{self.root}/{RUN}={run_id}"
        rows = df.select(*[F.col(f"`{name}`") for name in self.schema.names]).withColumn(PART, part_of(*self.by))
        spread_by(rows, [PART]).write.mode("overwrite").partitionBy(PART).parquet(path)
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])
        return self.spark.read.schema(schema).parquet(path)

    def commit(self, run_id: str, parts: Mapping[str, int | None], inputs: Sequence[str] = ()) -> None:
        """Make a run's rows the rows of ``parts``; one with zero rows is empty from now on, None says that they aren't counted."""
        seq = (self.commits().agg(F.max("seq")).first()[0] or 0) + 1
        entries = [(seq, run_id, part, rows, None) for part, rows in sorted(parts.items())]
        entries += [(seq, run_id, None, None, name) for name in inputs]
        append(self.spark.createDataFrame(entries or [(seq, run_id, None, None, None)], COMMITS_SCHEMA).coalesce(1), self._log())
