"""Extendible hashing of documents to shards under a byte limit, in DataFrame operations only.

The directory is indexed by the leading bits of a hash. A bucket that is too
large splits on one more bit; the others stay as they are. As splitting only
depends on how many bytes lie under each prefix, the directory is worked out
from a histogram of prefixes instead of by moving documents: prefixes of one
depth are summed up to all shallower depths, and the shallowest that fits is
the shard. Only prefixes that are still too large go to the next round, with
more bits.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import parts, stored, text_or_empty

SHARD_BYTES = 1 << 20
#: Bits of a hash in all, and how many more than the expected depth a round looks at.
BITS = 60
SPARE = 4
#: Copies of a row that one task numbers at a time.
COPIES = 4096


def _hashed(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, h)`` for each row; rows of one id and size are numbered, so that they can part."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"))
    counted = rows.groupBy("doc_id", "n_bytes").agg(F.count("*").alias("copies"))
    blocks = counted.withColumn("block", F.expr(f"explode(sequence(0L, (copies - 1) DIV {COPIES}))"))
    spread = blocks.repartition(parts(docs.sparkSession), "doc_id", "n_bytes", "block")
    numbered = spread.withColumn(
        "copy", F.expr(f"explode(sequence(block * {COPIES} + 1, least(copies, (block + 1) * {COPIES})))")
    )
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "n_bytes", "copy")
    return numbered.select("doc_id", "n_bytes", F.conv(F.substring(F.md5(named), 1, BITS // 4), 16, 10).cast("long").alias("h"))


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, shard, local_depth, shard_bytes, shard_docs)`` for each row of ``docs``.

    ``shard`` is the hash prefix in binary, empty if all fit in one. A document
    is never cut: one above the limit has a shard of its own, the only kind
    above the limit. Null texts have no bytes, a null doc_id hashes as empty,
    repeated rows are dealt out one by one, no rows give no shards, and other
    columns play no part.
    """
    rows = stored(_hashed(docs), "hashed")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS, SPARE + max(0, ceil(log2(max(1, total) / limit))))
    shallow, done = 0, []
    while True:
        cell = F.shiftright("h", BITS - depth).alias("cell")
        cells = stored(rows.groupBy(cell).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")), "cells")
        levels = cells.withColumn("local_depth", F.explode(F.sequence(F.lit(shallow), F.lit(depth))))
        levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - local_depth)"))
        buckets = levels.groupBy("local_depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        last = depth == BITS
        fitting = buckets.where(f"shard_bytes <= {limit} OR shard_docs = 1" + (f" OR local_depth = {depth}" if last else ""))
        found = (
            levels.join(fitting, ["local_depth", "prefix"])
            .groupBy("cell")
            .agg(F.min(F.struct("local_depth", "prefix", "shard_bytes", "shard_docs")).alias("s"))
        )
        directory = stored(cells.select("cell").join(found, "cell", "left").select("cell", "s"), "directory")
        dealt = rows.withColumn("cell", cell).join(directory, "cell")
        done.append(dealt.where("s IS NOT NULL").select("doc_id", "n_bytes", "s.*"))
        if last or directory.where("s IS NULL").isEmpty():
            break
        rows = stored(dealt.where("s IS NULL").select("doc_id", "n_bytes", "h"), "hashed")
        shallow, depth = depth + 1, min(BITS, depth + SPARE)
    name = F.expr("CASE WHEN local_depth = 0 THEN '' ELSE lpad(bin(prefix), local_depth, '0') END")
    return reduce(DataFrame.unionByName, done).select(
        "doc_id", "n_bytes", name.alias("shard"), "local_depth", "shard_bytes", "shard_docs"
    )


ORACLE = f"""
WITH counted AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, n_bytes) AS copy FROM counted
), hashed AS (
  SELECT *, row_number() OVER () AS r,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || n_bytes || ':' || copy), 1, 15))::BIGINT AS h FROM numbered
), prefixed AS (
  SELECT r, doc_id, n_bytes, d, h >> ({BITS} - d) AS prefix FROM hashed, (SELECT unnest(range(0, {BITS + 1}))::INT AS d)
), buckets AS (
  SELECT d, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_docs FROM prefixed GROUP BY d, prefix
), fitting AS (
  SELECT p.*, b.shard_bytes, b.shard_docs, row_number() OVER (PARTITION BY r ORDER BY d) AS k
  FROM prefixed p JOIN buckets b USING (d, prefix) WHERE shard_bytes <= {SHARD_BYTES} OR shard_docs = 1 OR d = {BITS}
)
SELECT doc_id, n_bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(prefix), d, '0') END AS shard,
  d AS local_depth, shard_bytes, shard_docs
FROM fitting WHERE k = 1
"""
