"""Connected components of a link table, by rounds of min-label star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollstone.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a``, ``b``; longs).

    ``component`` is the smallest node that can be reached. Each round hangs
    every node below the smallest node among itself and its neighbours (large
    star, then small star), so long chains shrink by a constant factor a
    round. Hubs are safe: only their minimum is aggregated, before the
    shuffle, and the join on a hub is split by adaptive execution. Rows with a
    null, self links and repeated links change nothing; no links, no rows.
    """
    edges = stored(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
