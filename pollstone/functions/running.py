"""Running totals that do not gather a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK, _TOTAL, _BEFORE, _KEY = "_block", "_block_total", "_before_block", "_block_key"


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, output: str, block: Column) -> DataFrame:
    """Add ``SUM(value) OVER (PARTITION BY group ORDER BY order)`` with a ROWS frame.

    ``group + order`` must identify a row, which also makes the total
    deterministic. ``block`` cuts a group along ``order``: it must never go
    down as ``order`` goes up, as the month of a day does. A block is summed on
    its own and then shifted by what the earlier blocks of its group add up to,
    so a group that holds a third of the table is spread over its blocks. Blocks
    come from the data alone, so nothing has to be written: a task that is run
    again sees the same ones. The rows are read twice, once for the sums.
    """
    blocks = df.withColumn(_BLOCK, block)
    earlier = Window.partitionBy(*group).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # Group and block as one value that is never NULL: the window and the join
    # then ask for the same partitioning, and the wide side is shuffled once.
    key = F.struct(_BLOCK, *group).alias(_KEY)
    offsets = (
        blocks.groupBy(_BLOCK, *group)
        .agg(F.sum(value).alias(_TOTAL))
        .select(key, F.coalesce(F.sum(_TOTAL).over(earlier), F.lit(0)).alias(_BEFORE))
    )
    inside = Window.partitionBy(_KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocks.select("*", key)
        .withColumn(output, F.sum(value).over(inside))
        .join(offsets, _KEY, "left")
        .select(*df.columns, (F.col(output) + F.col(_BEFORE)).alias(output))
    )
