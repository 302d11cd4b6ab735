"""Places of rows within groups, from one range shuffle; a group of any size is spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.llm.stored import stored

PART_BITS = 33  # monotonically_increasing_id: the partition above, the row within it below


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add `rank` (from 0) of each row within its group and `n`, the rows of the group. Null groups count as one group.

    `order` should tell all rows apart that are not the same. The sorted rows are written once, with their numbers, so a
    repeated task can't deal other ranks. What is summed up has one row per group and partition.
    """
    keys = [F.col(c).asc_nulls_first() for c in group]
    placed = (
        rows.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("at", F.monotonically_increasing_id())
    )
    written, _ = stored(placed, name)
    part = F.shiftright("at", PART_BITS)
    pieces = written.groupBy(*group, part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("held"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        *[F.col(c).alias(f"start_{c}") for c in group],
        F.col("part").alias("start_part"),
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(whole).alias("n"),
    )
    same = part == F.col("start_part")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"start_{c}"))
    return written.join(starts, same).select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "n")
