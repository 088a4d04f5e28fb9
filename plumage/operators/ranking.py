"""Ranks 1, 2, 3... over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumage.session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id(): partition above, row in it below


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with ``name`` (long), its row's place in ``order``.

    Rows are range-partitioned and sorted by ``order``; a row's rank is its place
    in its partition plus the rows of the partitions before, of which there is
    one count each. The order should end with a nearly unique column: rows that
    are equal in all of it share a partition. ``df`` is read twice (the range
    bounds are sampled), so it should be a landed table.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    placed = cut_lineage(df.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("_at", place),
                         "ranked")
    part = F.shiftright("_at", _POSITION_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the window over them is bounded by the shuffle width
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + 1
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + within).alias(name))
