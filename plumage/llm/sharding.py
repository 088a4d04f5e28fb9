"""Sharding by longest processing time.

Rows with equal texts stay together. The groups, sorted by size from the
largest, go one by one to the least loaded shard, which a heap gives.

Nothing unbounded reaches the driver: a group of at least 1/LOTS of all bytes
is scheduled by itself (there can be at most LOTS of these); all smaller groups
are first bound into LOTS lots by the hash of their text, and each lot is
scheduled like a group. So the heap sees at most 2 * LOTS entries at any corpus
size, and a lot is small against a shard. While the corpus has few groups,
nearly every group has a lot of its own.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumage.llm.common import land, text_or_empty

LOTS = 1 << 16
#: Rows of one shard that one task numbers.
SLOT_ROWS = 100_000


def schedule(sizes: list[tuple[int, tuple]], shards: int) -> dict[tuple, int]:
    """Shard of each (size, name): largest first, each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def numbered(df: DataFrame, group: str, key: str, rows: int, alias: str) -> DataFrame:
    """Add ``alias``: 0, 1, 2, ... within each ``group``, without one task per group.

    Rows of a group are dealt into blocks by the hash of ``key``; a task
    numbers a block of about SLOT_ROWS rows, and block offsets are running
    sums over the small table of block counts.
    """
    blocks = max(1, rows // SLOT_ROWS)
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    inside = Window.partitionBy(group, "_block").orderBy(key, "_tie")
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    out = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    return (out.join(counts, [group, "_block"])
            .withColumn(alias, (F.col("_base") + F.col("_in")).cast("long"))
            .drop("_block", "_base", "_in"))


def shard_longest_first(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                        text_col: str = "text", lots: int = LOTS) -> DataFrame:
    """Place every row into one of ``shards`` shards of nearly equal bytes.

    Size: UTF-8 bytes of the text plus 1. A NULL text counts as the empty text
    (size 1, checksum 0, grouped with it); repeated rows are rows of one group;
    NULL ids are placed like others; an empty table gives an empty result.
    Other columns of ``docs`` are not looked at. Returns id, size, text_crc32,
    shard and slot (gapless from 0 in each shard).
    """
    text = text_or_empty(text_col)
    rows = land(docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_group")), "shard-rows")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    large = F.col("_bytes") * lots >= F.lit(total)
    units = (groups.withColumn("_large", large)
             .withColumn("_unit", F.when(large, F.col("_group")).otherwise(F.pmod("_group", F.lit(lots))))
             .groupBy("_large", "_unit").agg(F.sum("_bytes").alias("_bytes")))
    # at most `lots` large groups and `lots` lots, whatever the corpus holds
    found = [(r["_bytes"], (r["_large"], r["_unit"])) for r in units.collect()]
    placed = schedule(found, shards)
    spark = docs.sparkSession
    one = T.StructType([T.StructField("_k", T.LongType()), T.StructField("_s", T.IntegerType())])
    tables = [spark.createDataFrame([(k, s) for (is_large, k), s in placed.items() if is_large is big], one)
              .select(F.col("_k").alias(key), F.col("_s").alias(out))
              for big, key, out in ((True, "_group", "_s1"), (False, "_lot", "_s2"))]
    out = (rows.withColumn("_lot", F.pmod("_group", F.lit(lots)))
           .join(F.broadcast(tables[0]), "_group", "left")
           .join(F.broadcast(tables[1]), "_lot", "left")
           .withColumn("shard", F.coalesce("_s1", "_s2")).withColumn("_tie", F.col("_group")))
    return numbered(out, "shard", "_id", n // shards, "slot").select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", "slot")
