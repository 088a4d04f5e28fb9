"""Exact dedup as a stateful stream.

The documents are read as a stream of files. Spark keeps one state row per
digest, on disk (RocksDB, committed to the shared checkpoint folder) and
without expiry: the stable identifier of the row to keep, its content locator
(the file it lies in) and the number of rows seen. Rows with one digest are
combined before they are shuffled, so a text that is a third of the corpus is
one small row per task. A digest is only a hint: wherever one is hit again, the
full bytes of the rows are compared with those of the kept row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import land, text_or_empty
from plumage.session import scratch_path

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commits write what changed instead of whole database files, and files are not preallocated
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_STATE_SCHEMA = "digest binary, keep_id long, locator string, group_size long, batch long"


def digest_state(stream: DataFrame) -> DataFrame:
    """The keyed state over a stream of (id, digest, locator): a streaming aggregate.

    The largest id of a digest stays. There is no watermark, so no key expires.
    """
    best = F.max(F.struct("id", "locator"))
    return (stream.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("best.id").alias("keep_id"), F.col("best.locator").alias("locator"), "group_size"))


def run_stream(state: DataFrame, checkpoint: str, target: str) -> None:
    """Run the stream over all files there are; every batch writes the state rows it changed.

    A batch that is run again after a failure overwrites its own folder, and
    the checkpoint makes a restarted stream go on where it stopped.
    """
    def land(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{target}/b{batch}")

    spark = state.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").foreachBatch(land)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are; NULL counts as empty. Of equal texts
    the largest id stays. The columns are landed as Parquet in the shared
    folder first, because a stream reads files. Repeated rows with one id and
    one text all count in group_size and carry ``kept`` alike, as they are one
    document. A NULL id is below every other id. An empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    source, target = scratch_path(spark, "exact-dedup-input"), scratch_path(spark, "exact-dedup-state")
    docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                text.alias("text")).write.parquet(source)
    spark.createDataFrame([], _STATE_SCHEMA).write.parquet(f"{target}/b_none")
    stream = spark.readStream.schema("id long, digest binary").parquet(source)
    run_stream(digest_state(stream.withColumn("locator", F.input_file_name())),
               scratch_path(spark, "exact-dedup-checkpoint"), target)
    # the last batch that touched a digest has its final state
    state = land(spark.read.schema(_STATE_SCHEMA).parquet(f"{target}/b*").groupBy("digest")
                        .agg(F.max_by(F.struct("keep_id", "group_size"), "batch").alias("s"))
                        .select("digest", "s.keep_id", "s.group_size"), "exact-dedup-final")
    landed = spark.read.parquet(source)
    alone = (landed.select("id", "digest").join(state.where("group_size = 1"), "digest")
             .select("id", "keep_id", "digest", "group_size"))
    hits = land(landed.join(state.where("group_size > 1"), "digest"), "exact-dedup-hits")
    return alone.unionByName(_compared(hits)).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _compared(hits: DataFrame) -> DataFrame:
    """Rows of digests seen more than once, confirmed on full bytes.

    Rows that share a digest but not the bytes of its kept row form groups by
    their full text instead.
    """
    # landed, so that the join below shuffles both sides and Spark may split a digest that is very frequent
    kept = land(hits.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest")
                .agg(F.max("text").alias("_kept_text")), "exact-dedup-kept")
    rows = land(hits.join(kept, "digest").withColumn("_same", F.col("text") == F.col("_kept_text"))
                       .withColumn("text", F.when(~F.col("_same"), F.col("text"))).drop("_kept_text"),
                       "exact-dedup-compared")
    odd = rows.where("not _same").select("id", "digest", "text")
    by_text = odd.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    apart = odd.join(by_text, ["digest", "text"]).select("id", "keep_id", "digest", "group_size")
    fewer = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("_odd"))
    same = (rows.where("_same").join(fewer, "digest", "left")
            .withColumn("group_size", F.col("group_size") - F.coalesce("_odd", F.lit(0))))
    return same.select("id", "keep_id", "digest", "group_size").unionByName(apart)
