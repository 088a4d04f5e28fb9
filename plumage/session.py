"""Session and lineage helpers.

The library never builds its own session in library code: every operator takes
the caller's ``SparkSession``. ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "plumage", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode.

    On a cluster the folder must be the shared one named by
    ``spark.checkpoint.dir``; a machine-local temp folder would not survive the
    loss of an executor, so outside local mode a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc._jsc.sc().getCheckpointDir().get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="plumage-ckpt-")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "cut", partition_by: str | None = None) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder, read it back.

    A written table cuts the lineage like a reliable checkpoint (a lost
    executor re-reads files instead of replaying CSV parsing, text cleaning and
    feature fitting), but is columnar and compressed, so later readers prune
    columns. Column metadata (ML attributes, vector types) is kept in the
    Parquet footer. ``partition_by`` names a column of few values that readers
    filter on: they then skip the other values' files.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition ``df`` on ``keys`` only if the scan gave too few partitions.

    A single-row-group Parquet file arrives as one partition; text work on it
    would use one core. At cluster scale the scan already has thousands of
    splits and no extra shuffle is added.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    # A plan that already shuffles runs at the shuffle's parallelism; counting
    # its partitions through ``df.rdd`` would make AQE execute the shuffle stages.
    # A shuffle is a plan node at the start of a line; columns and paths may hold the word.
    if re.search(r"(?m)^[\s:+*()\d-]*Exchange \w+", df._jdf.queryExecution().executedPlan().toString()):
        return df
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 2**20) -> dict[str, str]:
    """Settings for a cluster session, sized from the input and the cluster.

    Shuffles start with about one partition per ``target_partition_bytes`` of
    input (at least two per core) and AQE coalesces them down to the
    advisory size once real sizes are known, so reducers fit in executor memory
    without hand tuning per query. Skewed partitions over 4x the median and the
    advisory size are split by AQE; file splits stay at 128 MB so a scan task's
    text fits comfortably in memory. ``spark.checkpoint.dir`` must be added by
    the caller and point at shared storage.
    """
    cores = max(1, executors * cores_per_executor)
    initial = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 * 2**20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 2**20),
        "spark.ui.enabled": "false",
    }
