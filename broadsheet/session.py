"""Session defaults, settings that follow the size of the input, and the one place
where lineage is cut."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job wants whatever its size.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; the caller's settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


MIB = 1024 * 1024
# Parquet bytes per shuffle partition; text unpacks to two or three times as much.
SHUFFLE_BYTES = 128 * MIB
MAX_SHUFFLE_PARTITIONS = 100_000
READ_BYTES, MAX_READ_BYTES = 128 * MIB, 1024 * MIB
# Past this many files of a write, each is larger instead, up to a bound.
WRITE_FILES, FILE_BYTES, MAX_FILE_BYTES = 2_000, 64 * MIB, 512 * MIB
# Past this many scan tasks, each reads more instead.
SCAN_TASKS = 200_000


def size_settings(input_bytes: int, shuffle_partitions: int = 200) -> dict[str, str]:
    """Partition counts for a job over `input_bytes`. Adaptive execution merges
    partitions that turn out small but cannot split one for an aggregation or a
    window, so there must be enough to begin with; and few enough that the number
    of blocks, tasks times partitions, stays within what a shuffle can serve."""
    wanted = min(math.ceil(input_bytes / SHUFFLE_BYTES), MAX_SHUFFLE_PARTITIONS)
    settings = {"spark.sql.shuffle.partitions": str(max(wanted, shuffle_partitions))}
    files = min(math.ceil(input_bytes / WRITE_FILES), MAX_FILE_BYTES)
    if files > FILE_BYTES:
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(files)
        settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    read = min(math.ceil(input_bytes / SCAN_TASKS), MAX_READ_BYTES)
    if read > READ_BYTES:
        settings["spark.sql.files.maxPartitionBytes"] = str(read)
    return settings


def size_for(spark: SparkSession, input_bytes: int) -> None:
    """Apply `size_settings`; the partition count is never lowered."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in size_settings(input_bytes, now).items():
        spark.conf.set(key, value)


def input_bytes(df: DataFrame) -> int:
    """Bytes that the optimiser expects of `df`; 0 where it does not know."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`; where it names
    none, one under the warehouse, which all executors share as well."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints/{uuid.uuid4().hex}"
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` on reliable storage, so that iterative work on it
    neither recomputes the text pipeline nor depends on an executor staying alive."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
