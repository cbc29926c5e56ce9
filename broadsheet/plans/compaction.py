"""Replace a table's many small files by fewer of a good size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import SparkSession

from broadsheet.sources.tables import DEFAULT_FORMAT, read_table, write_table

TARGET_BYTES = 256 * 1024 * 1024


def compact(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    target_bytes: int = TARGET_BYTES,
) -> tuple[int, int]:
    """Rewrite the table at `path` beside itself, then swap the two folders. The
    previous files stay under `<path>__before` until the next run. Rows do not
    change. Returns the number of files before and after.

    An unpartitioned table is only coalesced: neighbouring files are read into one
    task and nothing is shuffled. A partitioned one is rebalanced on its partition
    columns, where adaptive execution splits a partition value larger than others
    into several files. Run it while nothing writes to the table.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path
    source, staged, previous = hpath(path), hpath(f"{path}__compacting"), hpath(f"{path}__before")
    fs = source.getFileSystem(conf)
    size = fs.getContentSummary(source)
    files = max(1, math.ceil(size.getLength() / target_bytes))

    table = read_table(spark, path, fmt)
    if partition_by:
        even = table.hint("rebalance", *partition_by)
    else:
        even = table.coalesce(files)
    write_table(even, str(staged), "overwrite", partition_by, fmt)

    rows, kept = table.count(), read_table(spark, str(staged), fmt).count()
    if rows != kept:
        raise RuntimeError(f"compaction of {path} read {rows} rows but wrote {kept}")
    after = fs.getContentSummary(staged).getFileCount()
    fs.delete(previous, True)
    if not (fs.rename(source, previous) and fs.rename(staged, source)):
        raise RuntimeError(f"could not swap {path}; its rows are in {previous} or {staged}")
    spark.catalog.refreshByPath(path)
    return size.getFileCount(), after
