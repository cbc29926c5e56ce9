"""Reading and writing the lake's tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Parquet is always there; 'delta' works where its connector is installed.
DEFAULT_FORMAT = "parquet"


def read_table(
    spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, schema=None
) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    replace_partitions: bool = False,
) -> None:
    """Write a table. With `replace_partitions` only the partitions present in `df`
    are replaced, so that a re-run of the same unit of work changes nothing."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even out the files about to be written: adaptive execution merges small
    partitions and splits large ones, hot partition values included."""
    return df.hint("rebalance", *columns)
