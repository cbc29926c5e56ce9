"""Where the tables of a lake are, and how to see them from SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from broadsheet import schemas as S
from broadsheet.plans import bronze_days
from broadsheet.plans.snapshots import DATA, Snapshots
from broadsheet.sources.tables import DEFAULT_FORMAT, read_table

TABLES = (
    "bronze",
    "quarantine",
    "silver",
    "labels",
    "gold",
    "feature_statistics",
    "splits",
    "train",
    "test",
    "predictions",
    "responses",
    "importances",
    "voters",
    "counters",
    "runs",
)
SPLITS = ("train", "test")
# Tables that are replaced, appended to or compacted while others read them.
UNDER_MANIFESTS = ("silver", "gold")


@dataclass(frozen=True)
class Lake:
    """All tables are siblings under one root, none inside another. Train and test
    are the two partitions of one table, written in one go."""

    root: str
    fmt: str = DEFAULT_FORMAT

    def path(self, table: str) -> str:
        if table not in TABLES:
            raise ValueError(f"unknown table: {table}")
        if table in SPLITS:
            return f"{self.root}/splits/split={table}"
        return f"{self.root}/{table}"

    def bronze_days(self, spark: SparkSession) -> Snapshots:
        """Closed batches of bronze by day; see `bronze_days`."""
        return Snapshots(spark, f"{self.root}/bronze_days")

    def figure(self, spark: SparkSession, name: str) -> Snapshots:
        """Partial aggregates of a live figure; see `streaming.figures`."""
        return Snapshots(spark, f"{self.root}/figures/{name}")

    def quality_parts(self, spark: SparkSession, layer: str) -> Snapshots:
        """What each batch of a layer left behind; see `operators.parts`."""
        return Snapshots(spark, f"{self.root}/quality_parts/{layer}")

    def frequencies(self, spark: SparkSession) -> Snapshots:
        """Document frequencies of the batches of silver; see `operators.frequencies`."""
        return Snapshots(spark, f"{self.root}/frequencies")

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/checkpoints/{stream}"

    def stream_id(self, spark: SparkSession, stream: str) -> str:
        """Id of a stream's checkpoint, which Spark wrote into it at the first start. A
        new checkpoint counts its batches from 0 again, under another id."""
        rows = spark.read.schema("id STRING").json(f"{self.checkpoint(stream)}/metadata")
        return rows.first().id

    def model_path(self, name: str = "current") -> str:
        return f"{self.root}/models/{name}"

    def read(self, spark: SparkSession, table: str, schema=None) -> DataFrame:
        if table == "bronze" and schema is None and self.fmt == "parquet":
            days = self.bronze_days(spark)
            merged = days.current()
            if merged is not None:
                return bronze_days.read(days, self.path(table), merged)
            # Batches without a good record leave no file to take a schema from.
            return read_table(spark, self.path(table), self.fmt, S.BRONZE).select(*S.BRONZE.names)
        held = self.snapshots(spark, table)
        snapshot = held.current() if held else None
        if snapshot is not None:
            return held.read(snapshot)
        return read_table(spark, self.path(table), self.fmt, schema)

    def snapshots(self, spark: SparkSession, table: str) -> Snapshots | None:
        """The manifests of a table that has such; other formats have their own."""
        if table in UNDER_MANIFESTS and self.fmt == "parquet":
            return Snapshots(spark, self.path(table))
        return None

    def _file(self, spark: SparkSession, table: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def exists(self, spark: SparkSession, table: str) -> bool:
        held = self.snapshots(spark, table)
        if held and held.fs.exists(held.path(f"{held.root}/{DATA}")):
            return held.current() is not None
        fs, path = self._file(spark, table)
        return fs.exists(path)

    def _sizes(self, spark: SparkSession, table: str) -> list[int] | None:
        held = self.snapshots(spark, table)
        snapshot = held.current() if held else None
        return None if snapshot is None else [size for _, _, size in held.files(snapshot)]

    def size(self, spark: SparkSession, table: str) -> int:
        """Bytes of a table's files; 0 where there is none."""
        sizes = self._sizes(spark, table)
        if sizes is not None:
            return sum(sizes)
        fs, path = self._file(spark, table)
        size = fs.getContentSummary(path).getLength() if fs.exists(path) else 0
        if table == "bronze" and self.fmt == "parquet":
            days = self.bronze_days(spark)
            merged = days.current()
            size += sum(n for _, _, n in days.files(merged)) if merged else 0
        return size

    def files(self, spark: SparkSession, table: str) -> int:
        sizes = self._sizes(spark, table)
        if sizes is not None:
            return len(sizes)
        fs, path = self._file(spark, table)
        return fs.getContentSummary(path).getFileCount() if fs.exists(path) else 0

    def register_views(self, spark: SparkSession) -> list[str]:
        """Temporary views of the tables there are, for queries in SQL."""
        found = [t for t in TABLES if self.exists(spark, t)]
        for table in found:
            self.read(spark, table).createOrReplaceTempView(table)
        return found
