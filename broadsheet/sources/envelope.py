"""What every source shares: the canonical record, fan-in, publishing, counting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import schemas as S


def ingestion_time(as_of: str | None = None) -> Column:
    """Now, or a given instant for reproducible runs."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


# Where a reader keeps the text of the record, and the text of one it cannot read.
RAW, CORRUPT = "_raw", "_corrupt"


def raw_payload(df: DataFrame, *columns: str) -> Column:
    """The input record as it came, where its reader kept it; else its columns as JSON,
    before any is defaulted or renamed."""
    if RAW in df.columns:
        return F.col(RAW)
    return F.to_json(F.struct(*(columns or (c for c in df.columns if c != CORRUPT))))


def readable(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df


def broken(df: DataFrame) -> DataFrame:
    """The text of records that their reader could not read, for the quarantine."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def to_envelope(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Bring a source's columns into the canonical order; absent ones are null."""
    present = set(df.columns)
    columns = {
        f.name: (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType)
        for f in S.ENVELOPE.fields
    }
    if "ingestion_timestamp" not in present:
        columns["ingestion_timestamp"] = ingestion_time(as_of)
    return df.select(*[c.alias(name) for name, c in columns.items()])


def union_sources(*feeds: DataFrame) -> DataFrame:
    """All sources as one feed. Duplicates stay; silver removes them by id."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def keyed_messages(feed: DataFrame) -> DataFrame:
    """(key, value) pairs for the feed topic: the id and the record as JSON."""
    return feed.select(F.col("id").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish(feed: DataFrame, fmt: str = "json", path: str | None = None, **options: str) -> None:
    """Append the messages to a topic (fmt='kafka', where that connector is
    installed) or to a landing folder."""
    writer = keyed_messages(feed).write.format(fmt).mode("append").options(**options)
    writer.save(path) if path else writer.save()


def ingest_counts(feed: DataFrame) -> DataFrame:
    return feed.groupBy("source", "source_type").agg(F.count("*").alias("n"))
