import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import silver as V
from broadsheet.plans.compaction import compact
from conftest import formatted_plan

SCHEMA = (
    "id STRING, source STRING, source_type STRING, title STRING, content STRING, url STRING, "
    "published_date STRING, author STRING, label STRING, ingestion_timestamp TIMESTAMP"
)


def record(id, content, at="2024-01-01 00:00:00", label=None, title="t", source="s"):
    return (id, source, "rss", title, content, "u", None, None, label, at)


@pytest.fixture
def frame(spark):
    def make(*rows):
        df = spark.createDataFrame(
            [tuple(r) for r in rows], SCHEMA.replace("ingestion_timestamp TIMESTAMP", "at STRING")
        )
        return df.withColumn("ingestion_timestamp", F.col("at").cast("timestamp")).drop("at")

    return make


def test_length_limit_is_on_raw_text(frame):
    rows = [record("a", None), record("b", ""), record("c", "x" * 100), record("d", "x" * 101),
            record("e", "<" + "p" * 120 + ">")]
    silver = {r.id: r for r in V.build_silver(frame(*rows)).collect()}
    assert set(silver) == {"d", "e"}
    assert silver["e"].content_cleaned == "" and silver["e"].char_count == 0 and silver["e"].word_count == 1


def test_null_title_stays_null(frame):
    assert V.build_silver(frame(record("a", "x" * 200, title=None))).first().title_cleaned is None


def test_earliest_copy_survives_whatever_the_order(frame):
    rows = [record("a", "y" * 150, f"2024-01-0{d}", label=str(d)) for d in range(1, 8)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = frame(*rows).repartition(3)
        assert [r.label for r in V.build_silver(df).collect()] == ["1"]


def test_hot_id_is_pruned_before_the_shuffle(spark):
    df = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("n"),
    )
    kept = V.deduplicate(df, ["n"])
    assert "WindowGroupLimit" in formatted_plan(kept)
    assert kept.count() == 2001 and kept.filter("id = 'hot'").first().n == 0


def test_incremental_rows(frame):
    silver = V.build_silver(frame(record("a", "x" * 150), record("b", "z" * 150)))
    assert [r.id for r in V.new_ids(silver, silver.filter("id = 'a'")).collect()] == ["b"]


@pytest.mark.parametrize("partition_by", [(), ("source",)])
def test_compaction_keeps_the_rows(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    df = spark.range(0, 500, numPartitions=20).select(
        "id", (F.col("id") % 3).cast("string").alias("source"), F.lit("x" * 50).alias("c")
    )
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    before, after = compact(spark, path, partition_by)
    assert after < before
    back = spark.read.parquet(path).select("id", F.col("source").cast("string"), "c")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    compact(spark, path, partition_by)
    assert spark.read.parquet(path).count() == 500
