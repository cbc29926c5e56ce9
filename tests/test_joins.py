"""The skew join against Spark's own join, with the hot path forced."""

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.joins import broadcast_if_few, skew_join


@pytest.fixture(scope="module")
def tables(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None))
    long = spark.range(0, 3000, numPartitions=4).select(
        "id", F.coalesce(hot, (F.col("id") % 40).cast("string")).alias("k")
    )
    long = long.withColumn("k", F.when(F.col("id") % 50 != 1, F.col("k")))
    short = spark.createDataFrame(
        [("hot", 1), *[(str(i), i) for i in range(20)], ("absent", 9)], "k STRING, v INT"
    )
    return long, short


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 50, 100_000])
def test_equals_plain_join(tables, how, hot_rows):
    long, short = tables
    got = skew_join(long, short, "k", "id", how, hot_rows=hot_rows)
    want = long.join(short, "k", how)
    assert got.columns == want.columns
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(got) == rows(want)


def test_hot_key_is_dealt_out(spark, tables):
    long, short = tables
    df = skew_join(long, short, "k", "id", hot_rows=50)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "strategy=broadcast" in plan


def test_broadcast_stops_at_its_limit(spark):
    ids, table = spark.range(10), spark.range(1000)
    hinted = lambda limit: table.join(broadcast_if_few(ids, limit), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in hinted(10) and "strategy=broadcast" not in hinted(9)
