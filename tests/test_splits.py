import hashlib
import math

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import splits as L


def labelled(spark, n=1000, parts=5):
    return spark.range(0, n, numPartitions=parts).select(
        F.md5(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 7 == 0, "fake").otherwise("real").alias("label"),
    )


def sides(df):
    return {r.id: r.split for r in df.collect()}


@pytest.mark.parametrize("split", [L.random_split, L.hash_split, L.stratified_split])
def test_disjoint_and_complete(spark, split):
    df = labelled(spark)
    out = split(df)
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    assert set(sides(out).values()) == {"train", "test"}


@pytest.mark.parametrize("split", [L.hash_split, L.stratified_split])
def test_does_not_depend_on_partitioning(spark, split):
    assert sides(split(labelled(spark))) == sides(split(labelled(spark, parts=11).orderBy("id")))


@pytest.mark.parametrize("ratio", [0.0, 0.31, 0.5, 0.8, 1.0])
def test_stratified_counts_are_exact(spark, ratio):
    rows = labelled(spark, 501).collect()
    out = sides(L.stratified_split(labelled(spark, 501), ratio))
    for label in ("fake", "real"):
        ids = sorted((r.id for r in rows if r.label == label), key=lambda i: hashlib.md5(i.encode()).hexdigest())
        quota = math.floor(ratio * len(ids))
        assert [out[i] for i in ids] == ["train"] * quota + ["test"] * (len(ids) - quota)


def test_unknown_label_raises(spark):
    df = spark.createDataFrame([("a", "maybe")], "id STRING, label STRING")
    with pytest.raises(Exception, match="unknown label: maybe"):
        L.stratified_split(df).collect()


def test_unlabelled_rows_go(spark):
    df = spark.createDataFrame([("a", "fake"), ("b", None)], "id STRING, label STRING")
    assert [r.id for r in L.labelled_only(df).collect()] == ["a"]
