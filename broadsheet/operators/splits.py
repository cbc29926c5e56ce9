"""Train and test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import schemas as S

TRAIN, TEST = "train", "test"
# Leading hex digits of the hash that make a bucket: 16**4 buckets per label.
BUCKET_DIGITS = 4


def labelled_only(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("label").isNotNull())


def random_split(df: DataFrame, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Spark's own random split as one table with a `split` column. The draw depends
    on how the input is partitioned; `hash_split` does not."""
    train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    return train.withColumn("split", F.lit(TRAIN)).unionByName(test.withColumn("split", F.lit(TEST)))


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A number below `buckets` fixed for ever by the key."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % buckets


def hash_split(df: DataFrame, train_ratio: float = 0.8, key: str = "id") -> DataFrame:
    """Split by the hash of the id: a map over the rows, with no shuffle, and a row
    never changes sides between runs."""
    inside = hash_bucket(F.col(key)) < round(train_ratio * 100)
    return df.withColumn("split", F.when(inside, TRAIN).otherwise(TEST))


def _cutoffs(keyed: DataFrame, train_ratio: float) -> Column:
    """Map label -> the largest hash that still belongs to train.

    A rank over each label would put a label's rows on one task. Instead rows are
    counted per (label, bucket of hashes); a running sum over those few counts
    finds the bucket in which the quota falls, and only that bucket is ranked.
    """
    counts = keyed.groupBy("label", "_bucket").agg(F.count("*").alias("n"))
    by_label = Window.partitionBy("label")
    before = by_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.floor(F.lit(float(train_ratio)) * F.sum("n").over(by_label))
    boundary = (
        counts.withColumns(
            {"_quota": quota, "_before": F.coalesce(F.sum("n").over(before), F.lit(0))}
        )
        .filter((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_before") + F.col("n")))
        .select("label", "_bucket", (F.col("_quota") - F.col("_before")).alias("_left"))
    )
    # At most one row per label of the fixed label set.
    ranked = keyed.join(F.broadcast(boundary), ["label", "_bucket"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("label", "_bucket").orderBy("_hash"))
    )
    last = ranked.filter(F.col("_rank") == F.col("_left"))
    return last.agg(F.map_from_entries(F.collect_list(F.struct("label", "_hash")))).scalar()


def stratified_split(df: DataFrame, train_ratio: float = 0.8, key: str = "id") -> DataFrame:
    """Exactly floor(ratio * n) train rows in every label, chosen by the id's hash.
    Ids must be unique. A label outside the fixed set raises."""
    digest = F.concat(F.md5(F.col(key)), F.col(key))
    known = F.col("label").isin(*S.LABELS)
    keyed = df.select(
        F.when(known, F.col("label"))
        .otherwise(F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce("label", F.lit("null")))))
        .alias("label"),
        digest.alias("_hash"),
        F.substring(digest, 1, BUCKET_DIGITS).alias("_bucket"),
    )
    cut = F.element_at(_cutoffs(keyed, train_ratio), F.col("label"))
    return df.withColumn("split", F.when(digest <= cut, TRAIN).otherwise(TEST))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split", "label").agg(F.count("*").alias("n"))
