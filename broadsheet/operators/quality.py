"""Data-quality figures per layer, each from a single pass over its table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_bronze(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("source").alias("unique_sources"),
        F.min("bronze_date").alias("min_date"),
        F.max("bronze_date").alias("max_date"),
    )


def quality_silver(silver: DataFrame) -> DataFrame:
    """On an empty table the average and the ratio are null."""
    return silver.agg(
        F.count("*").alias("total_records"),
        F.avg("word_count").alias("avg_word_count"),
        F.try_divide(F.count_if(F.col("content_cleaned").isNull()), F.count("*")).alias(
            "null_content_ratio"
        ),
    )


def label_distribution(gold: DataFrame) -> DataFrame:
    return gold.groupBy("label").agg(F.count("*").alias("n"))


def source_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy("source").agg(F.count("*").alias("n"))


def _long(wide: DataFrame, layer: str) -> DataFrame:
    """One row per figure; numbers and texts keep to their own column."""

    def row(name: str, dtype: str) -> Column:
        text = dtype == "string"
        return F.struct(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("metric"),
            (F.lit(None) if text else F.col(name)).cast("double").alias("value"),
            (F.col(name) if text else F.lit(None)).cast("string").alias("text"),
        )

    return wide.select(F.inline(F.array(*[row(n, t) for n, t in wide.dtypes])))


def quality_report(
    bronze: DataFrame | None = None,
    silver: DataFrame | None = None,
    gold: DataFrame | None = None,
) -> DataFrame:
    """(layer, metric, value, text) over the layers that exist. The label counts of
    gold come in only if it has labels."""
    counts = lambda df: df.agg(F.count("*").alias("total_records"))
    labelled = gold is not None and "label" in gold.columns
    return report_of(
        quality_bronze(bronze) if bronze is not None else None,
        quality_silver(silver) if silver is not None else None,
        label_distribution(gold) if labelled else None,
        counts(gold) if gold is not None else None,
    )


def report_of(
    bronze: DataFrame | None, silver: DataFrame | None, labels: DataFrame | None, gold: DataFrame | None = None
) -> DataFrame:
    """The report from the figures of each layer; the records of gold are the sum over its
    labels where they are not given."""
    parts = []
    if bronze is not None:
        parts.append(_long(bronze, "bronze"))
    if silver is not None:
        parts.append(_long(silver, "silver"))
    if gold is None and labels is not None:
        gold = labels.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"))
    if gold is not None:
        parts.append(_long(gold, "gold"))
    if labels is not None:
        parts.append(
            labels.select(
                F.lit("gold").alias("layer"),
                F.concat(F.lit("label_"), F.coalesce("label", F.lit("none"))).alias("metric"),
                F.col("n").cast("double").alias("value"),
                F.lit(None).cast("string").alias("text"),
            )
        )
    if not parts:
        raise ValueError("a quality report needs at least one layer")
    return reduce(DataFrame.unionByName, parts)


def layer_flow(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Records passing from each stage to the next."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    edge = lambda a, b, n: F.struct(
        F.lit(a).alias("stage_from"), F.lit(b).alias("stage_to"), F.col(n).alias("records")
    )
    into_bronze = count(bronze, "n").select(F.inline(F.array(edge("Ingestion", "Bronze", "n"))))
    into_silver = count(silver, "n").select(F.inline(F.array(edge("Bronze", "Silver", "n"))))
    from_gold = count(gold, "n").select(
        F.inline(F.array(edge("Silver", "Gold", "n"), edge("Gold", "Model", "n")))
    )
    return into_bronze.unionByName(into_silver).unionByName(from_gold)
