"""Quality figures as parts: each batch is measured once, and what it left behind merges.

Counts, sums, extremes and moments merge exactly. Distinct sources come from a sketch,
whose estimate has a standard error of `DISTINCT_ERROR`; quantiles come from another, whose
rank is off by `RANK_ERROR` at most in nearly all cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.operators import quality as Q

LOG_BUCKETS = 12
# 1.04 / sqrt(2 ** LOG_BUCKETS)
DISTINCT_ERROR = 0.0163
# Spark's default size of the quantile sketch, 200.
RANK_ERROR = 0.0133
QUANTILES = (0.25, 0.5, 0.75)


def bronze_part(bronze: DataFrame) -> DataFrame:
    """One row, of an empty batch too."""
    return bronze.agg(
        F.count("*").alias("n"), F.hll_sketch_agg("source", LOG_BUCKETS).alias("sources"),
        F.min("bronze_date").alias("min_date"), F.max("bronze_date").alias("max_date"),
    )


def silver_part(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("word_count"), F.lit(0)).cast("long").alias("words"),
        F.count("word_count").alias("counted"), F.count_if(F.col("content_cleaned").isNull()).alias("nulls"),
    )


def gold_part(gold: DataFrame, features=S.STATISTIC_FEATURES) -> DataFrame:
    """One row for each label, with the moments, extremes and quantiles of its features."""
    value = lambda name: F.col(name).cast("double")
    measured = [
        F.struct(
            F.lit(name).alias("feature"), F.count(value(name)).alias("count"), F.avg(value(name)).alias("mean"),
            (F.var_pop(value(name)) * F.count(value(name))).alias("m2"), F.min(value(name)).alias("min"),
            F.max(value(name)).alias("max"), F.kll_sketch_agg_double(value(name)).alias("quantiles"),
        ).alias(name)
        for name in features
    ]
    rows = gold.groupBy("label").agg(F.count("*").alias("n"), *measured)
    return rows.select("label", "n", F.array(*features).alias("features"))


MEASURES = {"bronze": bronze_part, "silver": silver_part, "gold": gold_part}


def bronze_figures(parts: DataFrame) -> DataFrame:
    """As `quality_bronze` has them over all rows."""
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.hll_sketch_estimate(F.hll_union_agg("sources")).alias("unique_sources"),
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"),
    )


def silver_figures(parts: DataFrame) -> DataFrame:
    """As `quality_silver` has them over all rows."""
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.try_divide(F.sum("words"), F.sum("counted")).alias("avg_word_count"),
        F.try_divide(F.sum("nulls"), F.sum("n")).alias("null_content_ratio"),
    )


def label_figures(parts: DataFrame) -> DataFrame:
    return parts.groupBy("label").agg(F.sum("n").alias("n"))


def feature_figures(parts: DataFrame) -> DataFrame:
    """As `feature_statistics` has them over all rows, and estimated quantiles beside them.
    The squares about the common mean are those about each part's own, and what the parts'
    means lie apart; so nothing cancels however far the values are from 0."""
    rows = parts.select(F.inline("features"))
    own = Window.partitionBy("feature")
    rows = rows.withColumn("all", F.sum(F.col("count") * F.col("mean")).over(own) / F.nullif(F.sum("count").over(own), F.lit(0)))
    apart = F.sum(F.col("m2") + F.col("count") * F.pow(F.col("mean") - F.col("all"), F.lit(2)))
    n = F.sum("count")
    merged = rows.groupBy("feature").agg(
        n.alias("count"), F.max("all").alias("mean"),
        F.when(n > 1, F.sqrt(apart / (n - 1))).alias("stddev"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("sketch"),
    )
    shown = F.array(*(F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in QUANTILES))
    return merged.select("feature", "count", "mean", "stddev", "min", "max", F.when(F.col("count") > 0, shown).alias("quantiles"))


def report(bronze: DataFrame | None = None, silver: DataFrame | None = None, gold: DataFrame | None = None) -> DataFrame:
    """(layer, metric, value, text) from the parts of the layers that have any: the same
    rows as `quality_report`, without a look at the layers themselves."""
    return Q.report_of(
        bronze_figures(bronze) if bronze is not None else None,
        silver_figures(silver) if silver is not None else None,
        label_figures(gold) if gold is not None else None,
    )
