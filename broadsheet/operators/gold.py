"""Gold: numeric features and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.functions.features import lake, with_features

IDENTITY = ("id", "source", "source_type", "label")


def derived_features() -> dict[str, Column]:
    return lake(F.col("content_cleaned"), F.col("title_cleaned"), F.col("author"))


def numeric_gold(silver: DataFrame, *more: str) -> DataFrame:
    """Numeric part of gold, and further columns of `silver` as asked. Counts that
    silver already holds are taken from there."""
    derived = derived_features()
    return silver.select(
        *IDENTITY,
        *[
            F.col(name) if name in silver.columns else derived[name].alias(name)
            for name in S.NUMERIC_FEATURES
        ],
        *more,
    )


def profiled(silver: DataFrame, profile: str) -> DataFrame:
    """Id and the ten features under another definition."""
    return with_features(silver, profile).select("id", *S.NUMERIC_FEATURES)


def gold_stamp(df: DataFrame, as_of: str | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn("gold_timestamp", now)


def feature_statistics(gold: DataFrame, features=S.STATISTIC_FEATURES) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per feature, one pass."""
    value = lambda name: F.col(name).cast("double")
    wide = gold.agg(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.count(value(name)).alias("count"),
                F.avg(value(name)).alias("mean"),
                F.stddev_samp(value(name)).alias("stddev"),
                F.min(value(name)).alias("min"),
                F.max(value(name)).alias("max"),
            ).alias(name)
            for name in features
        ]
    )
    return wide.select(F.inline(F.array(*features)))


def _deviations(gold: DataFrame) -> Column:
    """The sample deviation of each feature as one struct, computed once."""
    one_row = gold.agg(
        F.struct(*[F.stddev_samp(name).alias(name) for name in S.NUMERIC_FEATURES]).alias("sd")
    )
    return one_row.scalar()


def scaled_features(gold: DataFrame) -> DataFrame:
    """Features over their sample deviation, without centring; a constant feature
    becomes 0, as MLlib's StandardScaler has it."""
    with_sd = gold.withColumn("_sd", _deviations(gold))
    return with_sd.select(
        "id",
        *[
            F.coalesce(
                F.try_divide(F.coalesce(F.col(name).cast("double"), F.lit(0.0)), F.col(f"_sd.{name}")),
                F.lit(0.0),
            ).alias(name)
            for name in S.NUMERIC_FEATURES
        ],
    )
