"""Figures over the prediction log. All are window aggregates with a map-side
combine, so a busy hour or source is no hot spot; they run on batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import schemas as S

DAY, HOUR, MINUTE = "1 day", "1 hour", "1 minute"


def _said(label: str) -> Column:
    return F.count_if(F.col("prediction") == label)


def predictions_daily(predictions: DataFrame) -> DataFrame:
    counted = predictions.groupBy(F.window("analyzed_at", DAY)).agg(
        F.count("*").alias("total"),
        _said(S.FAKE).alias("fake"),
        _said(S.REAL).alias("real"),
        F.avg("latency_ms").alias("avg_response_ms"),
    )
    return daily_figures(counted.select(F.col("window.start").alias("day"), "total", "fake", "real", "avg_response_ms"))


def daily_figures(counted: DataFrame) -> DataFrame:
    """The shares and hourly rates that follow from the counts of a day."""
    return counted.select(
        "day",
        "total",
        "fake",
        "real",
        F.coalesce(F.try_divide("fake", "total") * 100, F.lit(0.0)).alias("fake_pct"),
        F.floor(F.col("total") / 24).alias("per_hour"),
        F.floor(F.col("fake") / 24).alias("fake_per_hour"),
        "avg_response_ms",
    )


def hourly_trend(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(F.window("analyzed_at", HOUR))
        .agg(_said(S.FAKE).alias("fake"), _said(S.REAL).alias("real"))
        .select(F.col("window.start").alias("hour"), "fake", "real")
    )


def recent_predictions(predictions: DataFrame, k: int = 10) -> DataFrame:
    """The latest k: every task keeps its own k, then those are merged."""
    return predictions.orderBy(F.col("analyzed_at").desc(), F.col("id").desc()).limit(k)


def latency_by_component(predictions: DataFrame, width: str = MINUTE) -> DataFrame:
    return (
        predictions.groupBy(F.window("analyzed_at", width), "component")
        .agg(F.avg("latency_ms").alias("avg_latency_ms"))
        .select(F.col("window.start").alias("minute"), "component", "avg_latency_ms")
    )


def rate(df: DataFrame, time: str, width: str) -> DataFrame:
    """Rows per tumbling window."""
    return (
        df.groupBy(F.window(time, width))
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), "n")
    )


def sliding_rate(df: DataFrame, time: str, width: str = HOUR, step: str = "10 minutes") -> DataFrame:
    """Rows per sliding window. Rows are counted per step first, so that only the
    counts, not the rows, are copied into each window that covers them. The width
    must be a multiple of the step."""
    return (
        rate(df, time, step)
        .groupBy(F.window("window_start", width, step))
        .agg(F.sum("n").alias("n"))
        .select(F.col("window.start").alias("window_start"), "n")
    )


def ingest_throughput(arrivals: DataFrame, time: str = "ingestion_timestamp") -> DataFrame:
    return rate(arrivals, time, MINUTE).withColumnRenamed("window_start", "minute")
