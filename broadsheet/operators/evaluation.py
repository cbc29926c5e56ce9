"""Metrics over labelled predictions, and voting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import schemas as S

SCORE_BUCKETS = 256


def label_index(label: Column) -> Column:
    """real = 0, fake = 1; anything else raises rather than becoming a third class."""
    indexed = F.when(label == S.LABELS[0], 0.0).when(label == S.LABELS[1], 1.0)
    return indexed.otherwise(
        F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(label, F.lit("null"))))
    )


def label_name(index: Column) -> Column:
    return F.when(index == 1, S.FAKE).otherwise(S.REAL)


def confusion_matrix(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def classification_metrics(predicted: DataFrame, positive: str = S.FAKE) -> DataFrame:
    """Accuracy, precision, recall and F1 from one pass; a rate without cases is null."""
    is_positive = F.col("label") == positive
    said_positive = F.col("prediction") == positive
    hits = F.count_if(F.col("label") == F.col("prediction"))
    tp = F.count_if(is_positive & said_positive)
    fp = F.count_if(~is_positive & said_positive)
    fn = F.count_if(is_positive & ~said_positive)
    return predicted.agg(
        F.try_divide(hits, F.count("*")).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def accuracy(predicted: DataFrame, label: str, prediction: str) -> DataFrame:
    return predicted.agg(
        F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)).alias("accuracy")
    )


def auc_by_rank(scored: DataFrame, buckets: int = SCORE_BUCKETS) -> DataFrame:
    """Exact area under the ROC curve of (score, positive), ties counting a half.

    Each positive beats the negatives below it. Rows collapse to one per distinct
    score; those are cut at quantiles into buckets that are worked on side by side,
    and the few bucket totals settle the comparisons between buckets. Any cut
    points give the exact result, so approximate quantiles serve.
    """
    by_score = scored.groupBy("score").agg(
        F.count_if(F.col("positive")).alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )
    steps = [i / buckets for i in range(1, buckets)]
    cuts = by_score.agg(F.percentile_approx("score", steps, 1000)).scalar()
    bucketed = by_score.withColumn("_cuts", cuts).withColumn(
        "bucket", F.size(F.filter("_cuts", lambda c: c < F.col("score")))
    )
    below = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = below(Window.partitionBy("bucket").orderBy("score"))
    wins = F.col("pos") * (F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("neg") / 2)
    totals = (
        bucketed.withColumn("wins", wins)
        .groupBy("bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("wins").alias("wins"))
    )
    # At most `buckets` rows from here on.
    across = below(Window.partitionBy(F.lit(0)).orderBy("bucket"))
    lower = F.coalesce(F.sum("neg").over(across), F.lit(0))
    return totals.withColumn("wins", F.col("wins") + F.col("pos") * lower).agg(
        F.try_divide(F.sum("wins"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc")
    )


def majority_vote(df: DataFrame, voters: Sequence[tuple[str, str]]) -> DataFrame:
    """Add `vote`, the rounded mean of the voters' class indices, and `confidence`,
    the mean of their confidences. `voters` are (prediction, confidence) columns of
    the same row, so nothing is collected, joined or matched by position."""
    mean = lambda columns: sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)
    return df.withColumns(
        {
            "vote": F.rint(mean([p for p, _ in voters])),
            "confidence": mean([c for _, c in voters]),
        }
    )
