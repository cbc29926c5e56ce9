"""Bulk scoring: a whole table or micro-batch at a time, by a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.functions import text as X
from broadsheet.functions.features import with_features
from broadsheet.operators.evaluation import label_name
from broadsheet.operators.predictions import accepted, validate_requests

COMPONENT = "predict"


def model_input(df: DataFrame, profile: str = "lake") -> DataFrame:
    """The numeric features a model needs, computed where absent; a ratio without a
    denominator counts as 0."""
    if not set(S.NUMERIC_FEATURES) <= set(df.columns):
        df = with_features(df, profile)
    return df.withColumns(
        {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in S.NUMERIC_FEATURES}
    )


def class_confidence(probability: str, prediction: str) -> Column:
    """Probability of the predicted class."""
    return F.element_at(vector_to_array(probability), (F.col(prediction) + 1).cast("int"))


def score(
    articles: DataFrame,
    model: PipelineModel,
    content: str = "content_cleaned",
    as_of: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cleaned articles to prediction rows, with further columns such as single
    features as asked. Runs on a stream as well."""
    scored = model.transform(model_input(articles))
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    if "ingestion_timestamp" in articles.columns:
        arrived = F.col("ingestion_timestamp")
        latency = (now.cast("double") - arrived.cast("double")) * 1000
    else:
        latency = F.lit(None).cast("double")
    return scored.select(
        "id",
        F.md5(content).alias("content_hash"),
        "source",
        label_name(F.col("prediction")).alias("prediction"),
        class_confidence("probability", "prediction").alias("confidence"),
        now.alias("analyzed_at"),
        X.preview(F.col(content)).alias("content_preview"),
        latency.alias("latency_ms"),
        F.lit(COMPONENT).alias("component"),
        *keep,
    )


def request_articles(requests: DataFrame) -> DataFrame:
    """Accepted requests with their text cleaned as in silver and the content's hash
    as id where they bring none."""
    valid = accepted(validate_requests(requests))
    own_id = F.col("id") if "id" in requests.columns else F.lit(None).cast("string")
    return valid.withColumns(
        {
            "id": F.coalesce(own_id, F.md5("content")),
            "content_hash": F.md5("content"),
            "title_cleaned": X.strip_tags(F.col("title")),
            "content_cleaned": X.strip_tags(F.col("content")),
        }
    )
