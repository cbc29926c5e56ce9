"""Requests, reuse of earlier predictions, and new labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.operators.joins import skew_join
from broadsheet.operators.silver import first_per_key

# Fixed value: seconds for which a prediction may be reused.
REUSE_SECONDS = 3600
DEFAULT_SOURCE = "api"
# Fixed value: the error of a request without content.
NO_CONTENT = "Missing 'content' field"


def validate_requests(requests: DataFrame) -> DataFrame:
    """Flag requests without content and default the optional fields."""
    return requests.withColumns(
        {
            "ok": F.col("content").isNotNull(),
            "title": X.or_empty(F.col("title")),
            "url": X.or_empty(F.col("url")),
            "author": X.or_empty(F.col("author")),
            "source": F.coalesce("source", F.lit(DEFAULT_SOURCE)),
        }
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter("ok").drop("ok")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(~F.col("ok")).withColumn("error", F.lit(NO_CONTENT))


def fresh(prior: DataFrame, as_of: Column, seconds: int = REUSE_SECONDS) -> DataFrame:
    """Predictions made in the last `seconds` before `as_of`, that instant included."""
    age = F.make_dt_interval(secs=F.lit(seconds))
    made = F.col("analyzed_at")
    return prior.filter((made > as_of - age) & (made <= as_of))


def unscored(articles: DataFrame, prior: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """Articles whose content has no fresh prediction. Many articles may share one
    content, so their rows are spread by `key`."""
    known = fresh(prior, as_of).select("content_hash").distinct()
    return skew_join(articles, known, "content_hash", spread=key, how="left_anti")


def unscored_contents(articles: DataFrame, prior: DataFrame | None, as_of: Column) -> DataFrame:
    """One article for each distinct content without a fresh prediction. Copies go
    inside the map tasks, so the join sees each content once and has no hot key."""
    once = first_per_key(articles, ["content_hash"], ["id"])
    if prior is None:
        return once
    return once.join(fresh(prior, as_of).select("content_hash"), "content_hash", "left_anti")


def reused(articles: DataFrame, prior: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """Articles with a fresh prediction, and the latest such prediction. Predictions
    are first reduced to one per content, so the join never multiplies rows."""
    latest = (
        fresh(prior, as_of)
        .groupBy("content_hash")
        .agg(F.max(F.struct("analyzed_at", "prediction", "confidence")).alias("_latest"))
        .select("content_hash", "_latest.*")
    )
    return skew_join(articles, latest, "content_hash", spread=key)


def answers(
    articles: DataFrame, scored: DataFrame, prior: DataFrame | None, as_of: Column, key: str = "id"
) -> DataFrame:
    """One row for each article: the new prediction of its content, else the latest
    fresh one. Many articles may share one content, so their rows are spread by `key`."""
    made = F.struct("analyzed_at", "prediction", "confidence")
    one = lambda df, again: (
        df.groupBy("content_hash").agg(F.max(made).alias("_made")).select(
            "content_hash", "_made.*", F.lit(again).alias("was_reused")
        )
    )
    found = one(scored, False)
    if prior is not None:
        old = fresh(prior, as_of).join(scored.select("content_hash"), "content_hash", "left_anti")
        found = found.unionByName(one(old, True))
    return skew_join(articles.select(key, "content_hash"), found, "content_hash", spread=key)


def latest_labels(*batches: DataFrame, key: str = "doc_id", value: str = "quality") -> DataFrame:
    """One label per key, that of the highest version. `max_by` combines in the map
    tasks, so a key with many corrections costs one row per task."""
    union = batches[0]
    for batch in batches[1:]:
        union = union.unionByName(batch)
    return union.groupBy(key).agg(F.max_by(value, "version").alias(value))


def with_labels(articles: DataFrame, latest: DataFrame) -> DataFrame:
    """Articles under the labels of (id, label), one per id; those without one keep
    what they had."""
    joined = articles.join(latest.withColumnRenamed("label", "_label"), "id", "left")
    return joined.withColumn("label", F.coalesce("_label", "label")).drop("_label")
