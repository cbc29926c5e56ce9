"""The supplied test tables, seen as the records and logs this library works on.

Labels here are a quality mark used as a stand-in, not a truth about the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.functions import text as X
from broadsheet.operators import gold as G
from broadsheet.operators import silver as V
from broadsheet.sources.envelope import to_envelope
from broadsheet.sources.feeds import labelled_articles, social_posts

# One instant for everything that would otherwise read the clock.
AS_OF = "2024-02-01 00:00:00"
FIRST_DAY = "2024-01-01"
FORUM = "forum"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _first_line(c):
    return F.substring_index(c, "\n", 1)


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their labels, as bronze records. doc_id stays as tie-break."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    title = _first_line(F.col("text"))
    author = (
        F.when(F.col("doc_id") % 3 == 0, "")
        .when(F.col("doc_id") % 3 == 2, F.concat(F.lit("author_"), F.col("source")))
    )
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        X.content_hash(title, F.col("text")).alias("id"),
        "source",
        F.when(F.col("quality").isNotNull(), S.LABELLED).otherwise(S.NEWS_API).alias("source_type"),
        title.alias("title"),
        F.col("text").alias("content"),
        F.concat(F.lit("https://example.com/"), F.col("doc_id")).alias("url"),
        F.lit(None).cast("string").alias("published_date"),
        author.alias("author"),
        F.when(F.col("quality") == 1, S.REAL).when(F.col("quality") == 0, S.FAKE).alias("label"),
        F.date_format(
            F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 30).cast("int")), "yyyy-MM-dd"
        ).alias("bronze_date"),
    )


def html_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return pages.select(
        "page_id",
        X.content_hash(title, F.col("html")).alias("id"),
        F.lit("web").alias("source"),
        F.lit(S.RSS).alias("source_type"),
        title.alias("title"),
        F.col("html").alias("content"),
        "url",
    )


def social(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations through the post normaliser."""
    absent = F.lit(None).cast("string")
    posts = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        absent.alias("title"),
        "text",
        absent.alias("body"),
        absent.alias("url"),
        F.col("role").alias("author"),
        F.struct(absent.alias("username")).alias("user"),
        *[F.lit(None).cast("long").alias(c) for c in ("likes", "shares", "comments")],
        absent.alias("created_at"),
    )
    return social_posts(posts, FORUM, AS_OF)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents through the training-set normaliser."""
    rows = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            _first_line(F.col("text")).alias("title"),
            "text",
            F.when(F.col("quality") == 1, S.REAL).otherwise(S.FAKE).alias("verdict"),
        )
    )
    return labelled_articles(rows, "verdict", AS_OF)


def all_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All three kinds of source as canonical records."""
    return [
        to_envelope(news(spark, sf_dir), AS_OF),
        to_envelope(html_news(spark, sf_dir), AS_OF),
        social(spark, sf_dir),
    ]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.build_silver(news(spark, sf_dir), order=["doc_id"], as_of=AS_OF)


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ids as they stood half a month in: the state an incremental run finds."""
    earlier = news(spark, sf_dir).filter(F.col("bronze_date") <= "2024-01-15")
    return V.build_silver(earlier, order=["doc_id"], as_of=AS_OF).select("id")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.numeric_gold(silver(spark, sf_dir))


def voters(gold_rows: DataFrame) -> DataFrame:
    """Three threshold rules in place of three models, with fixed confidences."""
    rule = lambda hit: F.when(hit, 1.0).otherwise(0.0)
    sure = lambda hit, yes, no: F.when(hit, yes).otherwise(no)
    shouting = F.coalesce(F.col("caps_ratio"), F.lit(0.0)) > 0.025
    lengthy = F.coalesce(F.col("avg_word_length"), F.lit(0.0)) > 6.0
    anonymous = F.col("has_author") == 0
    return gold_rows.select(
        "id",
        "label",
        rule(shouting).alias("p1"),
        rule(lengthy).alias("p2"),
        rule(anonymous).alias("p3"),
        sure(shouting, 0.9, 0.6).alias("c1"),
        sure(lengthy, 0.8, 0.7).alias("c2"),
        sure(anonymous, 0.55, 0.95).alias("c3"),
    )


VOTERS = (("p1", "c1"), ("p2", "c2"), ("p3", "c3"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_predictions(table(spark, sf_dir, "events"))


def as_predictions(events: DataFrame) -> DataFrame:
    """events, a table or a stream, as a prediction log."""
    return events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("source"),
        F.when(F.col("event_type") == "error", S.FAKE).otherwise(S.REAL).alias("prediction"),
        F.col("ts").alias("analyzed_at"),
        F.col("value").alias("latency_ms"),
        F.col("event_type").alias("component"),
    )


# The instant at which reuse is asked for; prior predictions spread over the day.
REUSE_AS_OF = "2024-01-01 12:00:00"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("content_hash"))


def prior_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as earlier predictions, one a minute round the clock."""
    minute = (F.col("doc_id") % 1440).cast("int")
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            F.md5("text").alias("content_hash"),
            (
                F.lit(f"{FIRST_DAY} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=minute)
            ).alias("analyzed_at"),
            F.when(F.col("quality") == 1, S.REAL).otherwise(S.FAKE).alias("prediction"),
            F.lit(0.9).alias("confidence"),
        )
    )


def label_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labels, and a later pass over all of them that turns every fifth round."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    turned = F.when(F.col("doc_id") % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    return (
        labels.withColumn("version", F.lit(1)),
        labels.select("doc_id", turned.alias("quality"), F.lit(2).alias("version")),
    )
