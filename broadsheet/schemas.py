"""Column contracts shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Record field names, source types and labels on the wire.
RSS = "rss"
NEWS_API = "news_api"
SOCIAL = "social_media"
LABELLED = "labeled_data"
TRAINING_SOURCE = "training_dataset"
REAL, FAKE = "real", "fake"
# Label index follows the position here: real = 0, fake = 1.
LABELS = (REAL, FAKE)

NUMERIC_FEATURES = (
    "word_count",
    "char_count",
    "has_author",
    "title_length",
    "exclamation_count",
    "question_count",
    "caps_ratio",
    "avg_word_length",
    "numeric_count",
    "url_count",
)
# has_author is a flag, so the feature statistics leave it out.
STATISTIC_FEATURES = tuple(f for f in NUMERIC_FEATURES if f != "has_author")

ENGAGEMENT = T.StructType(
    [
        T.StructField("likes", T.LongType()),
        T.StructField("shares", T.LongType()),
        T.StructField("comments", T.LongType()),
    ]
)

# One canonical record for all sources; a source leaves the fields it lacks null.
ENVELOPE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("published_date", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("engagement", ENGAGEMENT),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("raw_data", T.StringType()),
    ]
)

# JSON value of the feed topic. Older producers send only the string fields;
# the rest then decode to null.
WIRE = T.StructType(list(ENVELOPE.fields))

# Bronze as it is read, its partitions among the columns.
BRONZE = T.StructType(
    [
        *ENVELOPE.fields,
        T.StructField("bronze_timestamp", T.TimestampType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("bronze_date", T.StringType()),
    ]
)

RSS_ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("pubDate", T.StringType()),
    ]
)

NEWS_API_ARTICLE = T.StructType(
    [
        T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("urlToImage", T.StringType()),
    ]
)

SOCIAL_POST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("username", T.StringType())])),
        T.StructField("likes", T.LongType()),
        T.StructField("shares", T.LongType()),
        T.StructField("comments", T.LongType()),
        T.StructField("created_at", T.StringType()),
    ]
)

SILVER_COLUMNS = (
    "id",
    "source",
    "source_type",
    "title_cleaned",
    "content_cleaned",
    "url",
    "published_date",
    "author",
    "word_count",
    "char_count",
    "has_author",
    "label",
    "silver_timestamp",
)

GOLD_COLUMNS = (
    "id",
    "source",
    "source_type",
    "label",
    *NUMERIC_FEATURES,
    "tfidf_features",
    "gold_timestamp",
)

PREDICTION_COLUMNS = (
    "id",
    "content_hash",
    "source",
    "prediction",
    "confidence",
    "analyzed_at",
    "content_preview",
    "latency_ms",
    "component",
)
