"""Readers that turn landed source files into the canonical record.

Each takes the input as a DataFrame, batch or stream, so one definition serves
both; the `read_*` helpers only attach the file format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import schemas as S
from broadsheet.functions.text import content_hash, or_empty
from broadsheet.sources.envelope import CORRUPT, RAW, raw_payload, readable, to_envelope

# Children of an item that its schema does not name, each as XML.
OTHER_ELEMENTS = "xs_any"


def _json_texts(spark: SparkSession, path: str, streaming: bool, multi_line: bool) -> DataFrame:
    """JSON records as text: a line each, which lets files be split, or a file each."""
    reader = spark.readStream if streaming else spark.read
    texts = reader.format("text").option("wholetext", multi_line).load(path)
    return texts.filter(F.trim("value") != "")


def _parsed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of the JSON texts, with the text itself and, where it is none of this
    shape, the text as corrupt."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    rows = texts.select(F.col("value").alias(RAW), record.alias("record"))
    corrupt = F.when(F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull(), F.col(RAW))
    return rows.select(*(F.col(f"record.{n}").alias(n) for n in schema.names), RAW, corrupt.alias(CORRUPT))


def read_rss(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """RSS items of all files under a path or glob, with the file they came from, and
    the elements that have no column here."""
    reader = spark.readStream if streaming else spark.read
    schema = T.StructType(
        [*S.RSS_ITEM.fields, T.StructField(OTHER_ELEMENTS, T.ArrayType(T.StringType())), T.StructField(CORRUPT, T.StringType())]
    )
    return (
        reader.format("xml")
        .option("rowTag", "item")
        .option("wildcardColName", OTHER_ELEMENTS)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .load(path)
        .withColumn("feed_file", F.col("_metadata.file_path"))
    )


def name_feeds(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """Attach the source name. `feeds` is (feed, source), feed being the file's
    name; the whole list of feeds is one join, not one job each."""
    file_name = F.element_at(F.split("feed_file", "/"), -1)
    return (
        items.withColumn("feed", file_name)
        .join(feeds, "feed", "left")
        .withColumn("source", F.coalesce("source", F.lit("unknown")))
        .drop("feed")
    )


def rss_items(items: DataFrame, as_of: str | None = None) -> DataFrame:
    """RSS has no author; an item without a summary has empty content."""
    items = readable(items)
    whole = [*S.RSS_ITEM.names, *(c for c in (OTHER_ELEMENTS,) if c in items.columns)]
    summary = or_empty(F.col("description"))
    return to_envelope(
        items.select(
            content_hash(F.col("title"), summary).alias("id"),
            "source",
            F.lit(S.RSS).alias("source_type"),
            "title",
            summary.alias("content"),
            F.col("link").alias("url"),
            or_empty(F.col("pubDate")).alias("published_date"),
            raw_payload(items, *whole).alias("raw_data"),
        ),
        as_of,
    )


def read_news_api(
    spark: SparkSession, path: str, streaming: bool = False, multi_line: bool = False
) -> DataFrame:
    """Responses, one a line; or one a file with `multi_line`, for those that were laid
    out for people."""
    texts = _json_texts(spark, path, streaming, multi_line)
    # An article as text is the article as it came, whatever fields it has.
    return _parsed(texts, T.StructType([T.StructField("articles", T.ArrayType(T.StringType()))])).drop(RAW)


def api_articles(responses: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per article of each response. The id is over title and description,
    even where the content is longer."""
    texts = readable(responses).select(F.explode("articles").alias("value"))
    articles = readable(_parsed(texts, S.NEWS_API_ARTICLE))
    return to_envelope(
        articles.select(
            content_hash(F.col("title"), F.col("description")).alias("id"),
            F.coalesce("source.name", F.lit("unknown")).alias("source"),
            F.lit(S.NEWS_API).alias("source_type"),
            "title",
            F.coalesce("content", "description", F.lit("")).alias("content"),
            "url",
            or_empty(F.col("publishedAt")).alias("published_date"),
            or_empty(F.col("author")).alias("author"),
            or_empty(F.col("urlToImage")).alias("image_url"),
            raw_payload(articles).alias("raw_data"),
        ),
        as_of,
    )


def read_social(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Posts, one a line."""
    return _parsed(_json_texts(spark, path, streaming, False), S.SOCIAL_POST)


def social_posts(posts: DataFrame, platform: str, as_of: str | None = None) -> DataFrame:
    """Posts of one platform; the id is the platform with the post's own id."""
    posts = readable(posts)
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    return to_envelope(
        posts.select(
            content_hash(F.lit(platform), F.col("id")).alias("id"),
            F.lit(platform).alias("source"),
            F.lit(S.SOCIAL).alias("source_type"),
            or_empty(F.col("title")).alias("title"),
            F.coalesce("text", "body", F.lit("")).alias("content"),
            or_empty(F.col("url")).alias("url"),
            F.coalesce("author", "user.username", F.lit("")).alias("author"),
            F.struct(count("likes"), count("shares"), count("comments")).alias("engagement"),
            or_empty(F.col("created_at")).alias("published_date"),
            raw_payload(posts).alias("raw_data"),
        ),
        as_of,
    )


def read_labelled_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with quoted commas and quotes. Every column is a string.

    With `multi_line` fields may hold line breaks; such files cannot be split, so give
    a large set as many files.
    """
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("inferSchema", False)
        .csv(path)
    )


def labelled_articles(
    rows: DataFrame, label_column: str = "label", as_of: str | None = None
) -> DataFrame:
    """Labelled training rows; the content is `text`, else `content`."""
    column = lambda name: F.col(name) if name in rows.columns else F.lit(None).cast("string")
    return to_envelope(
        rows.select(
            content_hash(column("title"), column("text")).alias("id"),
            F.lit(S.TRAINING_SOURCE).alias("source"),
            F.lit(S.LABELLED).alias("source_type"),
            or_empty(column("title")).alias("title"),
            F.coalesce(column("text"), column("content"), F.lit("")).alias("content"),
            F.col(label_column).alias("label"),
            raw_payload(rows).alias("raw_data"),
        ),
        as_of,
    )


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The feed topic as a stream; needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )


def landing_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same (key, value) interface over a folder of published JSON messages."""
    reader = spark.readStream.schema("key STRING, value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)
