"""Streams over the feed: into bronze, on to silver, through a model, into counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.operators import bronze as B
from broadsheet.operators import monitoring as M
from broadsheet.operators import predictions as P
from broadsheet.operators.scoring import request_articles, score
from broadsheet.plans.jobs import append_new_silver, write_bronze_batch, write_quarantine_batch
from broadsheet.plans.lake import Lake
from broadsheet.sources.tables import read_table, write_table

TRIGGER = "5 minutes"


def start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
    trigger: str | None,
    mode: str = "append",
) -> StreamingQuery:
    """Micro-batches every `trigger`, or, with None, all there is and then stop."""
    writer = stream.writeStream.foreachBatch(each).outputMode(mode).queryName(name)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def to_bronze(
    messages: DataFrame, lake: Lake, name: str = "feed", trigger: str | None = TRIGGER, as_of: str | None = None
) -> StreamingQuery:
    """Decode messages and land them in bronze; what is not JSON goes to quarantine.

    Batches are written by the ordinary batch writer into a folder of their own, named
    by the checkpoint's id and the batch's number. So a batch that is played again after
    a failure replaces itself, a new checkpoint replaces nothing, and batch readers and
    other writers share the table with the stream.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        writer = f"{name}-{lake.stream_id(batch.sparkSession, name)}"
        decoded = B.decode(batch).persist()
        try:
            write_bronze_batch(B.good(decoded), lake, writer, batch_id, as_of)
            write_quarantine_batch(B.quarantined(decoded), lake, writer, batch_id)
        finally:
            decoded.unpersist()

    return start(messages, each, lake.checkpoint(name), name, trigger)


def deduplicated(records: DataFrame, delay: str = "1 hour", time: str = "ingestion_timestamp") -> DataFrame:
    """Each id once within the watermark. State is dropped with it; the anti-join on
    the way to silver catches an id that returns later."""
    return records.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])


def to_silver(
    records: DataFrame, lake: Lake, name: str = "silver", trigger: str | None = TRIGGER, as_of: str | None = None
) -> StreamingQuery:
    """Keep silver up to date with a stream of bronze records. A batch that is played
    again after a failure replaces itself."""

    def each(batch: DataFrame, batch_id: int) -> None:
        writer = f"{name}-{lake.stream_id(batch.sparkSession, name)}"
        append_new_silver(batch.sparkSession, lake, batch, as_of, writer, batch_id)

    return start(records, each, lake.checkpoint(name), name, trigger)


def scored(requests: DataFrame, model: PipelineModel, as_of: str | None = None) -> DataFrame:
    """Predictions for a stream of articles, each as it arrives."""
    return score(request_articles(requests), model, "content", as_of)


def with_reuse(requests: DataFrame, predictions: DataFrame, delay: str = "10 minutes", seconds: int = P.REUSE_SECONDS) -> DataFrame:
    """Each request (id, content_hash, requested_at) with the latest prediction of its
    content (content_hash, analyzed_at, prediction, confidence) made in the `seconds` before
    it, or without one: two streams joined on their times. A request is answered once the
    watermark has passed it, so that no earlier prediction can still come; rows later than
    `delay` are left out on either side.

    State is what either stream brought within `delay` and `seconds`. As predictions are
    reused, a content has few of them in that time, however often it is asked for.
    """
    asked = requests.select("id", "content_hash", "requested_at").withWatermark("requested_at", delay)
    made = predictions.select(F.col("content_hash").alias("made_of"), "analyzed_at", "prediction", "confidence")
    made = made.withWatermark("analyzed_at", delay)
    age = F.make_dt_interval(secs=F.lit(seconds))
    within = (F.col("analyzed_at") <= F.col("requested_at")) & (F.col("analyzed_at") > F.col("requested_at") - age)
    joined = asked.join(made, (F.col("content_hash") == F.col("made_of")) & within, "leftOuter")
    latest = F.max(F.when(F.col("analyzed_at").isNotNull(), F.struct("analyzed_at", "prediction", "confidence")))
    answers = joined.groupBy("id", "content_hash", "requested_at").agg(latest.alias("latest"))
    return answers.select(
        "id", "content_hash", "requested_at", "latest.analyzed_at", "latest.prediction", "latest.confidence",
        F.col("latest").isNotNull().alias("was_reused"),
    )


def live_daily(predictions: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Running totals per day; later rows than the watermark allows are left out."""
    return M.predictions_daily(predictions.withWatermark("analyzed_at", delay))


def live_hourly(predictions: DataFrame, delay: str = "1 hour") -> DataFrame:
    return M.hourly_trend(predictions.withWatermark("analyzed_at", delay))


def live_rate(predictions: DataFrame, width: str = M.MINUTE, delay: str = "1 hour") -> DataFrame:
    return M.rate(predictions.withWatermark("analyzed_at", delay), "analyzed_at", width)


def stream_start(lake: Lake, spark: SparkSession, stream: str) -> int:
    """When a stream's checkpoint was made, in milliseconds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.checkpoint(stream)}/metadata")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(path).getModificationTime()


def to_counters(
    counters: DataFrame, lake: Lake, name: str, trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Keep the rows of a live figure that changed in each micro-batch. A batch
    played again replaces itself."""

    def each(batch: DataFrame, batch_id: int) -> None:
        # A new checkpoint counts from 0 again: its start tells which is the later.
        started = stream_start(lake, batch.sparkSession, f"counters-{name}")
        folder = f"{lake.path('counters')}/figure={name}/started={started}/batch_id={batch_id}"
        write_table(batch, folder, "overwrite", (), lake.fmt)

    return start(counters, each, lake.checkpoint(f"counters-{name}"), name, trigger, "update")


def read_counters(spark: SparkSession, lake: Lake, name: str, key: str) -> DataFrame:
    """The state of a live figure: for each window its row from the latest batch."""
    rows = read_table(spark, f"{lake.path('counters')}/figure={name}", lake.fmt)
    rest = [c for c in rows.columns if c not in (key, "started", "batch_id")]
    order = F.struct(F.col("started").cast("long"), F.col("batch_id").cast("long"))
    latest = F.max_by(F.struct(*rest), order).alias("latest")
    return rows.groupBy(key).agg(latest).select(key, "latest.*")
