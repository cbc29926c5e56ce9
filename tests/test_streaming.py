import json

import pytest
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.catalog import adapters as A
from broadsheet.operators import monitoring as M
from broadsheet.operators import scoring, silver
from broadsheet.plans import jobs, training
from broadsheet.plans.lake import Lake
from broadsheet.sources.envelope import publish, to_envelope
from broadsheet.sources.feeds import landing_stream
from broadsheet.streaming import feed


def drain(df, path, mode="append"):
    """Run a stream to the end of its input and return what it wrote."""
    q = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/c")
        .trigger(availableNow=True)
        .start(f"{path}/t")
    )
    q.awaitTermination(120)
    return df.sparkSession.read.parquet(f"{path}/t")


@pytest.fixture
def topic(spark, sf_dir, tmp_path):
    """The news table as published messages, a few files, and a broken message."""
    path = str(tmp_path / "topic")
    publish(to_envelope(A.news(spark, sf_dir), A.AS_OF).repartition(4), path=path)
    (tmp_path / "topic" / "broken.json").write_text(json.dumps({"key": "k", "value": "{oops"}))
    return path


def test_topic_to_bronze_to_silver(spark, sf_dir, topic, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    messages = landing_stream(spark, topic, max_files_per_trigger=2)
    feed.to_bronze(messages, lake, trigger=None).awaitTermination(120)
    bronze = lake.read(spark, "bronze")
    assert bronze.count() == 200
    assert bronze.select("batch_id").distinct().count() > 1
    assert [r.value for r in lake.read(spark, "quarantine").collect()] == ["{oops"]
    # Nothing new: a second run adds nothing.
    feed.to_bronze(messages, lake, trigger=None).awaitTermination(120)
    assert lake.read(spark, "bronze").count() == 200

    # A batch job shares the table.
    jobs.write_bronze_batch(to_envelope(A.news(spark, sf_dir), A.AS_OF), lake, "backfill", 0)
    assert lake.read(spark, "bronze").count() == 400

    stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 3).parquet(lake.path("bronze"))
    feed.to_silver(stream, lake, trigger=None).awaitTermination(300)
    ids = {r.id for r in A.silver(spark, sf_dir).select("id").collect()}
    live = [r.id for r in lake.read(spark, "silver").select("id").collect()]
    assert len(live) == len(ids) and set(live) == ids


def test_stream_dedup_equals_batch(spark, sf_dir, topic, tmp_path):
    records = landing_stream(spark, topic).select(F.from_json("value", S.WIRE).alias("r")).select("r.*")
    once = drain(feed.deduplicated(records.filter("id IS NOT NULL")).select("id"), str(tmp_path / "out"))
    batch = silver.deduplicate(A.news(spark, sf_dir), ["doc_id"])
    assert sorted(r.id for r in once.collect()) == sorted(r.id for r in batch.select("id").collect())


def test_a_new_checkpoint_adds_to_bronze(spark, tmp_path):
    lake, topic = Lake(str(tmp_path / "lake")), tmp_path / "topic"
    topic.mkdir()
    message = lambda i: json.dumps({"key": str(i), "value": json.dumps({"id": str(i), "source_type": "rss"})})
    stream = lambda folder: landing_stream(spark, str(folder))
    (topic / "1.json").write_text("\n".join(map(message, range(5))))
    feed.to_bronze(stream(topic), lake, trigger=None).awaitTermination(120)
    (tmp_path / "lake" / "checkpoints" / "feed").rename(tmp_path / "set-aside")
    later = tmp_path / "later"
    later.mkdir()
    (later / "2.json").write_text("\n".join(map(message, range(5, 8))))
    feed.to_bronze(stream(later), lake, trigger=None).awaitTermination(120)
    assert sorted(r.id for r in lake.read(spark, "bronze").collect()) == [str(i) for i in range(8)]


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    A.predictions(spark, sf_dir).withColumn("analyzed_at", F.col("analyzed_at").cast("timestamp")).repartition(
        1
    ).write.mode("overwrite").parquet(path)
    return path


@pytest.mark.parametrize(
    "live,batch",
    [
        (feed.live_daily, M.predictions_daily),
        (feed.live_hourly, M.hourly_trend),
        (feed.live_rate, lambda df: M.rate(df, "analyzed_at", M.MINUTE)),
    ],
)
def test_live_counters_equal_batch(spark, log, tmp_path, live, batch):
    table = spark.read.parquet(log)
    stream = spark.readStream.schema(table.schema).parquet(log)
    q = (
        live(stream)
        .writeStream.format("memory")
        .queryName("live")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("live").collect())) == sorted(map(tuple, batch(table).collect()))


def test_counters_keep_the_latest_state(spark, tmp_path):
    """A day that grows in a later batch shows its newest total, and only once."""
    source, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    source.mkdir()
    schema = "id STRING, prediction STRING, analyzed_at TIMESTAMP, latency_ms DOUBLE"
    stream = spark.readStream.schema(schema).json(str(source))
    row = lambda id, at, what: json.dumps({"id": id, "prediction": what, "analyzed_at": at, "latency_ms": 1.0})

    def state():
        feed.to_counters(feed.live_daily(stream), lake, "daily", trigger=None).awaitTermination(120)
        rows = feed.read_counters(spark, lake, "daily", "day").collect()
        return {str(r.day)[:10]: (r.total, r.fake) for r in rows}

    (source / "1.json").write_text(row("a", "2024-01-01T10:00:00Z", "fake"))
    assert state() == {"2024-01-01": (1, 1)}
    (source / "2.json").write_text(
        row("b", "2024-01-01T11:00:00Z", "real") + "\n" + row("c", "2024-01-02T00:00:00Z", "real")
    )
    assert state() == {"2024-01-01": (2, 1), "2024-01-02": (1, 0)}


def test_late_rows_are_left_out(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    row = lambda id, at: json.dumps({"id": id, "prediction": "fake", "analyzed_at": at, "latency_ms": 1.0})
    (source / "1.json").write_text("\n".join([row("a", "2024-01-01T10:00:00Z"), row("b", "2024-01-03T00:00:00Z")]))
    stream = spark.readStream.schema(
        "id STRING, prediction STRING, analyzed_at TIMESTAMP, latency_ms DOUBLE"
    ).json(str(source))
    out = str(tmp_path / "out")
    drain(feed.live_daily(stream), out)
    (source / "2.json").write_text(row("late", "2024-01-01T11:00:00Z") + "\n" + row("c", "2024-01-05T00:00:00Z"))
    days = {str(r.day)[:10]: r.total for r in drain(feed.live_daily(stream), out).collect()}
    assert days["2024-01-01"] == 1


def test_stream_scoring_equals_batch(spark, sf_dir, tmp_path):
    articles = A.silver(spark, sf_dir)
    stages = training.preprocessing(spark, 16).getStages()
    classifier = training.default_classifiers(logistic={"maxIter": 3})["logistic_regression"]
    labelled = scoring.model_input(articles.filter("label IS NOT NULL"))
    model = training.Pipeline(stages=[*stages, classifier]).fit(labelled)
    requests = A.news(spark, sf_dir).select("id", "content", "title", "url", "author", "source")
    requests.write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "in"))
    live = drain(feed.scored(stream, model, A.AS_OF), str(tmp_path / "out"))
    batch = scoring.score(scoring.request_articles(requests), model, "content", A.AS_OF)
    key = lambda df: sorted((r.id, r.prediction, round(r.confidence, 9)) for r in df.collect())
    assert live.columns == list(S.PREDICTION_COLUMNS)
    assert key(live) == key(batch) and live.count() == 200
