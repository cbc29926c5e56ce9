import pytest
from pyspark.sql import functions as F

from broadsheet.operators import monitoring as M
from broadsheet.operators import predictions as P
from broadsheet.operators import quality as Q

SCHEMA = "id STRING, prediction STRING, at STRING, latency_ms DOUBLE, component STRING"


def log(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA).withColumn("analyzed_at", F.col("at").cast("timestamp")).drop("at")


def test_daily(spark):
    df = log(
        spark,
        *[(str(i), "fake", f"2024-01-01 {i % 24:02d}:30:00", 10.0, "a") for i in range(50)],
        ("x", "real", "2024-01-03 00:00:00", None, "a"),
    )
    days = {str(r.day)[:10]: r for r in M.predictions_daily(df).collect()}
    assert set(days) == {"2024-01-01", "2024-01-03"}
    full, thin = days["2024-01-01"], days["2024-01-03"]
    assert (full.total, full.fake, full.real, full.fake_pct, full.per_hour, full.avg_response_ms) == (50, 50, 0, 100.0, 2, 10.0)
    assert (thin.fake_pct, thin.per_hour, thin.avg_response_ms) == (0.0, 0, None)


def test_no_predictions(spark):
    empty = log(spark).limit(0)
    assert M.predictions_daily(empty).count() == 0 and M.recent_predictions(empty).count() == 0


def test_recent_ties_by_id(spark):
    df = log(spark, *[(f"{i:02d}", "real", "2024-01-01 00:00:00", 1.0, "a") for i in range(15)])
    assert [r.id for r in M.recent_predictions(df).collect()] == [f"{i:02d}" for i in range(14, 4, -1)]


def test_sliding_equals_counting_every_window(spark):
    df = log(spark, *[(str(i), "real", f"2024-01-01 00:{i:02d}:05", 1.0, "a") for i in range(0, 60, 7)])
    direct = df.groupBy(F.window("analyzed_at", "1 hour", "10 minutes")).count().select(
        F.col("window.start").alias("window_start"), F.col("count").alias("n")
    )
    assert sorted(map(tuple, M.sliding_rate(df, "analyzed_at").collect())) == sorted(map(tuple, direct.collect()))


def test_quality_of_an_empty_layer(spark):
    empty = spark.createDataFrame([], "word_count INT, content_cleaned STRING")
    r = Q.quality_silver(empty).first()
    assert r.total_records == 0 and r.avg_word_count is None and r.null_content_ratio is None


def test_report_leaves_out_absent_layers(spark):
    gold = spark.createDataFrame([("fake",), (None,)], "label STRING")
    rows = {(r.layer, r.metric): r.value for r in Q.quality_report(gold=gold).collect()}
    assert rows == {("gold", "total_records"): 2, ("gold", "label_fake"): 1, ("gold", "label_none"): 1}
    bare = {(r.layer, r.metric): r.value for r in Q.quality_report(gold=gold.drop("label")).collect()}
    assert bare == {("gold", "total_records"): 2}
    with pytest.raises(ValueError):
        Q.quality_report()


def test_requests(spark):
    df = spark.createDataFrame(
        [("text", None, None, None, None), (None, "t", "u", "a", "s")],
        "content STRING, title STRING, url STRING, author STRING, source STRING",
    )
    checked = P.validate_requests(df)
    ok = P.accepted(checked).first()
    assert (ok.title, ok.url, ok.author, ok.source) == ("", "", "", "api")
    bad = P.rejected(checked).first()
    assert bad.title == "t" and "content" in bad.error


def test_reuse_with_hot_content_and_expiry(spark):
    articles = spark.range(0, 300).select(
        F.col("id").cast("string"), F.when(F.col("id") < 200, "hot").otherwise(F.col("id").cast("string")).alias("content_hash")
    )
    prior = spark.createDataFrame(
        [("hot", "2024-01-01 11:30:00", "real", 0.5), ("hot", "2024-01-01 11:50:00", "fake", 0.9),
         ("250", "2024-01-01 10:59:59", "real", 0.5), ("251", "2024-01-01 11:00:00", "real", 0.5),
         ("252", "2024-01-01 12:00:00", "real", 0.5), ("253", "2024-01-01 12:00:01", "real", 0.5)],
        "content_hash STRING, at STRING, prediction STRING, confidence DOUBLE",
    ).withColumn("analyzed_at", F.col("at").cast("timestamp"))
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    again = P.reused(articles, prior, now).collect()
    assert len(again) == 201
    assert {r.prediction for r in again if r.content_hash == "hot"} == {"fake"}
    todo = {r.id for r in P.unscored(articles, prior, now).collect()}
    assert todo == {str(i) for i in range(200, 300)} - {"252"}


def test_each_content_is_scored_once(spark):
    articles = spark.createDataFrame(
        [("1", "a"), ("2", "a"), ("3", "b"), ("4", "c")], "id STRING, content_hash STRING"
    )
    prior = spark.createDataFrame(
        [("b", "2024-01-01 11:30:00"), ("c", "2024-01-01 09:00:00")], "content_hash STRING, at STRING"
    ).withColumn("analyzed_at", F.col("at").cast("timestamp"))
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert {r.id for r in P.unscored_contents(articles, prior, now).collect()} == {"1", "4"}
    assert {r.id for r in P.unscored_contents(articles, None, now).collect()} == {"1", "3", "4"}


def test_latest_label_wins(spark):
    schema = "doc_id INT, quality INT, version INT"
    old = spark.createDataFrame([(1, 0, 1), (2, 1, 1)], schema)
    new = spark.createDataFrame([(1, 1, 2)], schema)
    assert {r.doc_id: r.quality for r in P.latest_labels(new, old).collect()} == {1: 1, 2: 1}
