"""Live figures from partial aggregates: equal to the batch figure whatever comes late, is
played again, or is folded."""

import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import monitoring as M
from broadsheet.plans.lake import Lake
from broadsheet.plans.snapshots import Snapshots
from broadsheet.streaming import feed, figures

SCHEMA = "id STRING, prediction STRING, analyzed_at TIMESTAMP, latency_ms DOUBLE"
DAILY = figures.FIGURES["daily"]


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def rows(spark, *made):
    """Rows of (day, hour, prediction, latency)."""
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    df = spark.createDataFrame([(str(n), p, t) for n, (_, _, p, t) in enumerate(made)], "id STRING, prediction STRING, latency_ms DOUBLE")
    times = spark.createDataFrame([(str(n), at(d, h)) for n, (d, h, _, _) in enumerate(made)], "id STRING, analyzed_at TIMESTAMP")
    return df.join(times, "id").select("id", "prediction", "analyzed_at", "latency_ms")


def state(spark, lake):
    return {r.day.day: (r.total, r.fake, r.avg_response_ms) for r in figures.read_figure(spark, lake, "daily").collect()}


def late(spark, lake):
    return {r.window_start.day: r.total for r in figures.read_corrections(spark, lake, "daily").collect()}


def test_late_rows_are_counted_and_told_apart(spark, lake):
    table = lake.figure(spark, "daily")
    add = lambda batch, *made: figures.add_batch(table, DAILY, rows(spark, *made), "s", batch)
    add(0, (1, 10, "fake", 2.0), (3, 5, "real", None))
    assert state(spark, lake) == {1: (1, 1, 2.0), 3: (1, 0, None)} and late(spark, lake) == {}
    # The first day closed when the third had begun; the third is open.
    add(1, (1, 11, "real", 4.0), (3, 6, "fake", 6.0), (5, 0, "real", 1.0))
    assert state(spark, lake) == {1: (2, 1, 3.0), 3: (2, 1, 6.0), 5: (1, 0, 1.0)} and late(spark, lake) == {1: 1}
    add(2, (1, 1, "fake", None))
    assert state(spark, lake)[1] == (3, 2, 3.0) and late(spark, lake) == {1: 2}


def test_a_batch_played_again_replaces_itself(spark, lake):
    table = lake.figure(spark, "daily")
    add = lambda batch, *made: figures.add_batch(table, DAILY, rows(spark, *made), "s", batch)
    add(0, (4, 1, "real", 1.0))
    for _ in range(2):
        add(1, (1, 1, "fake", 1.0), (9, 1, "fake", 1.0))
    # Its own rows of the ninth day close nothing for it.
    assert state(spark, lake) == {4: (1, 0, 1.0), 1: (1, 1, 1.0), 9: (1, 1, 1.0)} and late(spark, lake) == {1: 1}
    add(1, (9, 2, "real", 1.0))
    assert state(spark, lake) == {4: (1, 0, 1.0), 9: (1, 0, 1.0)} and late(spark, lake) == {}


def test_files_stay_few(spark, lake):
    table, counts = lake.figure(spark, "daily"), []
    for batch in range(30):
        figures.add_batch(table, DAILY, rows(spark, (1 + batch % 9, 1, "fake", 1.0), (1, 2, "real", 3.0)), "s", batch)
        counts.append(figures.fold(table, DAILY, fan=3))
    # Below three units of each generation, and the latest batch, for each of the two parts.
    assert max(counts) <= 2 * (2 * 4 + 1) and counts[-1] < 20
    got = state(spark, lake)
    assert sum(n for n, _, _ in got.values()) == 60 and got[1][:2] == (4 + 30, 4) and got[2] == (4, 4, 1.0)
    before = got
    table.vacuum(keep_seconds=-10)
    assert state(spark, lake) == before
    with pytest.raises(ValueError, match="was merged"):
        figures.add_batch(table, DAILY, rows(spark, (1, 1, "fake", 1.0)), "s", 0)


def test_a_fold_that_stops_changes_nothing(spark, lake, monkeypatch):
    table = lake.figure(spark, "daily")
    for batch in range(4):
        figures.add_batch(table, DAILY, rows(spark, (1, 1, "fake", 1.0)), "s", batch)

    def lost(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "publish", lost)
        with pytest.raises(OSError):
            figures.fold(table, DAILY, fan=2)
    assert state(spark, lake) == {1: (4, 4, 1.0)}
    figures.fold(table, DAILY, fan=2)
    assert state(spark, lake) == {1: (4, 4, 1.0)}


@pytest.mark.parametrize(
    "name,batch",
    [("daily", M.predictions_daily), ("hourly", M.hourly_trend), ("rate", lambda df: M.rate(df, "analyzed_at", M.MINUTE))],
)
def test_stream_of_shuffled_times_equals_batch(spark, lake, tmp_path, name, batch):
    log = spark.range(400).select(
        F.col("id").cast("string"), F.when(F.col("id") % 3 == 0, "fake").otherwise("real").alias("prediction"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=(F.col("id") * 37 % 5000).cast("int"))).alias("analyzed_at"),
        (F.col("id") % 7).cast("double").alias("latency_ms"),
    )
    log.repartition(5).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    figures.to_figure(stream, lake, name, trigger=None, fan=2).awaitTermination(200)
    shown = figures.read_figure(spark, lake, name)
    want = batch(log)
    assert shown.columns == want.columns
    norm = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert norm(shown) == norm(want)
    # Nothing new: the figure stays.
    figures.to_figure(stream, lake, name, trigger=None, fan=2).awaitTermination(200)
    assert norm(figures.read_figure(spark, lake, name)) == norm(want)


def test_reuse_on_a_stream(spark, tmp_path):
    """The latest prediction within the hour; its edges; content asked for more than once;
    requests without a content's hash; and none before the watermark has passed."""
    at = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    asked = [("a", "x", at(5, 0)), ("b", "x", at(5, 1)), ("c", "y", at(5, 0)), ("d", "z", at(5, 0)), ("e", None, at(5, 0)),
             ("f", "x", at(9, 0)), ("last", "q", at(20, 0)), ("open", "x", at(19, 59))]
    made = [("x", at(4, 0), "real", 0.6), ("x", at(4, 1), "fake", 0.7), ("x", at(4, 30), "real", 0.8), ("x", at(5, 1), "fake", 0.9),
            ("y", at(5, 1), "fake", 0.9), ("z", at(4, 0), "fake", 0.9), ("q", at(20, 0), "real", 0.5)]
    requests = spark.createDataFrame(asked, "id STRING, content_hash STRING, requested_at TIMESTAMP")
    prior = spark.createDataFrame(made, "content_hash STRING, analyzed_at TIMESTAMP, prediction STRING, confidence DOUBLE")
    streams = []
    for name, df in (("r", requests), ("p", prior)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        streams.append(spark.readStream.schema(df.schema).parquet(str(tmp_path / name)))
    writer = feed.with_reuse(*streams).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
    got = {r.id: (r.prediction, r.confidence, r.was_reused) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    none = (None, None, False)
    assert got == {"a": ("real", 0.8, True), "b": ("fake", 0.9, True), "c": none, "d": none, "e": none, "f": none}
