import json

from broadsheet.operators import bronze as B
from broadsheet.plans import jobs
from broadsheet.plans.lake import Lake


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


GOOD = json.dumps({"id": "1", "source": "s", "source_type": "rss", "title": "T", "raw_data": {"a": [1, 2]}})
EXTRA = json.dumps({"id": "2", "source": "s", "source_type": "rss", "surprise": True,
                    "engagement": {"likes": 2, "shares": 0, "comments": 1}})
BROKEN = '{"id": "3", "title": '


def test_decode_and_quarantine(spark):
    decoded = B.decode(messages(spark, GOOD, EXTRA, BROKEN))
    rows = {r.id: r for r in B.good(decoded).collect()}
    assert set(rows) == {"1", "2"}
    assert json.loads(rows["1"].raw_data) == {"a": [1, 2]}
    assert rows["2"].engagement.likes == 2 and rows["2"].title is None
    assert [r.value for r in B.quarantined(decoded).collect()] == [BROKEN]


def test_messages_without_a_value_or_an_id_are_quarantined(spark):
    nameless = json.dumps({"source": "s", "title": "T"})
    decoded = B.decode(messages(spark, GOOD, None, nameless))
    assert [r.id for r in B.good(decoded).collect()] == ["1"]
    assert sorted(r.value for r in B.quarantined(decoded).collect()) == ["", nameless]


def test_stamp(spark):
    r = B.stamp(B.good(B.decode(messages(spark, GOOD))), "2024-05-06 07:08:09").first()
    assert r.bronze_date == "2024-05-06" and str(r.bronze_timestamp) == "2024-05-06 07:08:09"


def test_batches_append_and_a_rerun_replaces_itself(spark, tmp_path):
    lake = Lake(str(tmp_path))
    records = B.good(B.decode(messages(spark, GOOD, EXTRA)))
    jobs.write_bronze_batch(records, lake, "job", 0, "2024-05-06 00:00:00")
    jobs.write_bronze_batch(records, lake, "job", 1, "2024-05-06 00:00:00")
    # The second attempt at batch 1 runs after midnight.
    jobs.write_bronze_batch(records, lake, "job", 1, "2024-05-07 00:00:00")
    jobs.write_bronze_batch(records, lake, "other", 0, "2024-05-07 00:00:00")
    bronze = lake.read(spark, "bronze")
    assert bronze.count() == 6
    assert {"source_type", "bronze_date", "writer", "batch_id"} <= set(bronze.columns)
    by_date = {r.bronze_date: r["count"] for r in bronze.groupBy("bronze_date").count().collect()}
    assert by_date == {"2024-05-06": 2, "2024-05-07": 4}
    assert lake.register_views(spark) == ["bronze"]
    assert spark.sql("SELECT count(*) AS n FROM bronze WHERE writer = 'job'").first().n == 4
