"""Batches of bronze moved into files by day: nothing lost, nothing twice."""

import pytest
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.plans import bronze_days, jobs
from broadsheet.plans.lake import Lake
from broadsheet.plans.snapshots import Snapshots


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def write(spark, lake, writer, batch, ids, day="2024-01-01", label=None):
    rows = spark.createDataFrame([(str(i), f"t{int(i) % 2}") for i in ids], "id STRING, source_type STRING")
    absent = {f.name: F.lit(None).cast(f.dataType) for f in S.ENVELOPE.fields if f.name not in rows.columns}
    rows = rows.withColumns(absent).withColumn("label", F.lit(label).cast("string")).select(*S.ENVELOPE.names)
    jobs.write_bronze_batch(rows, lake, writer, batch, f"{day} 00:00:00")


def held(spark, lake):
    return sorted((r.writer, int(r.batch_id), int(r.id), r.label) for r in lake.read(spark, "bronze").collect())


def folders(spark, lake):
    return sorted(bronze_days.batches(lake.bronze_days(spark), lake.path("bronze")))


def merge(spark, lake, keep_seconds=-10):
    days = lake.bronze_days(spark)
    moved = bronze_days.merge(days, lake.path("bronze"))
    bronze_days.vacuum(days, lake.path("bronze"), keep_seconds)
    return moved


def test_closed_batches_move(spark, lake):
    for batch in range(6):
        write(spark, lake, "s", batch, range(4 * batch, 4 * batch + 4), f"2024-01-0{1 + batch // 3}")
    write(spark, lake, "load", 7, [100])
    before, columns = held(spark, lake), lake.read(spark, "bronze").columns
    assert merge(spark, lake) == 5
    assert held(spark, lake) == before and lake.read(spark, "bronze").columns == columns == S.BRONZE.names
    # The latest of each writer stays; there is a file for each day and type of source.
    assert folders(spark, lake) == [("load", 7), ("s", 5)]
    days = lake.bronze_days(spark)
    assert len(days.files(days.current())) == 4
    assert merge(spark, lake) == 0 and held(spark, lake) == before
    write(spark, lake, "s", 6, [50])
    assert merge(spark, lake) == 1 and folders(spark, lake) == [("load", 7), ("s", 6)]
    assert {(w, b, i) for w, b, i, _ in held(spark, lake)} == {(w, b, i) for w, b, i, _ in before} | {("s", 6, 50)}


def test_a_merged_batch_that_is_played_again_replaces_itself(spark, lake):
    for batch in range(4):
        write(spark, lake, "s", batch, [10 * batch, 10 * batch + 1])
        write(spark, lake, "t", batch, [10 * batch + 5])
    merge(spark, lake)
    write(spark, lake, "s", 1, [10, 12], label="new")
    want = [("s", 0, 0, None), ("s", 0, 1, None), ("s", 1, 10, "new"), ("s", 1, 12, "new"), ("s", 2, 20, None),
            ("s", 2, 21, None), ("s", 3, 30, None), ("s", 3, 31, None), *(("t", b, 10 * b + 5, None) for b in range(4))]
    assert held(spark, lake) == want and ("s", 1) in folders(spark, lake)
    # It moves with the next merge, and once more.
    assert merge(spark, lake) == 1 and held(spark, lake) == want
    assert folders(spark, lake) == [("s", 3), ("t", 3)]
    write(spark, lake, "s", 1, [11], label="newer")
    assert [x for x in held(spark, lake) if x[:2] == ("s", 1)] == [("s", 1, 11, "newer")]
    merge(spark, lake)
    assert [x for x in held(spark, lake) if x[:2] == ("s", 1)] == [("s", 1, 11, "newer")]


def test_a_replay_during_the_merge_is_the_newer_one(spark, lake, monkeypatch):
    for batch in range(3):
        write(spark, lake, "s", batch, [batch])
    merge(spark, lake)
    write(spark, lake, "s", 3, [3])
    write(spark, lake, "s", 0, [7], label="again")
    publish = Snapshots.publish

    def late(self, snapshot, after):
        monkeypatch.setattr(Snapshots, "publish", publish)
        write(spark, lake, "s", 1, [8], label="late")
        return publish(self, snapshot, after)

    monkeypatch.setattr(Snapshots, "publish", late)
    assert merge(spark, lake) == 2
    want = [("s", 0, 7, "again"), ("s", 1, 8, "late"), ("s", 2, 2, None), ("s", 3, 3, None)]
    assert held(spark, lake) == want
    merge(spark, lake)
    assert held(spark, lake) == want


def test_readers_finish_what_they_began(spark, lake):
    for batch in range(4):
        write(spark, lake, "s", batch, range(3 * batch, 3 * batch + 3))
    began, before = lake.read(spark, "bronze"), held(spark, lake)
    assert merge(spark, lake, keep_seconds=3600) == 3
    assert sorted(int(r.id) for r in began.collect()) == list(range(12)) and held(spark, lake) == before
    assert len(folders(spark, lake)) == 4
    bronze_days.vacuum(lake.bronze_days(spark), lake.path("bronze"), -10)
    assert len(folders(spark, lake)) == 1 and held(spark, lake) == before


def test_a_merge_that_stops_before_its_manifest_changes_nothing(spark, lake, monkeypatch):
    for batch in range(3):
        write(spark, lake, "s", batch, [batch])

    def lost(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "publish", lost)
        with pytest.raises(OSError):
            merge(spark, lake)
    assert [x[2] for x in held(spark, lake)] == [0, 1, 2]
    assert merge(spark, lake) == 2 and [x[2] for x in held(spark, lake)] == [0, 1, 2]


def test_upkeep_of_a_whole_lake_changes_no_row(spark, lake):
    for batch in range(4):
        write(spark, lake, "s", batch, range(5 * batch, 5 * batch + 5))
        records = lake.read(spark, "bronze").filter(f"batch_id = {batch}").withColumn("content", F.lit("w " * 80))
        jobs.append_new_silver(spark, lake, records.select(*S.ENVELOPE.names), None, "s", batch)
        jobs.add_quality_part(records, lake, "bronze", "s", batch)
        jobs.add_frequencies(lake.read(spark, "silver").filter(f"id >= {5 * batch}"), lake, "s", batch, dimensions=8)
    read = lambda: (held(spark, lake), sorted(r.id for r in lake.read(spark, "silver").collect()),
                    sorted(map(tuple, jobs.quality_from_parts(spark, lake).collect()), key=repr))
    before, files = read(), lake.files(spark, "silver")
    jobs.run_upkeep(spark, lake, few_files=2)
    assert read() == before and lake.files(spark, "silver") < files
    jobs.run_upkeep(spark, lake, few_files=2)
    assert read() == before
    jobs.run_upkeep(spark, Lake(f"{lake.root}-none"))
