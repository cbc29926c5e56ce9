"""The index of silver's ids: exact, apart from silver's files, and safe to play again."""

import re

import pytest
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.operators import silver as V
from broadsheet.plans import id_index, jobs
from broadsheet.plans.lake import Lake
from broadsheet.plans.snapshots import DATA, Snapshot, Snapshots
from conftest import formatted_plan


def records(spark, numbers, label=None):
    ids = spark.createDataFrame([(str(n),) for n in numbers], "id STRING")
    absent = {f.name: F.lit(None).cast(f.dataType) for f in S.ENVELOPE.fields if f.name != "id"}
    rows = ids.withColumns(absent | {"content": F.lit("w " * 80), "label": F.lit(label).cast("string")})
    return rows.select(*S.ENVELOPE.names)


def held(spark, lake):
    return sorted(int(r.id) for r in lake.read(spark, "silver").select("id").collect())


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def run_of(spark, table, ids, writer, batch):
    df = spark.createDataFrame([(i,) for i in ids], "id STRING")
    base = table.current() or Snapshot()
    run = id_index.write_run(table, df, writer, batch)
    table.publish(id_index.with_runs(base, [*id_index.runs_of(base), run]), base.version)
    return run


def test_index_knows_its_ids_and_hardly_any_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "BUCKET_IDS", 700)
    table = Snapshots(spark, str(tmp_path / "t"))
    small = run_of(spark, table, [f"a{i}" for i in range(500)], "w", 0)
    large = run_of(spark, table, [f"b{i}" for i in range(20_000)], "w", 1)
    assert (small.pages, small.buckets) == (1, 1) and large.pages == 7 and large.buckets == 29
    asked = spark.createDataFrame([(f"{k}{i}",) for k in "abc" for i in range(0, 20_000, 3)], "id STRING")
    maybe = {(r.id, r.unit) for r in id_index.possible(table, [small, large], asked).collect()}
    want = {(f"a{i}", small.ids) for i in range(0, 500, 3)} | {(f"b{i}", large.ids) for i in range(0, 20_000, 3)}
    assert want <= maybe and len(maybe - want) < 0.03 * 2 * asked.count()
    got = {r.id for r in id_index.known(table, table.current(), asked).collect()}
    assert got == {i for i, _ in want}
    without = {r.id for r in id_index.known(table, table.current(), asked, ("w", 1)).collect()}
    assert without == {f"a{i}" for i in range(0, 500, 3)}
    none = spark.createDataFrame([(f"x{i}",) for i in range(50)], "id STRING")
    assert id_index.known(table, table.current(), none).count() == 0


def test_only_buckets_that_may_hold_an_id_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "BUCKET_IDS", 100)
    table = Snapshots(spark, str(tmp_path / "t"))
    run = run_of(spark, table, [f"b{i}" for i in range(5_000)], "w", 0)
    df = id_index.known(table, table.current(), spark.createDataFrame([("b7",), ("strange",)], "id STRING"))
    assert run.buckets == 50 and len(df.inputFiles()) <= 2 and [r.id for r in df.collect()] == ["b7"]


def test_a_batch_reads_no_silver_file(spark, lake):
    jobs.append_new_silver(spark, lake, records(spark, range(50)))
    table = lake.snapshots(spark, "silver")
    batch = records(spark, range(40, 60))
    known = id_index.known(table, table.current(), batch.select("id"))
    plan = formatted_plan(V.new_ids(V.build_silver(batch), known))
    # The plan cuts long lists of places, so the files are asked for too.
    assert f"/silver/{DATA}" not in plan and "/silver/ids" in plan
    assert known.inputFiles() and not any(f"/silver/{DATA}/" in f for f in known.inputFiles())
    assert sorted(int(r.id) for r in known.collect()) == list(range(40, 50))


def test_batches_add_only_new_ids(spark, lake):
    for first in (0, 30, 60):
        jobs.append_new_silver(spark, lake, records(spark, range(first, first + 50)))
    assert held(spark, lake) == list(range(110))
    jobs.append_new_silver(spark, lake, records(spark, range(110)))
    assert held(spark, lake) == list(range(110))
    jobs.append_new_silver(spark, lake, records(spark, []))
    assert held(spark, lake) == list(range(110))


def test_a_batch_played_again_replaces_itself(spark, lake):
    play = lambda numbers, batch, label=None: jobs.append_new_silver(spark, lake, records(spark, numbers, label), None, "s", batch)
    play(range(10), 0)
    play(range(5, 20), 1, "fake")
    play(range(5, 20), 1, "real")
    rows = {int(r.id): r.label for r in lake.read(spark, "silver").collect()}
    assert sorted(rows) == list(range(20)) == held(spark, lake)
    assert {rows[i] for i in range(10)} == {None} and {rows[i] for i in range(10, 20)} == {"real"}


def test_a_crash_between_rows_and_manifest_leaves_nothing(spark, lake, monkeypatch):
    jobs.append_new_silver(spark, lake, records(spark, range(10)), None, "s", 0)

    def lost(*_):
        raise OSError("executor of the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "publish", lost)
        with pytest.raises(OSError):
            jobs.append_new_silver(spark, lake, records(spark, range(20)), None, "s", 1)
    assert held(spark, lake) == list(range(10))
    jobs.append_new_silver(spark, lake, records(spark, range(20)), None, "s", 1)
    assert held(spark, lake) == list(range(20))


def test_runs_stay_few_and_exact(spark, lake, monkeypatch):
    monkeypatch.setattr(id_index, "MAX_RUNS", 3)
    monkeypatch.setattr(id_index.merge_runs, "__defaults__", (3,))
    for batch in range(9):
        jobs.append_new_silver(spark, lake, records(spark, range(10 * batch, 10 * batch + 15)), None, "s", batch)
    table = lake.snapshots(spark, "silver")
    runs = id_index.runs_of(table.current())
    assert len(runs) <= 4 and sum(r.n for r in runs) == 95
    assert held(spark, lake) == list(range(95))
    # The batch that may be played again still can be; one that was merged no longer.
    jobs.append_new_silver(spark, lake, records(spark, range(80, 99)), None, "s", 8)
    assert held(spark, lake) == list(range(99))
    with pytest.raises(ValueError, match="was merged"):
        jobs.append_new_silver(spark, lake, records(spark, [1000]), None, "s", 0)


def test_like_sized_runs_are_merged_first():
    run = lambda n: id_index.Run("w", n, "", "", n, 1, 1)
    assert [r.n for r in id_index.like_sized([run(n) for n in (10_000, 9, 10, 12, 30, 500)])] == [9, 10, 12, 30]
    assert [r.n for r in id_index.like_sized([run(1), run(1_000_000)])] == [1, 1_000_000]


def test_what_arrives_during_a_rebuild_is_kept(spark, lake, monkeypatch):
    jobs.write_bronze_batch(records(spark, range(20)), lake, "w", 0)
    jobs.append_new_silver(spark, lake, records(spark, range(3)), None, "s", 0)
    table = lake.snapshots(spark, "silver")
    write = Snapshots.write

    # Of what arrives, bronze has the first five as well.
    def write_then_append(self, df, writer, batch, *rest):
        unit = write(self, df, writer, batch, *rest)
        if writer == "overwrite" and not rest:
            monkeypatch.setattr(Snapshots, "write", write)
            jobs.append_new_silver(spark, lake, records(spark, range(15, 30)), None, "s", 1)
        return unit

    monkeypatch.setattr(Snapshots, "write", write_then_append)
    jobs.run_silver(spark, lake)
    assert held(spark, lake) == list(range(30))
    assert sum(r.n for r in id_index.runs_of(table.current())) == 30
    jobs.append_new_silver(spark, lake, records(spark, range(31)), None, "s", 2)
    assert held(spark, lake) == list(range(31))


def test_compaction_leaves_the_index_alone(spark, lake):
    for batch in range(5):
        jobs.append_new_silver(spark, lake, records(spark, range(10 * batch, 10 * batch + 10)))
    table = lake.snapshots(spark, "silver")
    before, after = table.compact()
    assert after < before and table.vacuum(keep_seconds=-10) > 0
    jobs.append_new_silver(spark, lake, records(spark, range(60)))
    assert held(spark, lake) == list(range(60))


def test_silver_without_a_manifest_is_rebuilt(spark, lake):
    V.build_silver(records(spark, range(5))).write.parquet(lake.path("silver"))
    assert held(spark, lake) == list(range(5))
    with pytest.raises(RuntimeError, match="run_silver"):
        jobs.append_new_silver(spark, lake, records(spark, range(9)))
    jobs.write_bronze_batch(records(spark, range(7)), lake, "w", 0)
    jobs.run_silver(spark, lake)
    assert held(spark, lake) == list(range(7))


def test_a_lake_without_records(spark, lake):
    jobs.write_bronze_batch(records(spark, []), lake, "w", 0)
    jobs.run_silver(spark, lake)
    table = lake.snapshots(spark, "silver")
    assert held(spark, lake) == [] and id_index.runs_of(table.current()) == []
    assert table.vacuum(keep_seconds=-10) == 0 and table.compact() is not None
    jobs.append_new_silver(spark, lake, records(spark, range(4)))
    assert held(spark, lake) == list(range(4))
