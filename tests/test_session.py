from broadsheet.session import ensure_checkpoint_dir, materialise, size_settings

TIB = 1024**4


def test_small_input_keeps_the_sessions_settings():
    assert size_settings(10_000, 8) == {"spark.sql.shuffle.partitions": "8"}


def test_partitions_follow_the_input_up_to_a_bound():
    assert size_settings(TIB)["spark.sql.shuffle.partitions"] == "8192"
    huge = size_settings(100 * TIB)
    assert huge["spark.sql.shuffle.partitions"] == "100000"
    read = int(huge["spark.sql.files.maxPartitionBytes"])
    assert 128 * 1024**2 < read <= 1024**3 and 100 * TIB / read <= 200_001


def test_materialised_plan_starts_afresh(spark):
    df = materialise(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and df.count() == 7
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
