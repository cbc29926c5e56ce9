"""Requests without a fresh prediction are scored by the model."""

from pyspark.sql import functions as F

from broadsheet.catalog import lake_queries


def test_answers_that_are_not_reused_come_from_the_model(spark, sf_dir, monkeypatch):
    own = lake_queries.score
    stranger = lambda *args, **kw: own(*args, **kw).withColumn("prediction", F.lit("unheard of"))
    monkeypatch.setattr(lake_queries, "score", stranger)
    rows = lake_queries.REGISTRY["scored_requests"](spark, sf_dir).collect()
    assert not all(r.was_reused for r in rows)
    assert all(r.has_prediction == r.was_reused for r in rows)
