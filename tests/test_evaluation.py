import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from broadsheet.operators import evaluation as E


def brute_auc(rows):
    pos = [s for s, p in rows if p]
    neg = [s for s, p in rows if not p]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 4, 64])
@pytest.mark.parametrize("kind", ["spread", "ties", "hot"])
def test_auc(spark, kind, buckets):
    rnd = random.Random(1)
    score = {
        "spread": lambda: rnd.random(),
        "ties": lambda: float(rnd.randint(0, 9)),
        "hot": lambda: 0.5 if rnd.random() < 0.4 else rnd.random(),
    }[kind]
    rows = [(score(), rnd.random() < 0.4) for _ in range(400)]
    df = spark.createDataFrame(rows, "score DOUBLE, positive BOOLEAN")
    exact = E.auc_by_rank(df, buckets).first().auc
    assert exact == pytest.approx(brute_auc(rows), abs=1e-12)
    by_ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    assert by_ml.evaluate(df.selectExpr("score", "int(positive) AS y")) == pytest.approx(exact, abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, True), (0.2, True)], "score DOUBLE, positive BOOLEAN")
    assert E.auc_by_rank(df).first().auc is None


def test_metrics(spark):
    pairs = [("fake", "fake")] * 3 + [("fake", "real")] + [("real", "fake")] * 2 + [("real", "real")] * 4
    df = spark.createDataFrame(pairs, "label STRING, prediction STRING")
    m = E.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall) == (0.7, 0.6, 0.75)
    assert m.f1 == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    cells = {(r.label, r.prediction): r.n for r in E.confusion_matrix(df).collect()}
    assert cells["real", "fake"] == 2


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([("real", "real")], "label STRING, prediction STRING")
    m = E.classification_metrics(df).first()
    assert m.accuracy == 1 and m.precision is None and m.recall is None and m.f1 is None


def test_vote(spark):
    rows = [(a, b, c, 0.9, 0.6, 0.6) for a in (0.0, 1.0) for b in (0.0, 1.0) for c in (0.0, 1.0)]
    df = spark.createDataFrame(rows, "p1 DOUBLE, p2 DOUBLE, p3 DOUBLE, c1 DOUBLE, c2 DOUBLE, c3 DOUBLE")
    for r in E.majority_vote(df, [("p1", "c1"), ("p2", "c2"), ("p3", "c3")]).collect():
        assert r.vote == (r.p1 + r.p2 + r.p3 >= 2) and r.confidence == pytest.approx(0.7)


def test_unknown_label_raises(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("other",)], "label STRING")
    with pytest.raises(Exception, match="unknown label: other"):
        df.select(E.label_index(F.col("label"))).collect()
