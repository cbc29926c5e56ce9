import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.operators import scoring
from broadsheet.plans import jobs, training
from broadsheet.plans.lake import Lake

DIMENSIONS = 32
SMALL = {"forest": {"numTrees": 4, "maxDepth": 3}, "logistic": {"maxIter": 5}, "boosting": {"maxIter": 2}}


@pytest.fixture(scope="module")
def articles(spark, tmp_path_factory):
    """Fake texts shout and have no author; every seventh row is the other way round."""
    i = F.col("id")
    odd = (i % 2 == 1) != (i % 7 == 0)
    df = spark.range(0, 240, numPartitions=4).select(
        F.md5(i.cast("string")).alias("id"),
        F.lit("s").alias("source"),
        F.lit("rss").alias("source_type"),
        F.lit("A title").alias("title_cleaned"),
        F.concat(
            F.when(odd, "SHOCKING! You WON'T believe this banned trick!! ").otherwise(
                "According to research published by the university, "
            ),
            F.lit("number "),
            i,
            F.lit(" of the report"),
        ).alias("content_cleaned"),
        F.when(odd, F.lit(None)).otherwise("ann").alias("author"),
        F.when(i % 2 == 1, "fake").otherwise("real").alias("label"),
        (i % 4 == 0).alias("is_test"),
    )
    path = str(tmp_path_factory.mktemp("articles"))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sides(articles):
    # Both labels on both sides.
    is_test = F.substring("id", 1, 1) < "4"
    return articles.filter(~is_test), articles.filter(is_test)


@pytest.fixture(scope="module")
def results(sides):
    return training.train_models(
        *sides, training.default_classifiers(**SMALL), dimensions=DIMENSIONS
    )


def test_models_learn_and_ties_keep_order(results):
    assert [r.name for r in results] == ["random_forest", "logistic_regression", "gradient_boosting"]
    assert all(r.auc > 0.7 and r.accuracy > 0.7 and r.cv_auc > 0.6 for r in results)


def test_same_seed_same_figures(sides, results):
    name = "random_forest"
    forest = training.default_classifiers(**SMALL)[name]
    [again] = training.train_models(*sides, {name: forest}, dimensions=DIMENSIONS)
    assert (again.auc, again.accuracy, again.cv_auc) == (results[0].auc, results[0].accuracy, results[0].cv_auc)


def test_weights_may_be_fitted_on_all_rows(sides, articles):
    train, test = sides
    own = training.prepare(train, test, DIMENSIONS).model.stages[4].idf
    every = training.prepare(train, test, DIMENSIONS, fit_on=articles).model.stages[4].idf
    assert len(own) == len(every) == DIMENSIONS and list(own) != list(every)


def test_best_needs_more_than_nothing_and_prefers_the_first():
    run = lambda name, order, auc: training.Trained(name, order, None, auc, 0, 0, "{}")
    assert training.best_of([run("a", 0, 0.8), run("b", 1, 0.9), run("c", 2, 0.9)]).name == "b"
    assert training.best_of([run("a", 0, 0.0)]) is None



def test_default_sizes():
    models = training.default_classifiers()
    assert models["random_forest"].getNumTrees() == 100 and models["random_forest"].getMaxDepth() == 10
    assert models["logistic_regression"].getMaxIter() == 100
    assert models["gradient_boosting"].getMaxIter() == 50
    small = training.ensemble_classifiers()
    assert small["random_forest"].getNumTrees() == 50 and small["random_forest"].getMaxDepth() == 8
    assert small["logistic_regression"].getMaxIter() == 50 and small["gradient_boosting"].getMaxIter() == 30


def test_grid_and_refitting_in_each_fold(sides):
    # The strong lasso leaves no feature, so the grid has one right answer.
    sizes = SMALL | {"logistic": {"maxIter": 5, "elasticNetParam": 1.0}}
    classifier = training.default_classifiers(**sizes)["logistic_regression"]
    grid = ParamGridBuilder().addGrid(classifier.regParam, [50.0, 0.01]).build()
    [r] = training.train_models(
        *sides, {"lr": classifier}, {"lr": grid}, dimensions=DIMENSIONS, folds=2, preprocess_per_fold=True
    )
    assert r.auc > 0.7 and r.model.stages[-1].getRegParam() == 0.01


def test_vector_width_and_scaling(spark, articles):
    fitted = training.preprocessing(spark, DIMENSIONS).fit(scoring.model_input(articles))
    row = fitted.transform(scoring.model_input(articles)).first()
    assert len(row.all_features) == len(S.NUMERIC_FEATURES) + DIMENSIONS == len(row.features)
    deviation = articles.select(F.stddev_samp(F.length("content_cleaned"))).first()[0]
    position = S.NUMERIC_FEATURES.index("char_count")
    assert row.features[position] == pytest.approx(len(row.content_cleaned) / deviation)
    assert row.label_index in (0.0, 1.0)


def test_single_class_training_set_keeps_both_indices(spark, articles):
    only_fake = articles.filter("label = 'fake'")
    rows = training.label_indexer(spark).transform(only_fake).select("label_index").distinct().collect()
    assert [r.label_index for r in rows] == [1.0]


def test_unknown_label_raises(spark):
    df = spark.createDataFrame([("maybe",)], "label STRING")
    with pytest.raises(Exception):
        training.label_indexer(spark).transform(df).collect()


def test_importance_names_and_text_total(results):
    for r in results:
        rows = training.feature_importance(r.model).collect()
        assert {x.feature for x in rows} == {*S.NUMERIC_FEATURES, "tfidf_features"}
        assert [x.importance for x in rows] == sorted((x.importance for x in rows), reverse=True)
        if r.name != "logistic_regression":
            assert sum(x.importance for x in rows) == pytest.approx(1.0)


def test_save_load_score_is_equal(spark, articles, results, tmp_path):
    best = training.best_of(results)
    training.save_model(best.model, str(tmp_path), results, best.name)
    loaded = training.load_model(str(tmp_path))
    unlabelled = articles.drop("label")
    before = {r.id: r for r in scoring.score(unlabelled, best.model, as_of="2024-01-01").collect()}
    after = {r.id: r for r in scoring.score(unlabelled, loaded, as_of="2024-01-01").collect()}
    assert before == after and len(before) == 240
    more = scoring.score(unlabelled, loaded, keep=("word_count", "caps_ratio"))
    assert more.columns == [*S.PREDICTION_COLUMNS, "word_count", "caps_ratio"]
    assert all(0.5 <= r.confidence <= 1 and r.prediction in S.LABELS for r in before.values())
    meta = {r.model: r.best for r in spark.read.json(f"{tmp_path}/metadata").collect()}
    assert meta[best.name] and sum(meta.values()) == 1


def test_ensemble_votes_row_by_row(sides):
    train, test = sides
    model, names = training.train_ensemble(train, training.default_classifiers(**SMALL), DIMENSIONS)
    rows = training.ensemble_vote(model, names, test).collect()
    assert len(rows) == test.count()
    for r in rows:
        votes = [r[f"{n}_prediction"] for n in names]
        assert r.vote == (sum(votes) >= 2)
        sure = [r[f"{n}_probability"][int(r[f"{n}_prediction"])] for n in names]
        assert r.confidence == pytest.approx(sum(sure) / 3)
    assert sum(r.vote == r.label_index for r in rows) / len(rows) > 0.7



def test_whole_lake(spark, articles, tmp_path):
    """Bronze to predictions through the jobs, and once more without double work."""
    lake = Lake(str(tmp_path))
    records = articles.select(
        "id", "source", "source_type", F.lit("A <b>title</b>").alias("title"),
        F.concat(F.repeat(F.lit("<p>word</p> "), 12), "content_cleaned").alias("content"),
        F.lit("u").alias("url"), F.lit("").alias("published_date"), "author", "label",
        F.lit("2024-01-01").cast("timestamp").alias("ingestion_timestamp"),
    )
    jobs.write_bronze_batch(records, lake, "load", 0, "2024-01-02 00:00:00")
    jobs.write_bronze_batch(records.limit(20), lake, "load", 1, "2024-01-03 00:00:00")
    jobs.run_silver(spark, lake)
    jobs.append_new_silver(spark, lake, records)
    assert lake.read(spark, "silver").count() == 240
    jobs.run_gold(spark, lake, DIMENSIONS)
    gold = jobs.read_gold(spark, lake)
    assert gold.count() == 240 and set(gold.columns) == set(S.GOLD_COLUMNS)
    assert len(gold.first().tfidf_features) == DIMENSIONS
    assert lake.read(spark, "feature_statistics").count() == 9
    counts = {(r.split, r.label): r.n for r in jobs.run_splits(spark, lake).collect()}
    assert counts == {("train", "fake"): 96, ("train", "real"): 96, ("test", "fake"): 24, ("test", "real"): 24}
    report = {(r.layer, r.metric): r.value for r in jobs.run_quality(spark, lake).collect()}
    assert report["bronze", "total_records"] == 260 and report["gold", "label_fake"] == 120
    small = training.default_classifiers(**SMALL)
    best = jobs.run_training(
        spark, lake, classifiers={"logistic_regression": small["logistic_regression"]}, dimensions=DIMENSIONS
    )
    assert best.name == "logistic_regression" and lake.read(spark, "runs").count() == 1

    requests = records.select("content", "title", F.lit(None).cast("string").alias("url"), "author", "source")
    requests = requests.limit(30).unionByName(requests.limit(1).withColumn("content", F.lit(None).cast("string")))
    rejected = jobs.run_scoring(spark, lake, requests, "2024-01-05 10:00:00")
    assert rejected.count() == 1
    # One answer for each request that was accepted, copies of a content included.
    assert lake.read(spark, "responses").count() == 30
    first = lake.read(spark, "predictions").count()
    assert first == requests.select("content").distinct().filter("content IS NOT NULL").count()
    jobs.run_scoring(spark, lake, requests, "2024-01-05 10:30:00")
    assert lake.read(spark, "predictions").count() == first
    responses = lake.read(spark, "responses")
    assert responses.count() == 60 and responses.filter("was_reused").count() == 30
    jobs.run_scoring(spark, lake, requests, "2024-01-05 12:30:00")
    assert lake.read(spark, "predictions").count() == 2 * first

    # Corrections reach gold, the splits and the training rows; the last one holds.
    [a, b] = [r.id for r in records.filter("label = 'fake'").select("id").limit(2).collect()]
    schema = "id STRING, label STRING"
    jobs.add_labels(spark.createDataFrame([(a, "real"), (b, "real")], schema), lake, 1)
    jobs.add_labels(spark.createDataFrame([(b, "fake")], schema), lake, 2)
    jobs.refresh(spark, lake, ["gold", "splits"])
    gold = {r.id: r.label for r in jobs.read_gold(spark, lake).select("id", "label").collect()}
    assert gold[a] == "real" and gold[b] == "fake" and len(gold) == 240
    sides = jobs.labelled_text(spark, lake, "train").unionByName(jobs.labelled_text(spark, lake, "test"))
    assert sides.count() == 240 and sides.filter(F.col("id") == a).first().label == "real"
