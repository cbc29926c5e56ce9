"""Figures, frequencies and phrases from parts, against one pass over everything."""

import collections
import itertools
import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from broadsheet.catalog import adapters as A
from broadsheet.operators import associations, evaluation, frequencies, gold, parts, quality
from broadsheet.operators.scoring import model_input
from broadsheet.plans import jobs, training
from broadsheet.plans.lake import Lake
from conftest import formatted_plan


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def batches(df, n=4):
    return [df.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == k) for k in range(n)]


def rounded(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_report_from_parts_equals_the_report(spark, sf_dir, lake):
    layers = {"bronze": A.news(spark, sf_dir), "silver": A.silver(spark, sf_dir), "gold": A.gold(spark, sf_dir)}
    for layer, rows in layers.items():
        for k, batch in enumerate(batches(rows)):
            jobs.add_quality_part(batch, lake, layer, "w", k)
        # A batch that comes again, and an empty one.
        jobs.add_quality_part(batches(rows)[1], lake, layer, "w", 1)
        jobs.add_quality_part(rows.limit(0), lake, layer, "w", 9)
    got = jobs.quality_from_parts(spark, lake)
    assert rounded(got) == rounded(quality.quality_report(**layers))
    assert all("quality_parts" in f for f in got.inputFiles())
    statistics = jobs.statistics_from_parts(spark, lake).drop("quantiles")
    assert rounded(statistics) == rounded(gold.feature_statistics(layers["gold"]))


def test_distinct_sources_keep_their_error(spark):
    rows = spark.range(30_000).select(F.concat(F.lit("s"), F.col("id") % 20_000).alias("source"), F.lit("d").alias("bronze_date"), "id")
    both = parts.bronze_part(rows.filter("id < 17000")).unionByName(parts.bronze_part(rows.filter("id >= 9000")))
    got = parts.bronze_figures(both).first()
    assert abs(got.unique_sources - 20_000) < 3 * parts.DISTINCT_ERROR * 20_000
    assert got.total_records == 17_000 + 21_000


def test_moments_far_from_zero_and_quantiles(spark):
    rows = spark.range(9_000).select(F.lit(None).cast("string").alias("label"), (1e9 + F.col("id") % 1000).alias("word_count"), "id")
    part = lambda low, high: parts.gold_part(rows.filter(f"id >= {low} and id < {high}"), ["word_count"])
    merged = part(0, 100).unionByName(part(100, 5_000)).unionByName(part(5_000, 9_000)).unionByName(part(9_000, 9_001))
    got = parts.feature_figures(merged).first()
    whole = gold.feature_statistics(rows, ["word_count"]).first()
    assert (got["count"], got.min, got.max) == (whole["count"], whole.min, whole.max)
    assert abs(got.stddev - whole.stddev) < 1e-6 and abs(got.mean - whole.mean) < 1e-6
    for q, value in zip(parts.QUANTILES, got.quantiles):
        assert abs((value - 1e9) / 1000 - q) < 3 * parts.RANK_ERROR
    single = parts.feature_figures(part(0, 1)).first()
    assert single.stddev is None and single["count"] == 1


def test_parts_hold_one_row_a_batch(spark, sf_dir):
    assert parts.bronze_part(A.news(spark, sf_dir)).count() == 1
    assert parts.silver_part(A.silver(spark, sf_dir).limit(0)).first().n == 0


# -- document frequencies ------------------------------------------------------------


def vectors(model, silver, column="tfidf_features"):
    rows = model.transform(silver).select("id", vector_to_array(column).alias("v")).collect()
    return {r.id: [round(v, 9) for v in r.v] for r in rows}


def test_weights_from_parts_equal_a_fresh_fit(spark, sf_dir, lake):
    silver = A.silver(spark, sf_dir).select("id", "content_cleaned")
    old, *rest = batches(silver, 5)
    for k, batch in enumerate(rest):
        jobs.add_frequencies(batch, lake, "w", k, dimensions=64)
    jobs.add_frequencies(old, lake, "old", 0, dimensions=64)
    jobs.add_frequencies(old, lake, "old", 1, withdrawn=True, dimensions=64)
    jobs.add_frequencies(silver.limit(0), lake, "w", 8, dimensions=64)
    now = silver.join(old.select("id"), "id", "left_anti")
    got = vectors(jobs.text_from_parts(spark, lake, 64), silver)
    assert got == vectors(training.text_pipeline(64).fit(now), silver)
    # Nothing old is read to build the model, and it can be saved as any other.
    assert all("frequencies" in f for f in lake.frequencies(spark).read().inputFiles())
    model = jobs.text_from_parts(spark, lake, 64)
    model.write().overwrite().save(lake.model_path("text"))
    assert vectors(training.PipelineModel.load(lake.model_path("text")), silver) == got


def test_bucket_terms_are_those_that_hash_there(spark):
    texts = ["river stone river", "river cloud", "stone cloud cloud", "the and", "", "cloud"]
    silver = spark.createDataFrame(list(enumerate(texts)), "id LONG, content_cleaned STRING")
    hashing = training.HashingTF(numFeatures=4)
    by_bucket = collections.defaultdict(list)
    for term, df in (("river", 2), ("stone", 2), ("cloud", 3)):
        by_bucket[hashing.indexOf(term)].append((-df, term))
    want = {(b, n + 1, t, -d) for b, found in by_bucket.items() for n, (d, t) in enumerate(sorted(found)[:2])}
    assert {tuple(r) for r in frequencies.bucket_terms(silver, 4, 2).collect()} == want


def test_bucket_terms_prune_in_the_tasks(spark, sf_dir):
    assert "WindowGroupLimit" in formatted_plan(frequencies.bucket_terms(A.silver(spark, sf_dir), 64))


SIZE = 512


# -- models ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def planted(spark, sf_dir):
    """A label drawn for each article and told by words of its own."""
    label = F.when(F.substring(F.md5("id"), 1, 1) < "8", "fake").otherwise("real")
    told = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.concat(label, F.lit("mark"), k)), " ")
    rows = A.silver(spark, sf_dir).withColumns({"label": label, "content_cleaned": F.concat_ws(" ", "content_cleaned", told)})
    test = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    return rows.filter(~test), rows.filter(test)


@pytest.fixture(scope="module")
def logistic(spark, planted):
    stages = [*training.preprocessing(spark, SIZE).getStages(), training.default_classifiers(logistic={"maxIter": 20})["logistic_regression"]]
    return Pipeline(stages=stages).fit(model_input(planted[0]))


def test_a_planted_signal_is_learned(planted):
    sizes = {"forest": {"numTrees": 20, "maxDepth": 6}, "logistic": {"maxIter": 20}, "boosting": {"maxIter": 8}}
    results = training.train_models(*planted, training.default_classifiers(**sizes), dimensions=SIZE)
    majority = planted[1].groupBy("label").count().agg((F.max("count") / F.sum("count"))).first()[0]
    assert all(r.auc > 0.9 and r.accuracy > majority + 0.1 for r in results)


def test_logistic_scores_follow_from_the_coefficients(planted, logistic):
    """Probability, prediction and AUC recomputed in SQL functions from the exported numbers."""
    model = logistic.stages[-1]
    scored = logistic.transform(model_input(planted[1]))
    weights = F.array(*map(F.lit, model.coefficients.toArray().tolist()))
    each = F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)
    margin = F.aggregate(each, F.lit(float(model.intercept)), lambda a, v: a + v)
    own = scored.withColumn("own", 1 / (1 + F.exp(-margin))).withColumn("p", vector_to_array("probability")[1])
    off = own.agg(F.max(F.abs(F.col("own") - F.col("p"))), F.count_if((F.col("own") > 0.5) != (F.col("prediction") == 1))).first()
    assert off[0] < 1e-9 and off[1] == 0
    # Probabilities near 1 are equal as numbers where margins are not.
    auc = evaluation.auc_by_rank(own.select(margin.alias("score"), (F.col("label") == "fake").alias("positive"))).first().auc
    assert abs(auc - training.auc_evaluator().evaluate(scored)) < 1e-9


def test_text_importances_add_up(spark, planted, logistic):
    terms = frequencies.bucket_terms(planted[0], SIZE)
    rows = training.text_importance(logistic, terms).collect()
    total = next(r.importance for r in training.feature_importance(logistic).collect() if r.feature == "tfidf_features")
    assert abs(sum(r.importance for r in rows) - total) < 1e-9
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    # The planted words pull to their own side.
    bucket, weight = training.HashingTF(numFeatures=SIZE).indexOf, {r.bucket: r.weight for r in rows}
    assert sum(weight.get(bucket(f"fakemark{k}"), 0) > 0 for k in range(1, 13)) >= 10
    assert sum(weight.get(bucket(f"realmark{k}"), 0) < 0 for k in range(1, 13)) >= 10
    assert all(len(r.terms) <= frequencies.TERMS for r in rows if r.terms)


# -- phrases --------------------------------------------------------------------------


def brute_phrases(texts, min_count, min_score):
    pairs = [p for t in texts for p in itertools.pairwise(t.lower().split(" ")) if all(p)]
    ab, a, b, n = collections.Counter(pairs), collections.Counter(x for x, _ in pairs), collections.Counter(y for _, y in pairs), len(pairs)
    part = lambda k, row, column: k * math.log(k * n / (row * column)) if k else 0.0
    out = {}
    for (x, y), k in ab.items():
        f, s = a[x], b[y]
        score = 2 * (part(k, f, s) + part(f - k, f, n - s) + part(s - k, n - f, s) + part(n - f - s + k, n - f, n - s))
        if k >= min_count and k * n > f * s and score >= min_score:
            out[x, y] = (k, round(score, 6))
    return out


@pytest.mark.parametrize("width", [3, 1 << 12])
def test_phrases(spark, monkeypatch, width):
    """However few counters there are, no frequent pair is lost."""
    monkeypatch.setattr(associations.frequent_pairs, "__defaults__", (5, width, 2))
    texts = [f"the new moon {'old' if i % 3 else 'red'} house the w{i % 11} moon  new house" for i in range(60)] + ["", "one"]
    silver = spark.createDataFrame(list(enumerate(texts)), "id LONG, content_cleaned STRING")
    got = {(r.first_, r.second): (r.n, round(r.score, 6)) for r in associations.associated_phrases(silver, 5, 3.0).withColumnRenamed("first", "first_").collect()}
    want = brute_phrases(texts, 5, 3.0)
    assert want and got == want


def test_rare_pairs_do_not_reach_the_last_shuffle(spark):
    pairs = spark.range(20_000).select(F.concat(F.lit("a"), F.col("id")).alias("a"), F.lit("b").alias("b"))
    hot = spark.range(500).select(F.lit("x").alias("a"), F.lit("y").alias("b"))
    found = associations.frequent_pairs(pairs.unionByName(hot), 5, 1 << 16, 2)
    assert [tuple(r) for r in found.collect()] == [("x", "y", 500)]
    plan = formatted_plan(found)
    assert plan.count("BroadcastHashJoin") >= 2
    assert "CartesianProduct" not in plan
