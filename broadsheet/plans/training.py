"""Training: preprocessing, three classifiers, ensemble, importance, model files.

The text pipeline is fitted once and its output cut from its lineage on reliable
storage, so the many passes of the classifiers read finished vectors.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    StandardScaler,
    StopWordsRemover,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.operators.evaluation import majority_vote
from broadsheet.operators.scoring import class_confidence, model_input
from broadsheet.operators.splits import hash_bucket
from broadsheet.plans.boosting import boost, can_boost
from broadsheet.session import materialise

# Model sizes.
TFIDF_DIMENSIONS = 1000
FOREST = {"numTrees": 100, "maxDepth": 10}
LOGISTIC = {"maxIter": 100}
BOOSTING = {"maxIter": 50}
ENSEMBLE_FOREST = {"numTrees": 50, "maxDepth": 8}
ENSEMBLE_LOGISTIC = {"maxIter": 50}
ENSEMBLE_BOOSTING = {"maxIter": 30}
FOLDS = 3
SEED = 42

LABEL, FEATURES = "label_index", "features"


def text_stages(dimensions: int = TFIDF_DIMENSIONS) -> list:
    return [
        Tokenizer(inputCol="content_cleaned", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words"),
        HashingTF(inputCol="filtered_words", outputCol="term_counts", numFeatures=dimensions),
        IDF(inputCol="term_counts", outputCol="tfidf_features"),
    ]


def counting_model(dimensions: int = TFIDF_DIMENSIONS) -> PipelineModel:
    """The text stages that have nothing to fit."""
    return PipelineModel(stages=text_stages(dimensions)[:-1])


def text_pipeline(dimensions: int = TFIDF_DIMENSIONS) -> Pipeline:
    return Pipeline(stages=text_stages(dimensions))


def label_indexer(spark: SparkSession) -> StringIndexerModel:
    """The label set is fixed, so nothing is fitted, a fold without one class keeps
    both indices, and an unknown label raises. Scoring skips this stage, as its
    input is absent there."""
    return StringIndexerModel.from_labels(
        list(S.LABELS), inputCol="label", outputCol=LABEL, handleInvalid="error"
    )


def numeric_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(S.NUMERIC_FEATURES), outputCol="numeric_features")


def vector_stages() -> list:
    return [
        numeric_assembler(),
        VectorAssembler(inputCols=["numeric_features", "tfidf_features"], outputCol="all_features"),
        StandardScaler(inputCol="all_features", outputCol=FEATURES, withStd=True, withMean=False),
    ]


def preprocessing(spark: SparkSession, dimensions: int = TFIDF_DIMENSIONS) -> Pipeline:
    """From cleaned text and numeric features to the scaled vector."""
    return Pipeline(stages=[label_indexer(spark), *text_stages(dimensions), *vector_stages()])


def fitted_preprocessing(
    train: DataFrame, dimensions: int = TFIDF_DIMENSIONS, folds: int | None = None
) -> tuple[PipelineModel, DataFrame]:
    """What `preprocessing` makes of a fit to the rows, and their (id, label index, vector),
    with the fold if asked. The texts are taken apart once: what is fitted, and the vectors,
    are made of the counts."""
    counting, rest = counting_model(dimensions), [text_stages(dimensions)[-1], *vector_stages()]
    indexer = label_indexer(train.sparkSession)
    rows = PipelineModel(stages=[indexer, *counting.stages]).transform(model_input(train))
    counted = materialise(rows.select("id", LABEL, "term_counts", *S.NUMERIC_FEATURES))
    fitted = Pipeline(stages=rest).fit(counted)
    vectors = fitted.transform(counted).select("id", LABEL, FEATURES)
    vectors = materialise(vectors if folds is None else _fold_column(vectors, folds))
    return PipelineModel(stages=[indexer, *counting.stages, *fitted.stages]), vectors


def default_classifiers(
    forest: dict = FOREST, logistic: dict = LOGISTIC, boosting: dict = BOOSTING, **shared
) -> dict[str, Estimator]:
    """In the order in which ties are settled."""
    common = {"labelCol": LABEL, "featuresCol": FEATURES, **shared}
    return {
        "random_forest": RandomForestClassifier(seed=SEED, **common, **forest),
        "logistic_regression": LogisticRegression(**common, **logistic),
        "gradient_boosting": GBTClassifier(seed=SEED, **common, **boosting),
    }


def ensemble_classifiers() -> dict[str, Estimator]:
    return default_classifiers(ENSEMBLE_FOREST, ENSEMBLE_LOGISTIC, ENSEMBLE_BOOSTING)


@dataclass
class Trained:
    """One fitted model with its figures. `model` scores cleaned text on its own."""

    name: str
    order: int
    model: PipelineModel
    auc: float
    accuracy: float
    cv_auc: float
    params: str


@dataclass
class Prepared:
    """Fitted preprocessing and the vectors it made of both sets."""

    model: PipelineModel
    train: DataFrame
    test: DataFrame


def _fold_column(df: DataFrame, folds: int) -> DataFrame:
    """Folds by the id's hash: the same whatever the partitioning."""
    return df.withColumn("fold", hash_bucket(F.col("id"), folds).cast("int"))


def prepare(
    train: DataFrame,
    test: DataFrame,
    dimensions: int = TFIDF_DIMENSIONS,
    folds: int = FOLDS,
    fit_on: DataFrame | None = None,
) -> Prepared:
    """Fit the preprocessing on the training rows, or on `fit_on` to let unlabelled
    or test rows shape the weights, and apply it to both sets."""
    vectors = lambda df: materialise(
        _fold_column(fitted.transform(model_input(df)).select("id", LABEL, FEATURES), folds)
    )
    if fit_on is None:
        fitted, of_train = fitted_preprocessing(train, dimensions, folds)
    else:
        fitted = preprocessing(train.sparkSession, dimensions).fit(model_input(fit_on))
        of_train = vectors(train)
    return Prepared(fitted, of_train, vectors(test))


def auc_evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")


def cross_fit(classifier: Estimator, train: DataFrame, folds: int, parallelism: int) -> tuple[Model, float]:
    """What `cross_validate` makes of one classifier without a grid. The vectors are
    materialised, so no fold of them is kept once more; boosted trees of all folds grow
    together."""
    there = {r.fold for r in train.select("fold").distinct().collect()}
    for k in range(folds):
        if not there - {k}:
            raise ValueError(f"The training data at fold {k} is empty.")
        if k not in there:
            raise ValueError(f"The validation data at fold {k} is empty.")
    in_thread = inheritable_thread_target(train.sparkSession)
    fit = lambda k: classifier.copy().fit(train if k is None else train.filter(F.col("fold") != k))
    auc = lambda k: auc_evaluator().evaluate(models[k].transform(train.filter(F.col("fold") == k)))
    with ThreadPool(parallelism) as pool:
        models = (
            boost(classifier, train, folds)
            if can_boost(classifier)
            else pool.map(in_thread(fit), [*range(folds), None], chunksize=1)
        )
        return models[-1], sum(pool.map(in_thread(auc), range(folds), chunksize=1)) / folds


def cross_validate(
    estimator: Estimator, train: DataFrame, grid: list | None, folds: int, parallelism: int
) -> tuple[Model, float]:
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid or ParamGridBuilder().build(),
        evaluator=auc_evaluator(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=SEED,
    )
    fitted = validator.fit(train)
    return fitted.bestModel, float(max(fitted.avgMetrics))


def train_models(
    train: DataFrame,
    test: DataFrame,
    classifiers: dict[str, Estimator] | None = None,
    grids: dict[str, list] | None = None,
    dimensions: int = TFIDF_DIMENSIONS,
    folds: int = FOLDS,
    parallelism: int = FOLDS,
    preprocess_per_fold: bool = False,
    fit_on: DataFrame | None = None,
) -> list[Trained]:
    """Cross-validate and test each classifier, all at once and `parallelism` folds of each
    side by side: while one waits for its slowest task another has work. With
    `preprocess_per_fold` the whole pipeline is refitted in every fold, at many times the
    cost."""
    prepared = prepare(train, test, dimensions, folds, fit_on)
    raw = _fold_column(model_input(train), folds) if preprocess_per_fold else None

    def trained(order: int, name: str, classifier: Estimator) -> Trained:
        grid = (grids or {}).get(name)
        if raw is not None:
            stages = preprocessing(train.sparkSession, dimensions).getStages()
            best, cv_auc = cross_validate(
                Pipeline(stages=[*stages, classifier]), raw, grid, folds, parallelism
            )
            model, scored = best, best.transform(model_input(test))
        else:
            if grid:
                best, cv_auc = cross_validate(classifier, prepared.train, grid, folds, parallelism)
            else:
                best, cv_auc = cross_fit(classifier, prepared.train, folds, parallelism)
            model = PipelineModel(stages=[*prepared.model.stages, best])
            scored = best.transform(prepared.test)
        auc = auc_evaluator().evaluate(scored)
        accuracy = MulticlassClassificationEvaluator(
            labelCol=LABEL, predictionCol="prediction", metricName="accuracy"
        ).evaluate(scored)
        params = {p.name: v for p, v in model.stages[-1].extractParamMap().items()}
        return Trained(name, order, model, auc, accuracy, cv_auc, json.dumps(params, default=str))

    wanted = [(order, *item) for order, item in enumerate((classifiers or default_classifiers()).items())]
    # Threads only wait for Spark's jobs; each has the session's properties.
    with ThreadPool(len(wanted)) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(lambda x: trained(*x)), wanted)


def best_of(results: Sequence[Trained]) -> Trained | None:
    """Highest AUC above 0; among equals the first trained."""
    ranked = sorted((r for r in results if r.auc > 0), key=lambda r: (-r.auc, r.order))
    return ranked[0] if ranked else None


def run_rows(spark: SparkSession, results: Sequence[Trained]) -> DataFrame:
    """The training log, one row per model."""
    rows = [(r.name, r.order, r.auc, r.accuracy, r.cv_auc, r.params) for r in results]
    schema = "model STRING, position INT, auc DOUBLE, accuracy DOUBLE, cv_auc DOUBLE, params STRING"
    return spark.createDataFrame(rows, schema).withColumn("trained_at", F.current_timestamp())


def train_ensemble(
    train: DataFrame,
    classifiers: dict[str, Estimator] | None = None,
    dimensions: int = TFIDF_DIMENSIONS,
) -> tuple[PipelineModel, list[str]]:
    """Three classifiers over one preprocessing, chained into one model in which each
    writes columns of its own."""
    fitted, vectors = fitted_preprocessing(train, dimensions)
    names, stages = [], []
    for name, classifier in (classifiers or ensemble_classifiers()).items():
        named = classifier.copy(
            {
                classifier.predictionCol: f"{name}_prediction",
                classifier.probabilityCol: f"{name}_probability",
                classifier.rawPredictionCol: f"{name}_raw",
            }
        )
        stages.append(named.fit(vectors))
        names.append(name)
    return PipelineModel(stages=[*fitted.stages, *stages]), names


def ensemble_vote(model: PipelineModel, names: Sequence[str], df: DataFrame) -> DataFrame:
    """All voters run over the same row; see `majority_vote`."""
    scored = model.transform(model_input(df))
    sure = {f"{n}_confidence": class_confidence(f"{n}_probability", f"{n}_prediction") for n in names}
    return majority_vote(
        scored.withColumns(sure), [(f"{n}_prediction", f"{n}_confidence") for n in names]
    )


def _importances(model: PipelineModel) -> tuple[bool, list[float]]:
    last = model.stages[-1]
    linear = hasattr(last, "coefficients")
    return linear, [float(v) for v in (last.coefficients if linear else last.featureImportances).toArray()]


def text_importance(model: PipelineModel, terms: DataFrame) -> DataFrame:
    """(bucket, importance, weight, terms) for each hashed text dimension that the model
    leans on, largest first, with the commonest terms that fall into it from
    `frequencies.bucket_terms`. Their importances add up to the one row that
    `feature_importance` has for text."""
    linear, values = _importances(model)
    rows = [(k, abs(v), v if linear else None) for k, v in enumerate(values[len(S.NUMERIC_FEATURES) :]) if v]
    found = terms.sparkSession.createDataFrame(rows, "bucket INT, importance DOUBLE, weight DOUBLE")
    named = terms.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("ranked"))
    named = named.select("bucket", F.col("ranked.term").alias("terms"))
    return found.join(named, "bucket", "left").orderBy(F.col("importance").desc(), "bucket")


def feature_importance(model: PipelineModel) -> DataFrame:
    """(feature, importance, weight), largest first. The hashed text dimensions are
    added up into one row. `weight` is the signed coefficient of a linear model."""
    linear, values = _importances(model)
    n = len(S.NUMERIC_FEATURES)
    rows = [
        (name, abs(v), v if linear else None) for name, v in zip(S.NUMERIC_FEATURES, values[:n])
    ]
    rows.append(("tfidf_features", float(sum(abs(v) for v in values[n:])), None))
    spark = SparkSession.getActiveSession()
    schema = "feature STRING, importance DOUBLE, weight DOUBLE"
    return spark.createDataFrame(rows, schema).orderBy(F.col("importance").desc(), "feature")


def save_model(model: PipelineModel, path: str, results: Sequence[Trained], best: str) -> None:
    """The model, and beside it one row of metadata."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    metadata = run_rows(spark, results).withColumn("best", F.col("model") == best)
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
