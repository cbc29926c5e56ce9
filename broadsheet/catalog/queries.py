"""One named query per operator, over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from broadsheet.catalog import adapters as A
from broadsheet.functions import text as X
from broadsheet.functions.features import has_author
from broadsheet.operators import bronze as B
from broadsheet.operators import evaluation as E
from broadsheet.operators import gold as G
from broadsheet.operators import monitoring as M
from broadsheet.operators import predictions as P
from broadsheet.operators import quality as Q
from broadsheet.operators import silver as V
from broadsheet.operators import splits as L
from broadsheet.operators import terms as T
from broadsheet.operators.scoring import model_input, score
from broadsheet.plans import training
from broadsheet.plans.lake import Lake
from broadsheet.session import ensure_checkpoint_dir, materialise
from broadsheet.sources.envelope import (
    ingest_counts,
    keyed_messages,
    publish,
    to_envelope,
    union_sources,
)
from broadsheet.sources.feeds import landing_stream
from broadsheet.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DIGITS = 6
T_EVENT = StructType([StructField("id", LongType()), StructField("k", LongType())])


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only keeps the
    name from hiding an import."""
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


def _comparable(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, doubles rounded, instants as text, so that two engines
    can be compared value by value."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(field.name), field.dataType.typeName()
        if kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind in ("double", "float"):
            c = F.round(c, DIGITS)
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(field.name))
    return df.select(*out)


# -- sources ---------------------------------------------------------------


@query
def social_normalise(spark, sf):
    return A.social(spark, sf).select(
        "id", "source", "source_type", "content", "author", "engagement.likes", "engagement.shares",
        "engagement.comments",
    )


@query
def labelled_normalise(spark, sf):
    return A.labelled(spark, sf).select("id", "source", "source_type", "title", "content", "label")


@query
def content_hash(spark, sf):
    return A.news(spark, sf).select("doc_id", "id")


@query
def source_union(spark, sf):
    return union_sources(*A.all_sources(spark, sf)).groupBy("source_type").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("distinct_ids")
    )


@query
def keyed_envelope(spark, sf):
    messages = keyed_messages(union_sources(*A.all_sources(spark, sf)))
    record = B.from_json_text(F.col("value"))
    return messages.select("key", record.alias("r")).select("key", "r.title", "r.source")


@query
def ingest_counts_(spark, sf):
    return ingest_counts(union_sources(*A.all_sources(spark, sf)))


@query
def json_decode(spark, sf):
    """Every event's properties as a message with an id."""
    events = A.table(spark, sf, "events").select(
        F.concat(F.lit('{"id":'), "event_id", F.lit(","), F.substr("props", F.lit(2))).alias("value")
    )
    decoded = B.good(B.decode(events, T_EVENT))
    return decoded.select(F.col("id").alias("event_id"), "k")


# -- silver ----------------------------------------------------------------


@query
def silver_filter(spark, sf):
    return V.usable(A.news(spark, sf)).select("doc_id")


@query
def strip_tags(spark, sf):
    return V.clean(A.html_news(spark, sf)).select("page_id", "title_cleaned", "content_cleaned")


@query
def text_lengths(spark, sf):
    return _comparable(
        V.measure(V.clean(A.news(spark, sf))).select("doc_id", "word_count", "char_count")
    )


@query
def has_author_(spark, sf):
    return _comparable(
        A.news(spark, sf).select("doc_id", has_author(F.col("author")).alias("has_author"))
    )


@query
def dedup_by_id(spark, sf):
    return V.deduplicate(A.news(spark, sf).select("id", "doc_id"), order=["doc_id"])


@query
def silver(spark, sf):
    return _comparable(A.silver(spark, sf).drop("silver_timestamp"))


@query
def incremental_new_ids(spark, sf):
    return V.new_ids(A.silver(spark, sf).select("id"), A.known_ids(spark, sf))


# -- gold ------------------------------------------------------------------


@query
def gold_features(spark, sf):
    return _comparable(A.gold(spark, sf))


@query
def features_documented(spark, sf):
    return _comparable(G.profiled(A.silver(spark, sf), "documented"))


@query
def features_serving(spark, sf):
    return _comparable(G.profiled(A.silver(spark, sf), "serving"))


@query
def feature_statistics(spark, sf):
    return _comparable(G.feature_statistics(A.gold(spark, sf)))


@query
def scaled_features(spark, sf):
    return _comparable(G.scaled_features(A.gold(spark, sf)))


# -- text ------------------------------------------------------------------


@query
def token_counts(spark, sf):
    return _comparable(T.token_counts(T.tokenised(A.silver(spark, sf))))


@query
def stopword_filtered(spark, sf):
    return _comparable(T.token_counts(T.tokenised(A.silver(spark, sf), drop_stop_words=True)))


@query
def top_phrases_by_label(spark, sf):
    return _comparable(T.top_terms_by_label(T.phrased(A.silver(spark, sf))))


@query
def term_tfidf(spark, sf):
    return _comparable(T.term_tfidf(T.tokenised(A.silver(spark, sf), drop_stop_words=True)))


@query
def top_terms_by_label(spark, sf):
    return _comparable(T.top_terms_by_label(T.tokenised(A.silver(spark, sf), drop_stop_words=True)))


# -- quality ---------------------------------------------------------------


@query
def quality_bronze(spark, sf):
    return Q.quality_bronze(A.news(spark, sf))


@query
def quality_silver(spark, sf):
    return _comparable(Q.quality_silver(A.silver(spark, sf)))


@query
def label_distribution(spark, sf):
    return Q.label_distribution(A.gold(spark, sf))


@query
def quality_report(spark, sf):
    return _comparable(
        Q.quality_report(A.news(spark, sf), A.silver(spark, sf), A.gold(spark, sf))
    )


@query
def source_distribution(spark, sf):
    return Q.source_distribution(A.silver(spark, sf))


@query
def layer_flow(spark, sf):
    return Q.layer_flow(A.news(spark, sf), A.silver(spark, sf), A.gold(spark, sf))


# -- splits ----------------------------------------------------------------


def _labelled_ids(spark, sf):
    return L.labelled_only(A.gold(spark, sf)).select("id", "label")


@query
def labelled_only(spark, sf):
    return _labelled_ids(spark, sf)


@query
def random_split(spark, sf):
    return L.random_split(_labelled_ids(spark, sf)).select("id", "split")


@query
def hash_split(spark, sf):
    return L.hash_split(_labelled_ids(spark, sf)).select("id", "split")


@query
def stratified_split(spark, sf):
    return L.stratified_split(_labelled_ids(spark, sf)).select("id", "split")


@query
def split_counts(spark, sf):
    return L.split_counts(L.hash_split(_labelled_ids(spark, sf)))


# -- evaluation and voting -------------------------------------------------


@query
def label_index(spark, sf):
    return _labelled_ids(spark, sf).select(
        "id", "label", E.label_index(F.col("label")).alias("label_index")
    )


@query
def auc_rank(spark, sf):
    scored = (
        A.table(spark, sf, "documents")
        .select("doc_id", F.col("n_chars").alias("score"))
        .join(A.table(spark, sf, "labels"), "doc_id")
        .select("score", (F.col("quality") == 1).alias("positive"))
    )
    return _comparable(E.auc_by_rank(scored))


def _voted(spark, sf, labelled=False):
    gold = A.gold(spark, sf)
    return E.majority_vote(A.voters(L.labelled_only(gold) if labelled else gold), A.VOTERS)


@query
def majority_vote(spark, sf):
    return _comparable(_voted(spark, sf).select("id", "vote", "confidence"))


def _judged(spark, sf):
    return _voted(spark, sf, labelled=True).select("label", E.label_name(F.col("vote")).alias("prediction"))


@query
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_judged(spark, sf))


@query
def classification_metrics(spark, sf):
    return _comparable(E.classification_metrics(_judged(spark, sf)))


@query
def ensemble_accuracy(spark, sf):
    return _comparable(E.accuracy(_judged(spark, sf), "label", "prediction"))


# -- requests and reuse ----------------------------------------------------


@query
def content_preview(spark, sf):
    return A.news(spark, sf).select("doc_id", X.preview(F.col("content")).alias("content_preview"))


@query
def validate_requests(spark, sf):
    gaps = A.news(spark, sf).withColumns(
        {
            "content": F.when(F.col("doc_id") % 7 != 0, F.col("content")),
            "source": F.when(F.col("doc_id") % 5 != 0, F.col("source")),
        }
    )
    return P.validate_requests(gaps).select("doc_id", "ok", "title", "author", "source")


def _reuse_as_of():
    return F.lit(A.REUSE_AS_OF).cast("timestamp_ntz")


@query
def unscored_content(spark, sf):
    return P.unscored(
        A.articles(spark, sf), A.prior_predictions(spark, sf), _reuse_as_of(), key="doc_id"
    ).select("doc_id", "content_hash")


@query
def reused_predictions(spark, sf):
    return P.reused(
        A.articles(spark, sf), A.prior_predictions(spark, sf), _reuse_as_of(), key="doc_id"
    ).select("doc_id", "content_hash", "prediction", "confidence")


@query
def latest_labels(spark, sf):
    return _comparable(P.latest_labels(*A.label_batches(spark, sf)))


# -- monitoring ------------------------------------------------------------


@query
def predictions_daily(spark, sf):
    return _comparable(M.predictions_daily(A.predictions(spark, sf)))


@query
def recent_predictions(spark, sf):
    return _comparable(M.recent_predictions(A.predictions(spark, sf)))


@query
def hourly_trend(spark, sf):
    return _comparable(M.hourly_trend(A.predictions(spark, sf)))


@query
def latency_by_component(spark, sf):
    return _comparable(M.latency_by_component(A.predictions(spark, sf)))


@query
def prediction_rate(spark, sf):
    return _comparable(M.rate(A.predictions(spark, sf), "analyzed_at", M.HOUR))


@query
def prediction_rate_minute(spark, sf):
    return _comparable(M.rate(A.predictions(spark, sf), "analyzed_at", M.MINUTE))


@query
def prediction_rate_sliding(spark, sf):
    return _comparable(M.sliding_rate(A.predictions(spark, sf), "analyzed_at"))


@query
def ingest_throughput(spark, sf):
    return _comparable(M.ingest_throughput(A.table(spark, sf, "events"), "ts"))


# -- models ----------------------------------------------------------------


def _vector_summary(df: DataFrame, vector: str) -> DataFrame:
    values = F.col("_values")
    return _comparable(
        df.select("id", vector_to_array(vector).alias("_values")).select(
            "id",
            F.size(F.filter(values, lambda v: v != 0)).alias("n_nonzero"),
            F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("total"),
            # Which dimension holds which value; large, so fewer digits compare.
            F.round(
                F.aggregate(F.transform(values, lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v), 2
            ).alias("checksum"),
        )
    )


@query
def hashing_tf(spark, sf):
    """The counting stages have nothing to fit."""
    counting = PipelineModel(stages=training.text_stages()[:-1])
    return _vector_summary(counting.transform(A.silver(spark, sf)), "term_counts")


@query
def tfidf_vectors(spark, sf):
    rows = materialise(A.silver(spark, sf).select("id", "content_cleaned"))
    return _vector_summary(training.text_pipeline().fit(rows).transform(rows), "tfidf_features")


@query
def numeric_vector(spark, sf):
    rows = training.numeric_assembler().transform(model_input(A.gold(spark, sf)))
    values = F.col("_values")
    return _comparable(
        rows.select("id", vector_to_array("numeric_features").alias("_values")).select(
            "id",
            F.size(values).alias("size"),
            F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("total"),
        )
    )


@query
def score_documents(spark, sf):
    """Fit the logistic model on the train side, then score every article."""
    rows, train, _ = _sides(spark, sf)
    stages = training.preprocessing(spark).getStages()
    classifier = training.default_classifiers()["logistic_regression"]
    model = Pipeline(stages=[*stages, classifier]).fit(model_input(train))
    return score(rows.drop("label"), model, as_of=A.AS_OF).select("id", "prediction", "confidence")


def _sides(spark, sf, scored=True):
    """All articles, and the labelled ones of either side; only these are kept apart."""
    rows = G.numeric_gold(A.silver(spark, sf), "content_cleaned")
    if scored:
        # Made once: whoever scores all articles reads them again.
        rows = materialise(rows)
    split = materialise(L.hash_split(L.labelled_only(rows)))
    side = lambda name: split.filter(F.col("split") == name).drop("split")
    return rows, side(L.TRAIN), side(L.TEST)


@query
def model_runs(spark, sf):
    """Cross-validate and test the three classifiers."""
    _, train, test = _sides(spark, sf, scored=False)
    results = training.train_models(train, test)
    return _comparable(training.run_rows(spark, results).select("model", "auc", "accuracy", "cv_auc"))


@query
def ensemble_documents(spark, sf):
    """Three fitted voters over every article."""
    rows, train, _ = _sides(spark, sf)
    model, names = training.train_ensemble(train)
    voted = training.ensemble_vote(model, names, rows.drop("label"))
    return _comparable(
        voted.select("id", E.label_name(F.col("vote")).alias("prediction"), "confidence")
    )


@query
def feature_weights(spark, sf):
    """Which features a forest leans on."""
    _, train, _ = _sides(spark, sf)
    stages = training.preprocessing(spark).getStages()
    forest = training.default_classifiers()["random_forest"]
    model = Pipeline(stages=[*stages, forest]).fit(model_input(train))
    return _comparable(training.feature_importance(model).select("feature", "importance"))


# -- streams ---------------------------------------------------------------


def _scratch_lake(spark: SparkSession) -> Lake:
    """A lake of its own for each run, in the folder all executors share."""
    return Lake(f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}")


def _landed(spark, sf):
    """The news table as messages on the feed, and a lake to stream it into."""
    lake = _scratch_lake(spark)
    publish(to_envelope(A.news(spark, sf), A.AS_OF), path=f"{lake.root}/topic")
    return landing_stream(spark, f"{lake.root}/topic"), lake


@query
def stream_to_bronze(spark, sf):
    messages, lake = _landed(spark, sf)
    feed.to_bronze(messages, lake, trigger=None, as_of=A.AS_OF).awaitTermination()
    return lake.read(spark, "bronze").select(
        "id", "source", F.col("source_type").cast("string"), "title", "label",
        F.col("bronze_date").cast("string"),
    )


@query
def stream_to_silver(spark, sf):
    messages, lake = _landed(spark, sf)
    records = B.good(B.decode(messages))
    feed.to_silver(records, lake, trigger=None, as_of=A.AS_OF).awaitTermination()
    return _comparable(lake.read(spark, "silver").drop("silver_timestamp"))


@query
def stream_dedup(spark, sf):
    messages, lake = _landed(spark, sf)
    once = feed.deduplicated(B.good(B.decode(messages))).select("id")
    out = f"{lake.root}/ids"
    writer = once.writeStream.format("parquet").option("checkpointLocation", lake.checkpoint("ids"))
    writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


def _prediction_stream(spark, sf):
    schema = A.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    # A watermark needs an instant, not a wall-clock time.
    return A.as_predictions(events).withColumn("analyzed_at", F.col("analyzed_at").cast("timestamp"))


@query
def live_predictions_daily(spark, sf):
    lake = _scratch_lake(spark)
    figure = _comparable(feed.live_daily(_prediction_stream(spark, sf)))
    feed.to_counters(figure, lake, "daily", trigger=None).awaitTermination()
    return feed.read_counters(spark, lake, "daily", "day")


@query
def live_hourly_trend(spark, sf):
    lake = _scratch_lake(spark)
    figure = _comparable(feed.live_hourly(_prediction_stream(spark, sf)))
    feed.to_counters(figure, lake, "hourly", trigger=None).awaitTermination()
    return feed.read_counters(spark, lake, "hourly", "hour")
