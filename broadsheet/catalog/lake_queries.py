"""Queries through the lake's own jobs: written, read back, and compared in SQL. What SQL
cannot refit, models above all, is checked by what must hold for every row."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.catalog import adapters as A
from broadsheet.catalog import oracle as O
from broadsheet.catalog.queries import _comparable, _landed, _prediction_stream, _scratch_lake, _sides
from broadsheet.functions import text as X
from broadsheet.operators import bronze as B
from broadsheet.operators import evaluation as E
from broadsheet.operators import gold as G
from broadsheet.operators import predictions as P
from broadsheet.operators import splits as L
from broadsheet.operators.scoring import model_input, score
from broadsheet.plans import jobs, training
from broadsheet.plans.compaction import compact
from broadsheet.sources import feeds
from broadsheet.sources.envelope import publish, to_envelope
from broadsheet.streaming import feed

REGISTRY = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        name = fn.__name__.rstrip("_")
        REGISTRY[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _files(spark: SparkSession) -> str:
    return f"{_scratch_lake(spark).root}/files-{uuid.uuid4().hex}"


def _filled(spark, sf, *steps):
    """A lake with the news table in bronze and the jobs of `steps` run on it."""
    lake = _scratch_lake(spark)
    jobs.write_bronze_batch(to_envelope(A.news(spark, sf), A.AS_OF), lake, "load", 0, A.AS_OF)
    for step in steps:
        step(spark, lake)
    return lake


# -- sources: the tables written out as feeds, and read by their readers ------


@query("""SELECT md5(replace(url, 'http', 'page http') || 'about ' || url) AS id, 'wire' AS source, 'rss' AS source_type,
  replace(url, 'http', 'page http') AS title, 'about ' || url AS content, url, CAST(page_id AS VARCHAR) AS guid FROM pages""")
def rss_normalise(spark, sf):
    """Every page as an RSS item, with an element that no schema names."""
    items = A.table(spark, sf, "pages").select(
        F.replace("url", F.lit("http"), F.lit("page http")).alias("title"), F.col("url").alias("link"),
        F.concat(F.lit("about "), "url").alias("description"), F.col("page_id").alias("guid"),
    )
    path = _files(spark)
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    read = feeds.read_rss(spark, path)
    names = read.select(F.element_at(F.split("feed_file", "/"), -1).alias("feed")).distinct()
    named = feeds.name_feeds(read, names.withColumn("source", F.lit("wire")))
    rows = feeds.rss_items(named, A.AS_OF)
    return rows.select(
        "id", "source", "source_type", "title", "content", "url", F.get_json_object("raw_data", "$.xs_any[0]").alias("guid")
    )


@query(f"""{O._BASE} SELECT md5(title || 'lead ' || doc_id) AS id, source, 'news_api' AS source_type, content, url,
  doc_id % 10 AS section FROM news""")
def news_api_normalise(spark, sf):
    """Every document as an article of a response, ten articles to a response, with a
    field that no schema names."""
    news = A.news(spark, sf)
    article = F.struct(
        F.struct(F.col("source").alias("name")).alias("source"), "title",
        F.concat(F.lit("lead "), "doc_id").alias("description"), "content", "url",
        (F.col("doc_id") % 10).alias("section"),
    )
    responses = news.groupBy(F.floor(F.col("doc_id") / 10).alias("n")).agg(F.collect_list(article).alias("articles"))
    path = _files(spark)
    responses.select(F.to_json(F.struct("articles")).alias("value")).write.text(path)
    rows = feeds.api_articles(feeds.read_news_api(spark, path), A.AS_OF)
    section = F.get_json_object("raw_data", "$.section").cast("long").alias("section")
    return rows.select("id", "source", "source_type", "content", "url", section)


@query("SELECT md5('forum' || conv_id || '-' || turn) AS id, text AS content, turn AS reach FROM conversations")
def raw_payload(spark, sf):
    """A field that no schema names survives in the raw record."""
    posts = A.table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "text", F.struct(F.col("turn").alias("views")).alias("reach")
    )
    path = _files(spark)
    posts.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    rows = feeds.social_posts(feeds.read_social(spark, path), "forum", A.AS_OF)
    return rows.select("id", "content", F.get_json_object("raw_data", "$.reach.views").cast("long").alias("reach"))


@query("""SELECT CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'quarantine' ELSE 'bronze' END AS place,
  count(*) AS n FROM events GROUP BY 1""")
def decode_quarantine(spark, sf):
    """Every 11th message broken and every 13th without id; none is lost."""
    event = F.col("event_id")
    whole = F.concat(F.lit('{"id":"'), event, F.lit('","k":1}'))
    value = F.when(event % 11 == 0, F.lit('{"id": ')).when(event % 13 == 0, F.lit('{"k":1}')).otherwise(whole)
    decoded = B.decode(A.table(spark, sf, "events").select(value.alias("value")))
    counts = lambda df, place: df.agg(F.count("*").alias("n")).select(F.lit(place).alias("place"), "n")
    return counts(B.good(decoded), "bronze").union(counts(B.quarantined(decoded), "quarantine"))


@query(f"{O._BASE} SELECT id, '2024-02-01 00:00:00' AS ingestion_timestamp, '2024-02-01' AS bronze_date FROM news")
def ingestion_stamp(spark, sf):
    rows = _filled(spark, sf).read(spark, "bronze")
    return _comparable(rows.select("id", "ingestion_timestamp", "bronze_date"))


# -- the lake's jobs -----------------------------------------------------------


_EARLIEST = O._SILVER.replace("ORDER BY doc_id)", "ORDER BY label IS NULL, source, url)")


@query(f"{O._BASE} SELECT id, count(*) AS n FROM news GROUP BY id")
def bronze_restart(spark, sf):
    """Half of the messages, then the other half by a new checkpoint under one name."""
    lake = _scratch_lake(spark)
    records = to_envelope(A.news(spark, sf), A.AS_OF)
    half = F.pmod(F.xxhash64("url"), F.lit(2))
    for k in (0, 1):
        publish(records.filter(half == k), path=f"{lake.root}/topic-{k}")
        messages = feeds.landing_stream(spark, f"{lake.root}/topic-{k}")
        feed.to_bronze(messages, lake, trigger=None, as_of=A.AS_OF).awaitTermination()
        path = spark._jvm.org.apache.hadoop.fs.Path(lake.checkpoint("feed"))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).rename(path, path.suffix(f"-{k}"))
    return lake.read(spark, "bronze").groupBy("id").agg(F.count("*").alias("n"))


@query(f"{_EARLIEST} SELECT *, '2024-02-01 00:00:00' AS silver_timestamp FROM silver")
def silver_table(spark, sf):
    lake = _filled(spark, sf, lambda s, lk: jobs.run_silver(s, lk, A.AS_OF))
    return _comparable(lake.read(spark, "silver"))


@query(f"{_EARLIEST} SELECT id, source, label, word_count FROM silver")
def compaction_rows(spark, sf):
    """Silver of many small files, compacted."""
    lake = _filled(spark, sf, lambda s, lk: jobs.run_silver(s, lk, A.AS_OF))
    many = lake.read(spark, "silver").repartition(24)
    path = f"{lake.root}/many"
    many.write.parquet(path)
    before, after = compact(spark, path)
    if after >= before:
        raise RuntimeError(f"compaction left {after} of {before} files")
    return _comparable(spark.read.parquet(path).select("id", "source", "label", "word_count"))


_EARLIEST_GOLD = f"{_EARLIEST}, {O.GOLD}"


@query(f"""{_EARLIEST_GOLD} SELECT id, label, word_count, title_length, round(caps_ratio, 6) AS caps_ratio,
  1000::BIGINT AS dimensions, '2024-02-01 00:00:00' AS gold_timestamp FROM gold""")
def gold_table(spark, sf):
    """Gold as its job writes it, by label, with vectors and the time of the run."""
    lake = _filled(spark, sf, jobs.run_silver, lambda s, lk: jobs.run_gold(s, lk, as_of=A.AS_OF))
    rows = jobs.read_gold(spark, lake)
    label = F.nullif("label", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("label")
    size = F.size(vector_to_array("tfidf_features")).alias("dimensions")
    return _comparable(rows.select("id", label, "word_count", "title_length", "caps_ratio", size, "gold_timestamp"))


@query(O._statistics().replace(O._GOLD, _EARLIEST_GOLD))
def statistics_table(spark, sf):
    lake = _filled(spark, sf, jobs.run_silver, jobs.run_gold)
    return _comparable(lake.read(spark, "feature_statistics"))


_SPLIT = f"""{_EARLIEST_GOLD}, {O._LABELLED}, ranked AS (
  SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(id), id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM labelled
)"""


@query(f"""{_SPLIT} SELECT CASE WHEN rn <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS split, id, label FROM ranked""")
def saved_splits(spark, sf):
    """Train and test as the job writes them."""
    lake = _filled(spark, sf, jobs.run_silver, jobs.run_gold, jobs.run_splits)
    sides = [lake.read(spark, t).select(F.lit(t).alias("split"), "id", F.col("label").cast("string")) for t in ("train", "test")]
    return sides[0].unionByName(sides[1])


@query(f"{O._GOLD}, {O._LABELLED} SELECT id, 1::BIGINT AS sides, true AS known FROM labelled")
def random_split_complete(spark, sf):
    """A random split puts every labelled id on one side, and on one only."""
    split = L.random_split(L.labelled_only(A.gold(spark, sf)))
    sides = split.groupBy("id").agg(F.count_distinct("split").alias("sides"), F.bool_and(F.col("split").isin(L.TRAIN, L.TEST)).alias("known"))
    return sides


# -- models ---------------------------------------------------------------------


@query(f"{O._GOLD} SELECT id, 1010::BIGINT AS size, true AS numeric_first FROM gold")
def combined_vector(spark, sf):
    """The vector of all features: the ten numeric ones, then the text's."""
    rows, train, _ = _sides(spark, sf)
    fitted = training.preprocessing(spark).fit(model_input(train))
    out = fitted.transform(model_input(rows.drop("label")))
    values = vector_to_array("all_features")
    same = F.slice(values, 1, 10) == vector_to_array("numeric_features")
    return out.select("id", F.size(values).cast("long").alias("size"), same.alias("numeric_first"))


@query(f"""{O._GOLD}, {O._LABELLED}, {O._HASH_SPLIT}, n AS (SELECT count(*) AS n FROM hash_split WHERE split = 'test')
SELECT unnest(['random_forest', 'logistic_regression', 'gradient_boosting']) AS model, true AS in_range,
  true AS accuracy_matches, n AS tested FROM n""")
def tested_models(spark, sf):
    """The three classifiers at full size: their AUCs are AUCs, and the accuracy that is
    logged is that of the predictions on the test side."""
    _, train, test = _sides(spark, sf)
    out = None
    for r in training.train_models(train, test):
        hits = F.avg((F.col("prediction") == F.col("label_index")).cast("double"))
        scored = r.model.transform(model_input(test)).withColumn(
            "label_index", F.when(F.col("label") == S.FAKE, 1.0).otherwise(0.0)
        )
        row = scored.agg(F.count("*").alias("tested"), hits.alias("accuracy")).select(
            F.lit(r.name).alias("model"), F.lit(0 <= r.auc <= 1 and 0 <= r.cv_auc <= 1).alias("in_range"),
            (F.abs(F.col("accuracy") - r.accuracy) < 1e-9).alias("accuracy_matches"), "tested",
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(f"{O._GOLD} SELECT id, true AS label_known, true AS majority, true AS sure FROM gold")
def ensemble_rows(spark, sf):
    """Every article has a verdict that two of the three voters share, and a confidence."""
    rows, train, _ = _sides(spark, sf)
    model, names = training.train_ensemble(train)
    voted = training.ensemble_vote(model, names, rows.drop("label"))
    votes = sum((F.col(f"{n}_prediction") == F.col("vote")).cast("int") for n in names)
    known = E.label_name(F.col("vote")).isin(*S.LABELS)
    return voted.select(
        "id", known.alias("label_known"), (votes >= 2).alias("majority"), F.col("confidence").between(0.5, 1.0).alias("sure")
    )


@query("SELECT 11::BIGINT AS features, true AS sums_to_one, true AS none_negative")
def importance_total(spark, sf):
    _, train, _ = _sides(spark, sf)
    stages = [*training.preprocessing(spark).getStages(), training.default_classifiers()["random_forest"]]
    rows = training.feature_importance(Pipeline(stages=stages).fit(model_input(train)))
    return rows.agg(
        F.count("*").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
        (F.min("importance") >= 0).alias("none_negative"),
    )


def _fitted(spark, sf):
    rows, train, _ = _sides(spark, sf)
    fitted, vectors = training.fitted_preprocessing(train)
    model = training.default_classifiers()["logistic_regression"].fit(vectors)
    return rows, training.PipelineModel(stages=[*fitted.stages, model])


@query(f"{O._GOLD} SELECT id, true AS label_known, true AS sure, true AS hashed, true AS same_when_loaded FROM gold")
def scored_rows(spark, sf):
    """Every article scored, by the model and by its copy that was saved and loaded."""
    rows, model = _fitted(spark, sf)
    path = f"{_scratch_lake(spark).root}/model"
    model.write().overwrite().save(path)
    own = score(rows.drop("label"), model, as_of=A.AS_OF, keep=["content_cleaned"])
    again = score(rows.drop("label"), training.PipelineModel.load(path), as_of=A.AS_OF)
    again = again.select("id", F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    same = (F.col("p") == F.col("prediction")) & (F.col("c") == F.col("confidence"))
    return own.join(again, "id").select(
        "id", F.col("prediction").isin(*S.LABELS).alias("label_known"), F.col("confidence").between(0.5, 1.0).alias("sure"),
        (F.col("content_hash") == F.md5("content_cleaned")).alias("hashed"), same.alias("same_when_loaded"),
    )


@query(f"{O._BASE} SELECT id, count(*) AS n, true AS label_known FROM news GROUP BY id")
def stream_scoring(spark, sf):
    """The news as a stream of requests through a fitted model."""
    _, model = _fitted(spark, sf)
    messages, lake = _landed(spark, sf)
    requests = B.good(B.decode(messages)).select("id", "content", "title", "url", "author", "source")
    out = f"{lake.root}/scored"
    writer = feed.scored(requests, model, A.AS_OF).writeStream.format("parquet")
    writer = writer.option("checkpointLocation", lake.checkpoint("scored")).trigger(availableNow=True)
    writer.start(out).awaitTermination()
    known = F.bool_and(F.col("prediction").isin(*S.LABELS)).alias("label_known")
    return spark.read.parquet(out).groupBy("id").agg(F.count("*").alias("n"), known)


@query(f"""{O._PRIOR}, recent AS (SELECT DISTINCT content_hash FROM fresh)
SELECT a.doc_id, r.content_hash IS NOT NULL AS was_reused, true AS has_prediction
FROM articles a LEFT JOIN recent r ON a.content_hash = r.content_hash""")
def scored_requests(spark, sf):
    """Every request has an answer with a label of the set: a fresh prediction of its
    content, or one by the fitted model."""
    _, model = _fitted(spark, sf)
    articles, prior = A.articles(spark, sf), A.prior_predictions(spark, sf)
    now = F.lit(A.REUSE_AS_OF).cast("timestamp_ntz")
    texts = A.table(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("content"))
    texts = texts.withColumns({
        "id": F.col("doc_id"), "content_hash": F.md5("content"), "content_cleaned": X.strip_tags(F.col("content")),
        **{c: F.lit(None).cast("string") for c in ("title", "title_cleaned", "url", "author")},
    })
    scored = score(P.unscored_contents(texts, prior, now), model, "content", A.REUSE_AS_OF)
    scored = scored.select("content_hash", "prediction", "confidence", now.alias("analyzed_at"))
    answers = P.answers(articles, scored, prior, now, key="doc_id")
    known = F.coalesce(F.col("prediction").isin(*S.LABELS), F.lit(False))
    return answers.select("doc_id", "was_reused", known.alias("has_prediction"))


# -- streams --------------------------------------------------------------------


@query(O.SQL["prediction_rate_minute"])
def live_rate(spark, sf):
    lake = _scratch_lake(spark)
    figure = _comparable(feed.live_rate(_prediction_stream(spark, sf)))
    feed.to_counters(figure, lake, "rate", trigger=None).awaitTermination()
    return feed.read_counters(spark, lake, "rate", "window_start")
