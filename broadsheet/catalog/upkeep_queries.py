"""Queries through what keeps the lake's tables in order: the index of ids, manifests and
compaction, bronze by day, figures from partial aggregates, and reuse on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.catalog import adapters as A
from broadsheet.catalog import oracle as O
from broadsheet.catalog.lake_queries import SQL as LAKE_SQL
from broadsheet.catalog.queries import _comparable, _scratch_lake, _vector_summary
from broadsheet.operators import associations, frequencies
from broadsheet.operators import silver as V
from broadsheet.operators.scoring import score
from broadsheet.plans import bronze_days, id_index, jobs, training
from broadsheet.session import materialise
from broadsheet.sources import feeds
from broadsheet.sources.envelope import publish, to_envelope
from broadsheet.sources.feeds import landing_stream
from broadsheet.streaming import feed, figures

REGISTRY = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        REGISTRY[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query("""SELECT md5(url || trim(html, chr(9) || chr(10) || chr(13) || ' ')) AS id,
  trim(html, chr(9) || chr(10) || chr(13) || ' ') AS content, url FROM pages""")
def rss_markup(spark, sf):
    """Whole pages, markup, entities and all, as the descriptions of RSS items in XML files;
    white space around them is not part of a description."""
    items = A.table(spark, sf, "pages").select(F.col("url").alias("title"), F.col("url").alias("link"), F.col("html").alias("description"))
    path = f"{_scratch_lake(spark).root}/rss"
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    # Cut from the files, which give no row to a query of the broken ones' column alone.
    items = materialise(feeds.read_rss(spark, path).withColumn("source", F.lit("wire")))
    rows = feeds.rss_items(items, A.AS_OF)
    blanks = F.lit("\t\n\r ")
    return rows.select(F.md5(F.concat("url", F.trim("content", blanks))).alias("id"), F.trim("content", blanks).alias("content"), "url")


@query(O.SQL["labelled_normalise"])
def labelled_csv(spark, sf):
    """Labelled documents written as CSV, quotes and line breaks in them, and read by the
    reader of labelled files."""
    rows = A.table(spark, sf, "documents").join(A.table(spark, sf, "labels"), "doc_id").select(
        F.substring_index("text", "\n", 1).alias("title"), "text", F.when(F.col("quality") == 1, "real").otherwise("fake").alias("label")
    )
    path = f"{_scratch_lake(spark).root}/csv"
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    articles = feeds.labelled_articles(feeds.read_labelled_csv(spark, path, multi_line=True), as_of=A.AS_OF)
    return articles.select("id", "source", "source_type", "title", "content", "label")


def _dealt(df: DataFrame, key: str, n: int) -> list[DataFrame]:
    """The rows in `n` batches, by a hash of `key`."""
    return [df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == k) for k in range(n)]


@query(O.SQL["incremental_new_ids"])
def indexed_new_ids(spark, sf):
    """Silver as it stood half a month in, added in four batches; then all ids are asked
    for in its index."""
    lake = _scratch_lake(spark)
    earlier = A.news(spark, sf).filter(F.col("bronze_date") <= "2024-01-15")
    for k, batch in enumerate(_dealt(earlier, "id", 4)):
        jobs.append_new_silver(spark, lake, to_envelope(batch, A.AS_OF), A.AS_OF, "load", k)
    table = lake.snapshots(spark, "silver")
    id_index.merge_runs(table, 2)
    ids = A.silver(spark, sf).select("id")
    return V.new_ids(ids, id_index.known(table, table.current(), ids))


# Of so many equal shares of all rows these are batches of their own; the rest is one.
SMALL_SHARES, SMALL_BATCHES = 64, range(7)


@query(LAKE_SQL["compaction_rows"])
def compaction_partial(spark, sf):
    """Silver of one large batch and many small ones, of which only the small files are
    written anew; read as it was before and as it is after."""
    lake = _scratch_lake(spark)
    records, n = to_envelope(A.news(spark, sf), A.AS_OF), len(SMALL_BATCHES)
    share = F.pmod(F.xxhash64("id"), F.lit(SMALL_SHARES))
    jobs.append_new_silver(spark, lake, records.filter(share >= n), A.AS_OF, "stream", 0)
    table = lake.snapshots(spark, "silver")
    files = lambda: {f"{u.folder}/{name}": size for u, name, size in table.files(table.current())}
    first = files()
    for k in SMALL_BATCHES:
        jobs.append_new_silver(spark, lake, records.filter(share == k), A.AS_OF, "stream", k + 1)
    began = lake.read(spark, "silver")
    # However many files a batch was written in, all but those of the large one are small.
    closed = [u for u in table.current().units() if u.batch < n]
    small = [size for u, _, size in table.files(table.current()) if u in closed and u.batch]
    target = 2 * (max(small, default=0) + 1)
    large = {name for name, size in first.items() if 2 * size >= target}
    before, after = table.compact(target_bytes=target)
    if (len(small) > 1 and after >= before) or not large <= files().keys():
        raise RuntimeError(f"compaction left {after} of {before} files or wrote large ones")
    own = ["id", "source", "label", "word_count"]
    now = lake.read(spark, "silver").select(*own)
    lost = now.exceptAll(began.select(*own)).unionAll(began.select(*own).exceptAll(now))
    if not lost.isEmpty():
        raise RuntimeError("compaction changed rows")
    return _comparable(now)


@query(f"{O._BASE} SELECT id, source, source_type, count(*) AS n FROM news GROUP BY ALL")
def bronze_merged(spark, sf):
    """Bronze from a stream of six batches and one that was played again, after its closed
    batches moved into files by day."""
    lake = _scratch_lake(spark)
    records = to_envelope(A.news(spark, sf), A.AS_OF)
    publish(records.repartition(6), path=f"{lake.root}/topic")
    messages = landing_stream(spark, f"{lake.root}/topic", max_files_per_trigger=1)
    feed.to_bronze(messages, lake, trigger=None, as_of=A.AS_OF).awaitTermination()
    if jobs.run_bronze_upkeep(spark, lake) == 0:
        raise RuntimeError("no batch was moved")
    days, bronze = lake.bronze_days(spark), lake.path("bronze")
    writer, batch = min(bronze_days.batches(days, bronze))
    # Its folder is still there for readers that have begun.
    again = materialise(bronze_days.read_folders(spark, bronze, [(writer, batch)]).select(*records.columns))
    jobs.write_bronze_batch(again, lake, writer, batch, A.AS_OF)
    jobs.run_bronze_upkeep(spark, lake)
    rows = lake.read(spark, "bronze")
    return rows.groupBy("id", "source", F.col("source_type").cast("string")).agg(F.count("*").alias("n"))


def _measured(spark, sf):
    """A lake whose layers were measured in five batches each, one of them twice."""
    lake = _scratch_lake(spark)
    layers = {"bronze": A.news(spark, sf), "silver": A.silver(spark, sf), "gold": A.gold(spark, sf)}
    for layer, rows in layers.items():
        rows = materialise(rows)
        for k, batch in enumerate(_dealt(rows, "id", 5)):
            jobs.add_quality_part(batch, lake, layer, "load", k)
        jobs.add_quality_part(batch, lake, layer, "load", k)
    return lake


@query(O.SQL["quality_report"])
def quality_from_parts(spark, sf):
    return _comparable(jobs.quality_from_parts(spark, _measured(spark, sf)))


@query(O.SQL["feature_statistics"])
def statistics_from_parts(spark, sf):
    return _comparable(jobs.statistics_from_parts(spark, _measured(spark, sf)).drop("quantiles"))


@query(O.SQL["tfidf_vectors"])
def idf_from_parts(spark, sf):
    """TF-IDF vectors under weights from the document frequencies of five batches, one of
    which was counted twice and withdrawn once."""
    lake, silver = _scratch_lake(spark), materialise(A.silver(spark, sf))
    for k, batch in enumerate(_dealt(silver, "id", 5)):
        jobs.add_frequencies(batch, lake, "load", k)
    jobs.add_frequencies(batch, lake, "again", 0)
    jobs.add_frequencies(batch, lake, "again", 1, withdrawn=True)
    return _vector_summary(jobs.text_from_parts(spark, lake).transform(silver.select("id", "content_cleaned")), "tfidf_features")


@query(f"""{O._SILVER}, {O._TOKENS}, {O._TFIDF}, {O._BUCKETS}, ranks AS (
  SELECT b.bucket, d.term, d.df, row_number() OVER (PARTITION BY b.bucket ORDER BY d.df DESC, d.term) AS rank
  FROM df d JOIN buckets b ON d.term = b.term
)
SELECT bucket::BIGINT AS bucket, rank, term, df FROM ranks WHERE rank <= 5""")
def bucket_terms(spark, sf):
    """The commonest terms of each hashed dimension."""
    return _comparable(frequencies.bucket_terms(A.silver(spark, sf), training.TFIDF_DIMENSIONS))


@query(f"""{O._SILVER}, {O._TOKENS}, pairs AS (
  SELECT words[i] AS a, words[i + 1] AS b FROM tokens, unnest(range(1, len(words))) AS t(i)
  WHERE words[i] <> '' AND words[i + 1] <> ''
), counts AS (
  SELECT a, b, count(*)::DOUBLE AS ab FROM pairs GROUP BY a, b HAVING count(*) >= 5
), firsts AS (
  SELECT a, count(*)::DOUBLE AS n FROM pairs GROUP BY a
), seconds AS (
  SELECT b, count(*)::DOUBLE AS n FROM pairs GROUP BY b
), cells AS (
  SELECT c.a AS first, c.b AS second, ab, f.n - ab AS a_only, s.n - ab AS b_only,
    (SELECT count(*) FROM pairs)::DOUBLE - f.n - s.n + ab AS neither, f.n AS fn, s.n AS sn,
    (SELECT count(*) FROM pairs)::DOUBLE AS total
  FROM counts c JOIN firsts f ON c.a = f.a JOIN seconds s ON c.b = s.b
), scored AS (
  SELECT first, second, ab, ab * total > fn * sn AS more, 2 * (
    ab * ln(ab * total / (fn * sn))
    + CASE WHEN a_only > 0 THEN a_only * ln(a_only * total / (fn * (total - sn))) ELSE 0 END
    + CASE WHEN b_only > 0 THEN b_only * ln(b_only * total / ((total - fn) * sn)) ELSE 0 END
    + CASE WHEN neither > 0 THEN neither * ln(neither * total / ((total - fn) * (total - sn))) ELSE 0 END) AS score
  FROM cells
)
SELECT first, second, ab::BIGINT AS n, round(score, 3) AS score FROM scored WHERE more AND score >= 10.83""")
def associated_phrases(spark, sf):
    """Neighbouring words that stand together more often than chance has it."""
    found = associations.associated_phrases(A.silver(spark, sf))
    return found.withColumn("score", F.round("score", 3))


_PLANTED = "CASE WHEN substr(md5('planted' || id), 1, 1) < '8' THEN 'fake' ELSE 'real' END"


_HELD_OUT = "substr(md5('side' || id), 1, 1) < '5'"


@query(f"""{O._SILVER} SELECT unnest(['random_forest', 'logistic_regression', 'gradient_boosting']) AS model,
  count(*) AS tested, true AS learned FROM silver WHERE {_HELD_OUT}""")
def planted_labels(spark, sf):
    """Whether the three classifiers learn a label that is drawn for each article and told
    by words of its text, to nineteen in twenty of those that they have not seen."""
    label = F.expr(_PLANTED)
    told = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.concat(label, F.lit("mark"), k)), " ")
    silver = materialise(A.silver(spark, sf).withColumns({
        "label": label, "content_cleaned": F.concat_ws(" ", "content_cleaned", told),
    }))
    train, test = silver.filter(~F.expr(_HELD_OUT)), silver.filter(_HELD_OUT)
    fitted, vectors = training.fitted_preprocessing(train)
    parts = []
    for name, classifier in training.default_classifiers().items():
        model = training.PipelineModel(stages=[*fitted.stages, classifier.fit(vectors)])
        said = score(test.drop("label"), model, as_of=A.AS_OF).withColumn("hit", F.col("prediction") == label)
        parts.append(said.agg(F.count("*").alias("tested"), (F.avg(F.col("hit").cast("int")) >= 0.95).alias("learned")).withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _prediction_files(spark: SparkSession, sf: str, n: int) -> DataFrame:
    """The prediction log as a stream of `n` files, each from all of its time: whatever
    comes after the first is late."""
    lake = _scratch_lake(spark)
    log = A.predictions(spark, sf).withColumn("analyzed_at", F.col("analyzed_at").cast("timestamp"))
    log.repartition(n, F.xxhash64("id")).write.parquet(f"{lake.root}/log")
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{lake.root}/log")


@query(O.SQL["predictions_daily"])
def late_counters(spark, sf):
    """Daily figures from batches that mostly come late, folded by threes."""
    lake = _scratch_lake(spark)
    figures.to_figure(_prediction_files(spark, sf, 7), lake, "daily", trigger=None, fan=3).awaitTermination()
    return _comparable(figures.read_figure(spark, lake, "daily"))


@query(O.SQL["hourly_trend"])
def late_hourly_trend(spark, sf):
    lake = _scratch_lake(spark)
    figures.to_figure(_prediction_files(spark, sf, 5), lake, "hourly", trigger=None, fan=2).awaitTermination()
    return _comparable(figures.read_figure(spark, lake, "hourly"))


# Files, and so batches, of each stream.
REUSE_FILES = 4


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every document asked for once, at a minute of the day."""
    minute = (F.col("doc_id") * 7 % 1440).cast("int")
    at = F.lit(f"{A.FIRST_DAY} 00:00:00").cast("timestamp") + F.make_dt_interval(mins=minute)
    return A.articles(spark, sf).select(F.col("doc_id").alias("id"), "content_hash", at.alias("requested_at"))


@query(f"""{O._PRIOR}, asked AS (
  SELECT doc_id, content_hash, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id * 7 % 1440 AS INTEGER)) AS at
  FROM articles
), met AS (
  SELECT a.doc_id, p.analyzed_at, p.prediction, p.confidence,
         row_number() OVER (PARTITION BY a.doc_id ORDER BY p.analyzed_at DESC, p.prediction DESC) AS rn
  FROM asked a LEFT JOIN prior p ON a.content_hash = p.content_hash
   AND p.analyzed_at <= a.at AND p.analyzed_at > a.at - INTERVAL 1 HOUR
)
SELECT doc_id AS id, {O._stamp("analyzed_at")} AS analyzed_at, prediction, confidence, prediction IS NOT NULL AS was_reused
FROM met WHERE rn = 1""")
def stream_reuse(spark, sf):
    """A day's requests and predictions as two streams; a row of a later day on each closes it."""
    lake = _scratch_lake(spark)
    prior = A.prior_predictions(spark, sf).withColumn("analyzed_at", F.col("analyzed_at").cast("timestamp"))
    streams = []
    for name, rows, time in (("requests", _requests(spark, sf), "requested_at"), ("prior", prior, "analyzed_at")):
        path = f"{lake.root}/{name}"
        # The batches do not grow in number with the table: each costs all the stores of state.
        rows.repartition(REUSE_FILES).write.parquet(path)
        last = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields}
        last |= {time: F.lit("2024-01-09 00:00:00").cast("timestamp"), "content_hash": F.lit("")}
        spark.range(1).select(*(c.alias(n) for n, c in last.items())).write.mode("append").parquet(path)
        streams.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path))
    out = f"{lake.root}/answers"
    writer = feed.with_reuse(*streams, delay="1 day").writeStream.format("parquet")
    writer.option("checkpointLocation", lake.checkpoint("reuse")).trigger(availableNow=True).start(out).awaitTermination()
    answers = spark.read.parquet(out).filter("id IS NOT NULL")
    return _comparable(answers.select("id", "analyzed_at", "prediction", "confidence", "was_reused"))
