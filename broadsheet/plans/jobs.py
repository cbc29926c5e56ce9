"""The jobs: the only place where tables are read, written or counted.

Each is a plain function that a scheduler may call. A failure raises; no stage
passes off a broken layer as a finished one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.operators import bronze as B
from broadsheet.operators import frequencies as N
from broadsheet.operators import gold as G
from broadsheet.operators import parts as R
from broadsheet.operators import predictions as P
from broadsheet.operators import quality as Q
from broadsheet.operators import silver as V
from broadsheet.operators import splits as L
from broadsheet.operators.joins import broadcast_if_few
from broadsheet.operators.scoring import request_articles, score
from broadsheet.plans import bronze_days, training
from broadsheet.plans import id_index as I
from broadsheet.plans.lake import Lake
from broadsheet.plans.snapshots import DATA, Snapshot
from broadsheet.session import input_bytes, materialise, size_for
from broadsheet.sources.envelope import CORRUPT, broken
from broadsheet.sources.tables import balanced, write_table

# Tables of more files than this are compacted.
FEW_FILES = 1_000


def write_bronze_batch(
    records: DataFrame, lake: Lake, writer: str, batch_id: int, as_of: str | None = None
) -> None:
    """One unit of arrivals into its own folder, which a re-run overwrites. The
    writer's name keeps apart streams and jobs that each count batches from 0.
    The source is no partition column, as there is no bound on how many there are."""
    folder = f"{lake.path('bronze')}/writer={writer}/batch_id={batch_id}"
    write_table(B.stamp(records, as_of), folder, "overwrite", bronze_days.PARTITIONS, lake.fmt)
    if lake.fmt == "parquet":
        bronze_days.played_again(lake.bronze_days(records.sparkSession), writer, batch_id)


def write_quarantine_batch(texts: DataFrame, lake: Lake, writer: str, batch_id: int) -> None:
    """Messages or records that could not be read, as text; no file where there are none."""
    if texts.isEmpty():
        return
    folder = f"{lake.path('quarantine')}/writer={writer}/batch_id={batch_id}"
    write_table(texts, folder, "overwrite", (), lake.fmt)


def land(
    read: DataFrame, normalise: Callable[[DataFrame], DataFrame], lake: Lake, writer: str,
    batch_id: int, as_of: str | None = None,
) -> None:
    """Files of one source, as its reader gives them: records to bronze, those that
    cannot be read to the quarantine."""
    if CORRUPT in read.columns:
        # The reader's rows are used twice.
        read = read.persist()
    try:
        write_bronze_batch(normalise(read), lake, writer, batch_id, as_of)
        if CORRUPT in read.columns:
            write_quarantine_batch(broken(read), lake, writer, batch_id)
    finally:
        read.unpersist()


def run_bronze_upkeep(spark: SparkSession, lake: Lake) -> int:
    """Move closed batches into files by day, and delete folders that nobody can still be
    reading. Returns the number of batches moved. Streams over bronze's folders go on as
    they are; one that starts anew finds open batches only, and takes the rest from
    `run_silver`."""
    days, bronze = lake.bronze_days(spark), lake.path("bronze")
    size_for(spark, lake.size(spark, "bronze"))
    moved = bronze_days.merge(days, bronze)
    bronze_days.vacuum(days, bronze)
    return moved


def run_upkeep(spark: SparkSession, lake: Lake, few_files: int = FEW_FILES) -> None:
    """What keeps a lake readable for years, beside everything else that runs: bronze by
    day, few runs of ids, small files merged, and files that nobody can still be reading
    deleted."""
    run_bronze_upkeep(spark, lake)
    silver = lake.snapshots(spark, "silver")
    tables = [silver, lake.snapshots(spark, "gold"), lake.frequencies(spark)]
    tables += [lake.quality_parts(spark, layer) for layer in R.MEASURES]
    if silver.current():
        I.merge_runs(silver)
    for table in tables:
        now = table.current()
        if now:
            if len(table.files(now)) > few_files:
                table.compact()
            table.vacuum()


def run_silver(spark: SparkSession, lake: Lake, as_of: str | None = None) -> None:
    """Rebuild silver from all of bronze: one shuffle, by id, whose partitions adaptive
    execution merges into files of a good size. After it each id is one row, so there
    is no skew left to even out. Readers see the table as it was until the new one is
    whole, and what a stream adds meanwhile is kept."""
    size_for(spark, lake.size(spark, "bronze"))
    silver = V.build_silver(lake.read(spark, "bronze"), as_of=as_of)
    table = lake.snapshots(spark, "silver")
    if table is None:
        write_table(silver, lake.path("silver"), "overwrite", (), lake.fmt)
        return
    base = table.current() or Snapshot()
    unit = table.write(silver, "overwrite", base.version + 1)
    ids = table.read(base.with_units(DATA, [unit], silver.schema)).select("id")
    run = I.write_run(table, ids, unit.writer, unit.batch)
    before = {u.folder for u in base.units()}

    def step(now: Snapshot) -> Snapshot:
        units, runs = [unit], [run] if run else []
        for u in now.units():
            if u.folder not in before:
                rest = V.new_ids(table.read(now, units=[u]), ids)
                units.append(table.write(rest, u.writer, u.batch))
                own = table.read(now, units=[units[-1]]).select("id")
                runs += filter(None, [I.write_run(table, own, u.writer, u.batch)])
        return I.with_runs(now.with_units(DATA, units, silver.schema), runs)

    table.change(step)


def known_among(records: DataFrame, known: DataFrame) -> DataFrame:
    """Ids of `records` that `known` holds already. Of the long table only the id
    column is read, and with a short list of ids it is not shuffled."""
    ids = broadcast_if_few(records.select("id").distinct())
    return known.select("id").join(ids, "id", "left_semi")


def append_new_silver(
    spark: SparkSession, lake: Lake, records: DataFrame, as_of: str | None = None,
    writer: str | None = None, batch_id: int = 0,
) -> None:
    """Add the records whose ids silver does not hold yet. Running it again with the same
    records adds nothing; a batch that is played again under its writer's name replaces
    itself. The index of ids is asked, so no file of silver is read."""
    # The batch is used for its ids, for their number and for its rows.
    records = records.persist()
    try:
        fresh = V.build_silver(records, as_of=as_of)
        table = lake.snapshots(spark, "silver")
        if table is None:
            if lake.exists(spark, "silver"):
                fresh = V.new_ids(fresh, known_among(records, lake.read(spark, "silver")))
            write_table(fresh, lake.path("silver"), "append", (), lake.fmt)
            return
        if table.current() is None and lake.exists(spark, "silver"):
            raise RuntimeError(f"silver in {table.root} has no manifest; rebuild it with run_silver")
        ids = records.select("id").distinct()

        def step(base: Snapshot) -> Snapshot:
            own = (writer, batch_id) if writer else ("append", base.version + 1)
            base.check_open(*own)
            unit = table.write(V.new_ids(fresh, I.known(table, base, ids, own)), *own)
            made = base.with_units(DATA, [*(u for u in base.units() if (u.writer, u.batch) != own), unit], fresh.schema)
            run = I.write_run(table, table.read(made, units=[unit]).select("id"), *own)
            others = [r for r in I.runs_of(base) if (r.writer, r.batch) != own]
            return I.with_runs(made, [*others, *([run] if run else [])])

        table.change(step)
        I.merge_runs(table)
    finally:
        records.unpersist()


def run_gold(
    spark: SparkSession,
    lake: Lake,
    dimensions: int = training.TFIDF_DIMENSIONS,
    as_of: str | None = None,
) -> PipelineModel:
    """Features and TF-IDF vectors of all of silver, and the statistics beside them.
    Returns the fitted text pipeline."""
    size_for(spark, lake.size(spark, "silver"))
    silver = lake.read(spark, "silver")
    if lake.exists(spark, "labels"):
        latest = P.latest_labels(lake.read(spark, "labels"), key="id", value="label")
        silver = P.with_labels(silver, broadcast_if_few(latest))
    text = training.text_pipeline(dimensions).fit(silver)
    gold = text.transform(G.numeric_gold(silver, "content_cleaned"))
    gold = G.gold_stamp(gold, as_of).select(*S.GOLD_COLUMNS)
    table = lake.snapshots(spark, "gold")
    if table is None:
        write_table(balanced(gold, "label"), lake.path("gold"), "overwrite", ("label",), lake.fmt)
    else:
        table.overwrite(balanced(gold, "label"), ["label"])
    text.write().overwrite().save(lake.model_path("text"))
    run_statistics(spark, lake)
    return text


def read_gold(spark: SparkSession, lake: Lake, table: str = "gold") -> DataFrame:
    """Labels come from folder names; keep them strings whatever they look like."""
    return lake.read(spark, table).withColumn("label", F.col("label").cast("string"))


def run_statistics(spark: SparkSession, lake: Lake) -> None:
    statistics = G.feature_statistics(read_gold(spark, lake))
    write_table(statistics.coalesce(1), lake.path("feature_statistics"), "overwrite")


def run_quality(spark: SparkSession, lake: Lake) -> DataFrame:
    """The report over those layers that exist."""
    layer = lambda t: lake.read(spark, t) if lake.exists(spark, t) else None
    return Q.quality_report(layer("bronze"), layer("silver"), layer("gold"))


def add_quality_part(rows: DataFrame, lake: Lake, layer: str, writer: str, batch_id: int) -> None:
    """Measure one batch of bronze, silver or gold rows. A batch that is played again
    replaces its figures."""
    part = R.MEASURES[layer](rows).coalesce(1)
    lake.quality_parts(rows.sparkSession, layer).append(part, writer, batch_id)


def quality_from_parts(spark: SparkSession, lake: Lake) -> DataFrame:
    """The report from what the batches left behind; no layer is read."""
    tables = {layer: lake.quality_parts(spark, layer) for layer in R.MEASURES}
    return R.report(**{layer: t.read() for layer, t in tables.items() if t.current()})


def statistics_from_parts(spark: SparkSession, lake: Lake) -> DataFrame:
    return R.feature_figures(lake.quality_parts(spark, "gold").read())


def add_frequencies(
    silver: DataFrame, lake: Lake, writer: str, batch_id: int, withdrawn: bool = False,
    dimensions: int = training.TFIDF_DIMENSIONS,
) -> None:
    """Count the documents of one batch of silver, or withdraw them. A batch that is played
    again replaces its counts."""
    counted = training.counting_model(dimensions).transform(silver.select("content_cleaned"))
    part = N.frequency_part(counted, -1 if withdrawn else 1)
    lake.frequencies(silver.sparkSession).append(part.coalesce(1), writer, batch_id)


def text_from_parts(
    spark: SparkSession, lake: Lake, dimensions: int = training.TFIDF_DIMENSIONS
) -> PipelineModel:
    """The text pipeline that a fit over all counted documents gives, without a look at them."""
    parts = lake.frequencies(spark).read()
    return N.text_model(training.counting_model(dimensions), N.merged_frequencies(parts))


def run_splits(
    spark: SparkSession, lake: Lake, train_ratio: float = 0.8, method: str = "stratified"
) -> DataFrame:
    """Write the labelled rows as train and test; returns their counts."""
    size_for(spark, lake.size(spark, "gold"))
    split = {"random": L.random_split, "hash": L.hash_split, "stratified": L.stratified_split}[method]
    labelled = split(L.labelled_only(read_gold(spark, lake)), train_ratio)
    write_table(balanced(labelled, "split"), lake.path("splits"), "overwrite", ("split",), lake.fmt)
    return L.split_counts(lake.read(spark, "splits"))


def add_labels(labels: DataFrame, lake: Lake, version: int) -> None:
    """Record newly labelled ids as (id, label). From the next gold on, the highest
    version of an id holds; train again to learn from it."""
    rows = labels.select("id", "label", F.lit(version).alias("version"))
    folder = f"{lake.path('labels')}/pass={version}"
    write_table(rows, folder, "overwrite", (), lake.fmt)


def labelled_text(spark: SparkSession, lake: Lake, part: str) -> DataFrame:
    """One side of the split with its text from silver, for training."""
    labels = lake.read(spark, part).select("id", F.col("label").cast("string"))
    return lake.read(spark, "silver").drop("label").join(broadcast_if_few(labels), "id")


def run_training(spark: SparkSession, lake: Lake, **options) -> training.Trained | None:
    """Train, log every run, save the best model. Without a model better than
    nothing, none is saved."""
    size_for(spark, lake.size(spark, "silver"))
    train, test = labelled_text(spark, lake, L.TRAIN), labelled_text(spark, lake, L.TEST)
    results = training.train_models(train, test, **options)
    write_table(training.run_rows(spark, results), lake.path("runs"), "append", (), lake.fmt)
    best = training.best_of(results)
    if best is not None:
        training.save_model(best.model, lake.model_path(), results, best.name)
    return best


def run_scoring(
    spark: SparkSession, lake: Lake, requests: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Answer every request that has a content, in the table of responses: by a fresh
    prediction of the same content where there is one, else by the model, which sees
    each distinct content once and whose predictions are appended to their log.
    Returns the rejected requests."""
    # One instant for the whole job, or a prediction could go stale in the midst of it.
    as_of = as_of or spark.range(1).select(F.current_timestamp().cast("string")).first()[0]
    now = F.lit(as_of).cast("timestamp")
    size_for(spark, input_bytes(requests))
    articles = request_articles(requests)
    prior = lake.read(spark, "predictions") if lake.exists(spark, "predictions") else None
    model = training.load_model(lake.model_path())
    scored = score(P.unscored_contents(articles, prior, now), model, "content", as_of)
    scored = materialise(scored)
    answers = materialise(P.answers(articles, scored, prior, now))
    day = F.date_format("analyzed_at", B.DATE_FORMAT)
    for rows, table in ((scored, "predictions"), (answers, "responses")):
        write_table(rows.withColumn("day", day), lake.path(table), "append", ("day",), lake.fmt)
    return P.rejected(P.validate_requests(requests))


def run_ensemble(spark: SparkSession, lake: Lake, **options) -> None:
    """Fit the three voters on the training rows; save them and what the forest leans on."""
    size_for(spark, lake.size(spark, "silver"))
    train = labelled_text(spark, lake, L.TRAIN)
    model, names = training.train_ensemble(train, **options)
    model.write().overwrite().save(lake.model_path("ensemble"))
    forest = PipelineModel(stages=[s for s in model.stages if hasattr(s, "featureImportances")][:1])
    write_table(training.feature_importance(forest).coalesce(1), lake.path("importances"), "overwrite")
    write_table(spark.createDataFrame([(n,) for n in names], "voter STRING").coalesce(1), lake.path("voters"), "overwrite")


def ensemble_votes(spark: SparkSession, lake: Lake, articles: DataFrame) -> DataFrame:
    """The saved voters' verdict on cleaned articles: see `majority_vote`."""
    model = PipelineModel.load(lake.model_path("ensemble"))
    names = [r.voter for r in lake.read(spark, "voters").collect()]
    return training.ensemble_vote(model, names, articles)


def refresh(spark: SparkSession, lake: Lake, tables: Sequence[str] = ("silver", "gold", "splits")) -> None:
    """The periodic batch pass from bronze to train and test. Silver is compacted after
    it is written, which merges what streams have appended to it meanwhile, and files
    that nobody can still be reading go."""
    steps = {"silver": run_silver, "gold": run_gold, "splits": run_splits}
    for table in tables:
        steps[table](spark, lake)
        held = lake.snapshots(spark, table)
        if held:
            if table == "silver" and lake.files(spark, table) > FEW_FILES:
                held.compact()
            held.vacuum()
