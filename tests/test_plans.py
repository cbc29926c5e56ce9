"""What the physical plans must and must not hold."""

import re

import pytest

from broadsheet.catalog import adapters as A
from broadsheet.catalog import lake_queries, queries
from broadsheet.operators import monitoring as M
from broadsheet.operators import silver as V
from broadsheet.operators import terms as T
from broadsheet.plans import jobs
from broadsheet.plans.lake import Lake
from broadsheet.sources.envelope import to_envelope
from conftest import formatted_plan

QUERIES = queries.REGISTRY | lake_queries.REGISTRY
# These fit a model, run a job or write a checkpoint when called.
EAGER = {
    "tfidf_vectors",
    "score_documents",
    "ensemble_documents",
    "model_runs",
    "feature_weights",
    "stream_to_bronze",
    "stream_to_silver",
    "stream_dedup",
    "live_predictions_daily",
    "live_hourly_trend",
    *lake_queries.REGISTRY,
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_and_no_nested_loop(spark, sf_dir, name):
    plan = formatted_plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|ArrowEval", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def scans(plan):
    return re.findall(r"ReadSchema: (struct<.*?>)\n", plan)


def test_source_counts_read_no_titles_or_labels_values(spark, sf_dir):
    plan = formatted_plan(QUERIES["source_distribution"](spark, sf_dir))
    assert set(scans(plan)) == {"struct<doc_id:bigint,text:string,source:string>", "struct<doc_id:bigint>"}


def test_hourly_rate_reads_one_column(spark, sf_dir):
    assert scans(formatted_plan(QUERIES["prediction_rate"](spark, sf_dir))) == ["struct<ts:timestamp_ntz>"]


def test_content_filter_reaches_the_scan(spark, sf_dir):
    plan = formatted_plan(QUERIES["silver_filter"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(text)]" in plan


def test_metrics_of_a_layer_are_one_scan(spark, sf_dir, tmp_path):
    A.gold(spark, sf_dir).write.parquet(str(tmp_path / "gold"))
    from broadsheet.operators import gold, quality

    table = spark.read.parquet(str(tmp_path / "gold"))
    assert formatted_plan(gold.feature_statistics(table)).count("Location:") == 1
    # The total comes from the file footers, the label counts from one column.
    assert scans(formatted_plan(quality.quality_report(gold=table))) == ["struct<>", "struct<label:string>"]


def test_silver_shuffles_once_and_prunes_before(spark, sf_dir):
    plan = formatted_plan(QUERIES["silver"](spark, sf_dir))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    limits = re.findall(r"^\(\d+\) WindowGroupLimit", plan, re.M)
    assert len(limits) == 2


def test_cleaning_runs_once_per_row(spark, sf_dir):
    """The regex is not copied into each measure."""
    plan = formatted_plan(QUERIES["gold_features"](spark, sf_dir))
    outputs = re.findall(r"^Output \[.*$|^Arguments.*$", plan, re.M)
    assert plan.count("regexp_replace(content") <= 2, outputs


def test_top_terms_prune_before_labels_meet(spark, sf_dir):
    plan = formatted_plan(QUERIES["top_terms_by_label"](spark, sf_dir))
    assert "row_number(), 20, Partial" in plan


def test_document_counts_are_taken_once(spark, sf_dir):
    """The counts serve as the short side, as the hot-key list and for its limit."""
    df = T.term_tfidf(T.tokenised(A.silver(spark, sf_dir), True))
    df.collect()
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "ReusedExchange" in plan


def test_no_pairs_of_document_and_term_are_shuffled_to_be_counted(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    A.silver(spark, sf_dir).write.parquet(path)
    tokens = T.tokenised(spark.read.parquet(path), True)
    for df in (T.term_frequencies(tokens), T.label_terms(tokens)):
        plan = formatted_plan(df)
        assert not re.search(r"hashpartitioning\(id#\d+L?, term", plan)
    assert "Exchange" not in formatted_plan(T.term_frequencies(tokens))


def test_an_unknown_label_raises(spark):
    rows = spark.createDataFrame([("1", ["a"], "satire")], "id STRING, words ARRAY<STRING>, label STRING")
    with pytest.raises(Exception, match="unknown label: satire"):
        T.label_terms(rows).collect()


def test_silver_is_written_after_one_shuffle(spark, sf_dir, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    jobs.write_bronze_batch(to_envelope(A.news(spark, sf_dir), A.AS_OF), lake, "w", 0, A.AS_OF)
    plan = formatted_plan(V.build_silver(lake.read(spark, "bronze"), as_of=A.AS_OF))
    assert plan.split("\n\n")[0].count("Exchange") == 1


def test_recent_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in formatted_plan(M.recent_predictions(A.predictions(spark, sf_dir)))


def test_sliding_counts_before_it_copies(spark, sf_dir):
    plan = formatted_plan(QUERIES["prediction_rate_sliding"](spark, sf_dir))
    tree = plan.split("\n\n")[0]
    assert tree.index("Expand") < tree.rindex("HashAggregate")
    assert re.search(r"Expand[^\n]*\n(.*\n)*?.*HashAggregate", tree)


def test_auc_ranks_inside_buckets(spark, sf_dir):
    plan = formatted_plan(QUERIES["auc_rank"](spark, sf_dir))
    assert "hashpartitioning(bucket" in plan
