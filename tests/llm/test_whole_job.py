"""What the training-text operators must not leave out."""

import collections

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import decontam, queries


def test_near_dedup_stage_links_at_80_percent(spark, sf_dir):
    """Two far words of a hundred changed: 86 shingles of 106 are shared."""
    words = [f"w{k}" for k in range(100)]
    near = ["x" if k in (30, 60) else w for k, w in enumerate(words)]
    far = ["y" if k in (20, 50, 80) else w for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == {1, 3}


def hot_leaks(spark, sf_dir, copies=120):
    """Documents that hold an item of the benchmark many times over, at any place in them,
    and for each item a paraphrase without its rarest words."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()[:10]
    filler = " ".join(r.text or "" for r in queries.documents(spark, sf_dir).orderBy("doc_id").limit(60).collect()).split()
    rng, made = np.random.default_rng(8), []
    counts = collections.Counter(decontam.terms_of(" ".join(filler)))
    for r in items:
        rare = set(sorted(set(decontam.terms_of(r.text)), key=lambda w: (counts[w], w))[:4])
        # The answer, which is the last sentence, stays.
        answer = len(decontam.Item(0, r.text).answer)
        words = r.text.split()
        changed = [f"other{k}" if k < len(words) - answer and rare & set(decontam.terms_of(w)) else w for k, w in enumerate(words)]
        for n in range(copies + 1):
            at = rng.integers(0, len(filler) - 200)
            around = filler[at : at + rng.integers(60, 100)]
            k = rng.integers(0, 40)
            made.append((len(made), " ".join(around[:k] + (changed if n == copies else words) + around[k:]), r.item_id))
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    return docs, {(i, item) for i, _, item in made}


def test_op1_finds_items_that_leaked_often(spark, sf_dir):
    docs, want = hot_leaks(spark, sf_dir)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.leaking_documents(docs, benchmark).collect()}
    assert len(want - got) <= 0.01 * len(want)


def test_decontamination_stage_removes_items_that_leaked_often(spark, sf_dir):
    docs, want = hot_leaks(spark, sf_dir)
    assert corpus_pipeline.decontamination(spark, docs, sf_dir).count() <= 0.01 * len(want)


def test_run_writes_each_stage_once(spark, sf_dir, monkeypatch):
    seen, drawn = [], lambda spark, docs, _: docs.withColumn("lang", F.expr("uuid()"))

    def stage(spark, docs, _):
        seen.append({r.doc_id: r.lang for r in docs.collect()})
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a stage", drawn), ("next", stage), ("last", stage)])
    out = {r.doc_id: r.lang for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "lang").collect()}
    assert len(seen) == 2 and all("documents.parquet" not in f for f in corpus_pipeline.run(spark, sf_dir).inputFiles())
    assert seen[0] == seen[1] == out
