"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns with
clashing names: each operator gives the result its docstring states."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import (
    cotrain, decontam, fuzzy_lines, hyperminhash, lattice, mixing, repetition, token_store, toxicity, warc,
)

LONG = "wide river stones turn slowly under cold bright water " * 4000
A = "the quick brown fox jumps over one lazy dog near the old mill by the river today"
# doc_id, text, lang, source, and names that operators use inside.
ROWS = [
    (1, A, "en", "s1", 9), (2, A, "en", "s1", 9), (2, A, "en", "s1", 9), (3, None, None, None, None),
    (4, "", "en", "s2", 1), (5, " \n\t ", "en", "s2", 1), (6, LONG, "de", "s2", 3), (None, A, "en", None, 2),
    (None, None, None, None, None), (7, "Ünïcode – 日本語 <|endoftext|>\x1c text\n\n\nend", "fr", "s1", 1),
    (2, "another text under a number that is taken", "en", "s1", 0),
]
SCHEMA = "doc_id long, text string, lang string, source string, score double"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, la, s, None if n is None else float(n)) for i, t, la, s, n in ROWS]
    clash = ["copy", "rate", "kept", "hashes", "_id", "component", "order", "quality", "n_lines"]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# Names that operators use inside, as columns of the caller with a value in each row.
INSIDE = ["_id", "_version", "_drop", "_gone", "_again", "_key", "_who", "_row", "_u", "cdf", "pmf", "first", "_text", "_lang",
          "_source", "n", "node", "component", "bucket", "group", "copy_of", "simhash", "terms", "_null", "_hash", "_salt"]


@pytest.mark.parametrize("name", ["deduplicate", "decontaminate", "dedup_lines", "mix_sources", "score_quality"])
def test_the_callers_columns_are_kept(spark, docs, name):
    own = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in INSIDE})
    benchmark = spark.createDataFrame([(1, "seven silver bells ring above an empty harbour at dawn")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, 1), (2, 0)], "doc_id long, quality int")
    out = {
        "deduplicate": lambda: hyperminhash.deduplicate(own),
        "decontaminate": lambda: decontam.decontaminate(own, benchmark),
        "dedup_lines": lambda: fuzzy_lines.dedup_lines(own),
        "mix_sources": lambda: mixing.mix_sources(own, budget=3.0),
        "score_quality": lambda: cotrain.score_quality(own, cotrain.train(own, labels)),
    }[name]()
    rows = out.collect()
    assert rows and set(INSIDE) <= set(out.columns)
    for r in rows:
        assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in INSIDE)


def test_near_duplicates(docs, none):
    rows = hyperminhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=repr)
    assert (1, 13, 1, True) in got and got.count((2, 13, 1, False)) == 2 and (2, 4, 1, False) in got
    assert (3, 0, 3, True) in got and (4, 0, 4, True) in got and (5, 0, 5, True) in got
    assert (None, 13, None, True) in got and (None, 0, None, True) in got
    assert hyperminhash.near_duplicates(none).count() == 0
    kept = hyperminhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 7]
    assert kept.filter("doc_id is null").count() == 2


def test_deduplicate_keeps_one_row_of_an_id(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c d"), (2, "e f")], "doc_id long, text string")
    assert sorted(r.doc_id for r in hyperminhash.deduplicate(df).collect()) == [1, 2]


def test_token_store(spark, docs, none):
    folder = token_store.write_store(docs, TOKENIZER, shards=3)
    found = token_store.fetch(spark, folder, token_store.stored_keys(spark, folder)).collect()
    assert len(found) == len(ROWS) and all(r.ids[-1] == token_store.END_ID for r in found)
    assert sorted(r.occurrence for r in found if r.doc_id == 2) == [0, 1, 2]
    assert sorted(r.occurrence for r in found if r.doc_id is None) == [0, 1]
    assert next(r.ids for r in found if r.doc_id == 4) == [2]
    starts = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:])
    absent = spark.createDataFrame([(99, 0), (1, 5), (-1, 0)], "doc_id long, occurrence long")
    assert token_store.fetch(spark, folder, absent).count() == 0
    empty = token_store.write_store(none, TOKENIZER)
    assert token_store.fetch(spark, empty, token_store.stored_keys(spark, empty)).count() == 0


def test_one_key_over_many_shards(spark):
    df = spark.createDataFrame([(7, f"text {i}") for i in range(60)], "doc_id long, text string").repartition(4)
    folder = token_store.write_store(df, TOKENIZER, shards=5)
    assert len({m["shard"] for m in token_store.read_manifest(folder)["shards"]}) > 1
    rows = token_store.fetch(spark, folder, token_store.stored_keys(spark, folder)).collect()
    assert sorted(r.occurrence for r in rows) == list(range(60))
    assert len({tuple(r.ids) for r in rows}) == 60


def test_mixing(docs, none):
    mixed = mixing.mix_sources(docs, budget=20.0)
    assert set(docs.columns) - {"copy", "rate"} <= set(mixed.columns)
    counts = {}
    for r in mixed.select("doc_id", "text", "copy", "n_copies").collect():
        counts.setdefault((r.doc_id, r.text), []).append((r.copy, r.n_copies))
    # Rows that repeat are drawn alike, each for itself.
    twice = counts[2, A]
    assert len(twice) == 2 * twice[0][1]
    assert mixing.mix_sources(none).count() == 0
    only = mixing.mix_sources(docs, weights={"s2": 1.0, "absent": 5.0})
    assert {r.source for r in only.select("source").collect()} == {"s2"}


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (6, 1), (None, 1), (4, None), (7, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        rows = toxicity.score_toxicity(docs, toxicity.train(docs, known)).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert all(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.score_toxicity(none, toxicity.train(none, labels)).count() == 0


def test_lattice(docs, none):
    rows = lattice.lattice_scores(docs, VOCABULARY).collect()
    assert len(rows) == len(ROWS) and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert next(r.n_tokens for r in rows if r.doc_id == 4) == 1
    assert len({r.train_tokens for r in rows}) == 1
    assert lattice.lattice_scores(none, VOCABULARY).count() == 0
    unlearned = lattice.lattice_scores(docs.filter("doc_id is null"), VOCABULARY).collect()
    assert len(unlearned) == 2 and all(r.train_tokens == 0 and r.n_known == 0 for r in unlearned)


def test_fuzzy_lines(docs, none):
    out = fuzzy_lines.dedup_lines(docs)
    assert set(out.columns) == set(docs.columns) | {"n_removed"}
    rows = out.collect()
    assert len(rows) == len(ROWS)
    by = lambda i: sorted((r.text is None, r.n_removed) for r in rows if r.doc_id == i)
    # The line without an id is first; those of 1 and 2 repeat it.
    assert by(None) == [(False, 0), (True, 0)] and by(1) == [(False, 1)]
    assert by(2) == [(False, 0), (False, 1), (False, 1)] and by(3) == [(True, 0)]
    assert next(r.text for r in rows if r.doc_id == 5) == " \n\t "
    assert fuzzy_lines.dedup_lines(none).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (4, None), (7, 1), (2, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        rows = cotrain.score_quality(docs, cotrain.train(docs, known)).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    bare = docs.select("doc_id", "text")
    assert cotrain.score_quality(bare, cotrain.train(bare, labels)).count() == len(ROWS)
    assert cotrain.score_quality(none, cotrain.train(none, labels)).count() == 0


def test_repetition(docs, none):
    rows = repetition.repetition_rules(docs).collect()
    assert len(rows) == len(ROWS)
    blank = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert all((r.n_words, r.word_chars, r.n_dup_lines, r.base_failed, r.kept) == (0, 0, 0, True, False) for r in blank)
    assert next(r for r in rows if r.doc_id == 6).base_failed
    assert repetition.repetition_rules(none).count() == 0


def test_warc(spark):
    rows = [(2, "http://a\r\nX: y", "same"), (1, None, "same"), (3, "http://ü/é x", None), (4, "u", ""), (None, "u", "same"),
            (1, None, "same"), (None, "u", "alone"), (5, "u", "long " * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.withColumn("_digest", F.lit("clash")).withColumn("refers_to", F.lit(3))
    folder = warc.write_archives(pages)
    found = warc.read_archives(spark, folder, payloads=True).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found), key=repr)
    assert got == sorted([(1, 4, "response", None), (1, 4, "response", None), (2, 4, "revisit", 1), (3, 0, "response", None),
                          (4, 0, "revisit", 3), (None, 4, "revisit", 1), (None, 5, "response", None),
                          (5, 1_500_000, "response", None)], key=repr)
    assert {r.payload for r in found if r.page_id == 5} == {"long " * 300_000}
    small = warc.read_archives(spark, warc.write_archives(pages, min_payload=5)).collect()
    assert {r.record_type for r in small if r.page_id == 2} == {"response"}
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0))).count() == 0


def test_decontamination(spark, docs, none):
    item = "a stolen question about seven silver bells that ring above an empty harbour at dawn"
    held = docs.limit(1).withColumns({"doc_id": F.lit(50).cast("long"), "text": F.lit("Before. " + item + " After it.")})
    nameless = held.withColumn("doc_id", F.lit(None).cast("long"))
    both = docs.unionByName(held).unionByName(held).unionByName(nameless)
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "")], "item_id long, text string")
    leaks = decontam.leaking_documents(both, benchmark).collect()
    assert sorted({(str(r.doc_id), r.item_id) for r in leaks}) == [("50", 1), ("None", 1)]
    rest = decontam.decontaminate(both, benchmark)
    assert rest.count() == len(ROWS) and rest.columns == both.columns
    assert decontam.leaking_documents(none, benchmark).count() == 0
    assert decontam.decontaminate(docs, benchmark.limit(0)).count() == len(ROWS)
