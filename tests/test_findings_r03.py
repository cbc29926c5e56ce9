"""What the third review found, on rows of these tests' own."""

from __future__ import annotations

import collections

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from __spark_entry__ import queries
from broadsheet.catalog import adapters as A
from broadsheet.llm import decontam, edits, fuzzy_lines
from broadsheet.operators import associations
from broadsheet.operators import terms as T
from broadsheet.operators.scoring import model_input
from broadsheet.plans import training


@pytest.fixture
def still(spark):
    """Plans as they are made, without those that adaptive execution makes of them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def simple_plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


def small_silver(spark, tmp_path):
    rows = [(str(i), f"the old moon w{i % 3} house the old moon") for i in range(20)] + [("x", ""), ("y", None), ("z", "the  to ")]
    spark.createDataFrame(rows, "id STRING, content_cleaned STRING").write.parquet(f"{tmp_path}/silver")
    return spark.read.parquet(f"{tmp_path}/silver")


def test_compaction_merges_small_files_whatever_the_sizes_of_the_large_batch(spark, tmp_path):
    """no row whose id's hash is divisible by 8, so what was the large batch was the smallest."""
    text = F.concat(F.lit("line "), F.col("id"), F.lit("\n"), F.repeat(F.concat(F.lit("word"), F.col("id"), F.lit(" ")), 30))
    docs = spark.range(900).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("web").alias("source"))
    labels = spark.range(0, 900, 3).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    docs.write.parquet(f"{tmp_path}/all/documents.parquet")
    labels.write.parquet(f"{tmp_path}/all/labels.parquet")
    ids = A.news(spark, f"{tmp_path}/all").filter(F.pmod(F.xxhash64("id"), F.lit(8)) != 0).select("doc_id", "id")
    docs.join(ids, "doc_id").drop("id").write.parquet(f"{tmp_path}/some/documents.parquet")
    labels.write.parquet(f"{tmp_path}/some/labels.parquet")
    got = queries()["compaction_partial"](spark, f"{tmp_path}/some").select("id").collect()
    assert sorted(got) == sorted(ids.select("id").collect()) and len(got) > 600


def test_masks_do_not_follow_the_number_of_lines(spark, monkeypatch):
    """which pairs are candidates must not depend on what else the table holds."""
    asked, made = [], fuzzy_lines.tables_for
    monkeypatch.setattr(fuzzy_lines, "tables_for", lambda n: asked.append(n) or made(n))
    for n in (2, 40):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.translate(F.sha2(F.col("id").cast("string"), 256), "0123456789", "ghijklmnop").alias("text"))
        assert fuzzy_lines.duplicate_lines(docs).count() == 0
    assert asked[0] == asked[1]


def test_the_latent_space_is_fitted_on_every_passage(spark, monkeypatch):
    """not on those of a sample of the documents."""
    rows, made = [], decontam.latent_space
    monkeypatch.setattr(decontam, "latent_space", lambda hits, idf: rows.append(hits.count()) or made(hits, idf))
    monkeypatch.setattr(decontam, "SAMPLE_BLOCKS", 5, raising=False)
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two three four five six "), F.col("id")).alias("text"))
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id LONG, text STRING")
    assert decontam.leaking_documents(docs, items).count() == 50
    assert rows == [51]


def test_the_latent_space_takes_one_pass_over_the_passages(spark, monkeypatch):
    """F1 of the later findings: three before; the space is the one that the passes give."""
    seen, n = spark.sparkContext.accumulator(0), 40
    rng = np.random.default_rng(1)
    texts = [rng.choice(np.append(rng.permutation(n)[:9], -1), k).tolist() for k in (0, 1, 15, 16, 17, 33, 70, 200)] + [[-1] * 40]

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    hits = spark.createDataFrame([(t,) for t in texts], "terms array<int>").mapInArrow(counted, "terms array<int>")
    idf = np.linspace(0.5, 4, n).astype(np.float32)
    once = decontam.latent_space(hits, idf)
    assert seen.value == len(texts)
    monkeypatch.setattr(decontam, "TOGETHER", 0)
    passes = decontam.latent_space(hits, idf)
    assert once.shape == passes.shape
    assert np.allclose(once @ once.T, passes @ passes.T, atol=1e-3)


def test_a_bound_on_edits_changes_no_verdict():
    """the distance where it is within the bound, more than the bound elsewhere."""
    words = ["", "a", "abcab", "bcabc", "aabbcc", "cbacbacba", "abcabcabcabc"]
    for a in words:
        for b in words:
            d = fuzzy_lines.edit_distance(a, b)
            for most in range(14):
                got = fuzzy_lines.edit_distance(a, b, most)
                assert got == d if d <= most else got > most


def test_phrases_read_the_texts_once(still, tmp_path):
    """one scan, and the tokens made once beside the check that there are some."""
    found = associations.associated_phrases(small_silver(still, tmp_path), 5, 3.0)
    plan = simple_plan(found)
    assert plan.count("FileScan") == 1 and plan.count("split(") <= 2
    assert ("old", "moon", 40) in {tuple(r)[:3] for r in found.collect()}


def test_document_counts_share_one_exchange(still, tmp_path):
    """the texts are read for the pairs, for the counts and for the number of documents."""
    df = T.term_tfidf(T.tokenised(small_silver(still, tmp_path), True))
    plan = simple_plan(df)
    assert plan.count("FileScan") <= 3 and plan.count("split(") <= 2
    got = {(r.id, r.term): (r.tf, r.df) for r in df.collect()}
    assert got["4", "old"] == (2, 20) and got["4", "w1"] == (1, 7) and not any(i in "xyz" for i, _ in got)


def test_streams_of_reuse_are_of_few_batches_however_many_files(spark, monkeypatch, tmp_path):
    """F8: a table of many files is no longer as many batches."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 5).alias("text"))
    docs.repartition(12).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(0, 40, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4 > 1).cast("long").alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "4096")
    try:
        root = []
        from broadsheet.catalog import upkeep_queries as U

        lake = U._scratch_lake
        monkeypatch.setattr(U, "_scratch_lake", lambda s: root.append(lake(s)) or root[-1])
        assert U.stream_reuse(spark, str(tmp_path)).count() == 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = spark.read.parquet(f"{root[0].root}/requests").inputFiles()
    # Those of the row that closes the stream come on top.
    assert len(files) <= U.REUSE_FILES + 2


def test_preprocessing_fitted_on_counts_is_the_same(spark):
    """one pass over the texts gives the model and the vectors of a fit on the rows."""
    rows = spark.createDataFrame(
        [(str(i), "real" if i % 2 else "fake", f"moon w{i % 4} old w{i % 3}", *(float(i + k) for k in range(10))) for i in range(30)],
        ["id", "label", "content_cleaned", *training.S.NUMERIC_FEATURES],
    )
    fitted, vectors = training.fitted_preprocessing(rows, 32)
    want = training.preprocessing(spark, 32).fit(model_input(rows)).transform(model_input(rows))
    arrays = lambda df: {r.id: list(r.v) for r in df.select("id", vector_to_array("features").alias("v")).collect()}
    assert arrays(vectors) == arrays(want) == arrays(fitted.transform(model_input(rows)))


def test_only_buckets_that_lines_share_become_rows():
    """F2 of the later findings: before, each line was a row for each of its buckets."""
    rng = np.random.default_rng(4)
    n, masks = 3000, fuzzy_lines.tables_for(fuzzy_lines.MASK_LINES)
    simhash, least = rng.integers(0, 1 << 63, n), rng.integers(0, 1 << 63, (n, fuzzy_lines.SEEDS))
    simhash[1000:1100], least[2000:2300, 1:3] = simhash[7], least[9, 1:3]
    ids = np.arange(n) + (np.arange(n) % 3 << 33)
    rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(simhash), pa.array(list(least))], ["id", "simhash", "least"])
    packed = pa.Table.from_batches(fuzzy_lines._entries([rows.slice(0, 1500), rows.slice(1500)], masks)).sort_by("part")
    assert packed.num_rows <= 3 << fuzzy_lines.PART_BITS and sum(map(len, packed["data"].to_pylist())) == 8 * 16 * n
    found = pa.Table.from_batches(fuzzy_lines._members(packed.to_batches(max_chunksize=100))).to_pylist()
    groups = collections.defaultdict(set)
    for r in found:
        groups[r["bucket"]].add(r["id"])
    assert all(r["n"] == len(groups[r["bucket"]]) and r["leader"] == min(groups[r["bucket"]]) for r in found)
    same, shared = {7, *range(1000, 1100)}, {9, *range(2000, 2300)}
    want = [{int(ids[i]) for i in same}] * len(masks) + [{int(ids[i]) for i in shared}]
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))


def test_bounds_of_edits_hold():
    """F2 of the later findings: pairs that words settle are not measured, with the same verdicts."""
    rng = np.random.default_rng(8)
    pairs = [tuple("".join(rng.choice(list("abc  "), rng.integers(0, 30))) for _ in "ab") for _ in range(500)]
    for _ in range(300):
        words = [f"w{k}" for k in rng.integers(0, 60, 25)]
        other = list(words)
        other[rng.integers(0, 25)] = "changed"
        pairs += [(" ".join(words), " ".join(other)), (" ".join(words), " ".join(rng.permutation(other)))]
    exact = [fuzzy_lines.edit_distance(a, b) for a, b in pairs]
    assert all(fuzzy_lines.edits_at_most(a, b) >= d for (a, b), d in zip(pairs, exact))
    columns = [pa.array(range(len(pairs))), pa.array(range(len(pairs))), *(pa.array(c) for c in zip(*pairs))]
    for beyond in (1, 3):
        (got,) = fuzzy_lines._compared([pa.RecordBatch.from_arrays(columns, ["a", "b", "x", "y"])], 80, beyond)
        for r, d, (a, b) in zip(got.to_pylist(), exact, pairs):
            assert r["low"] <= d <= r["high"] and r["close"] == (d <= max(len(a), len(b)) // 5)


def test_lines_near_a_leader_are_not_compared_with_those_far_from_it(spark, monkeypatch):
    """F2 of the later findings: all lines of a bucket in different groups were, before."""
    compared, made = [], fuzzy_lines.written
    monkeypatch.setattr(fuzzy_lines, "written", lambda df, name: note(made(df, name), name))

    def note(df, name):
        if name == "pairs":
            compared.append(df.count())
        return df

    # All lines hold the triples with the least hashes; what follows is of two kinds.
    monkeypatch.setattr(fuzzy_lines, "WIDE", 64)
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    pool = [" ".join(word() for _ in range(3)) for _ in range(4000)]
    hashes = fuzzy_lines.line_hashes("\n".join(pool).encode()).least
    head = " ".join(pool[i] for i in dict.fromkeys(hashes.argmin(0).tolist()))
    tail = [word() for _ in range(40)]
    near = [" ".join([head, *tail[:k], word(), *tail[k + 1 :]]) for k in range(20)]
    far = [" ".join([head, *(word() for _ in range(40))]) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(near + far)), "doc_id long, text string")
    assert fuzzy_lines.duplicate_lines(docs).count() == 19
    # One line leads, and at most the far ones are compared with each other.
    assert sum(compared) <= 16 * 39 + 190 and compared[-1] <= 20 * 19 // 2


def edited(rng, text: str, n: int) -> str:
    """The text with `n` characters put in, taken out or changed."""
    out = list(text)
    for _ in range(n):
        at, kind = int(rng.integers(0, len(out) + 1)), rng.integers(0, 3)
        out[at : at + (kind > 0)] = [] if kind == 1 else [str(rng.choice(list("abxé日\U0001f9ea")))]
    return "".join(out)


def test_distances_of_many_pairs_at_once():
    """before, each pair was measured on its own, one column of the table at a time."""
    rng = np.random.default_rng(21)
    random = lambda n: "".join(rng.choice(list("abcdé日 "), n))
    pairs = [(a := random(rng.integers(0, 300)), edited(rng, a, rng.integers(0, 60))) for _ in range(400)]
    pairs += [(random(rng.integers(0, 300)), random(rng.integers(0, 300))) for _ in range(200)]
    pairs += [("", ""), ("", "a"), ("a", ""), ("a" * 64, "a" * 128), ("\ud800b", "b")] * 20
    pairs += [(a := random(n), edited(rng, a, n // 20)) for n in (2500, 4000)]
    exact = np.array([edits.edit_distance(a, b) for a, b in pairs])
    assert (edits.edit_distances(pairs, np.full(len(pairs), 10**6)) == exact).all()
    for part in (20, 60):
        most = np.array([max(map(len, p)) * part // 100 for p in pairs])
        got = edits.edit_distances(pairs, most)
        assert np.where(exact <= most, got == exact, (got > most) & (got <= exact)).all()


def passages(rng, n: int, again: int) -> list[str]:
    """Lines with a passage in common that are alike in nothing else, and near-copies of some."""
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    common = [word() for _ in range(45)]
    texts = [" ".join([*(word() for _ in range(rng.integers(30, 36))), *common]) for _ in range(n)]
    return texts + [" ".join([word(), *t.split(" ")[1:]]) for t in texts[:again]]


def test_lines_of_a_bucket_are_not_joined_in_pairs(spark, monkeypatch):
    """a row was written for each two lines of a bucket that no link joined yet."""
    tables, made = {}, fuzzy_lines.written

    def noted(df, name):
        table = made(df, name)
        tables[name] = max(table.count(), tables.get(name, 0))
        return table

    monkeypatch.setattr(fuzzy_lines, "written", noted)
    monkeypatch.setattr(fuzzy_lines, "BLOCK_LINES", 32)
    texts = passages(np.random.default_rng(22), 200, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["_id"] for r in fuzzy_lines.duplicate_lines(docs).collect()} == set(range(200, 240))
    assert tables["mixed"] > 200 and max(tables.values()) <= 16 * len(texts)


def test_each_pair_of_a_tile_is_looked_at_once(monkeypatch):
    """lines in several buckets and blocks, against plain loops over all pairs."""
    monkeypatch.setattr(fuzzy_lines, "LOOKED_AT", 100)
    texts = passages(np.random.default_rng(24), 60, 30)
    n, masks = len(texts), fuzzy_lines.tables_for(fuzzy_lines.MASK_LINES)
    hashes = fuzzy_lines.line_hashes("\n".join(texts).encode())
    own = fuzzy_lines._buckets(hashes.simhash.view(np.uint64), hashes.least, masks) >> np.uint64(32 - fuzzy_lines.PART_BITS)
    group, held = [k % 60 % 50 for k in range(n)], collections.defaultdict(list)
    for k in range(n):
        for bucket in own[k].tolist():
            held[bucket].append(k)
    rows = [
        (bucket, min(k % 3, other), max(k % 3, other), k % 3, k, group[k], int(hashes.simhash[k]), int(hashes.length[k]), 0, 1 << 30,
         hashes.least.view(np.int64)[k].tolist(), texts[k])
        for bucket, ks in held.items() if len(ks) > 1 for k in ks for other in range(3)
    ]
    names = ["bucket", "first", "second", "block", "id", "component", "simhash", "length", "low", "high", "least", "norm"]
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in sorted(rows)])
    values = {c: table[c].to_numpy() for c in names[:-2]}
    looked = collections.Counter()
    for i, j in fuzzy_lines._near_pairs(values, own[values["id"]].astype(np.int64), 80):
        looked.update(tuple(sorted(p)) for p in zip(values["id"][i].tolist(), values["id"][j].tolist()))
    apart = np.bitwise_count(hashes.simhash.view(np.uint64)[:, None] ^ hashes.simhash.view(np.uint64))
    size = hashes.length
    want = {(a, b) for a in range(n) for b in range(a + 1, n)
            if (own[a] == own[b]).any() and group[a] != group[b] and apart[a, b] <= fuzzy_lines.WIDE
            and 5 * abs(size[a] - size[b]) <= max(size[a], size[b])}
    assert set(looked) == want and max(looked.values()) == 1 and len(want) > 500
    got = {tuple(sorted(r.values())) for b in fuzzy_lines._across(table.to_batches(max_chunksize=7), masks, 80) for r in b.to_pylist()}
    close = {(a, b) for a, b in want if fuzzy_lines.edit_distance(texts[a], texts[b]) <= max(len(texts[a]), len(texts[b])) // 5}
    assert got == {tuple(sorted((group[a], group[b]))) for a, b in close}


def test_few_lines_make_few_parts():
    """many small tasks made a row each for nearly all parts."""
    rng = np.random.default_rng(23)
    n, masks = 300, fuzzy_lines.tables_for(fuzzy_lines.MASK_LINES)
    simhash, least = rng.integers(0, 1 << 63, n), rng.integers(0, 1 << 63, (n, fuzzy_lines.SEEDS))
    simhash[200:] = simhash[7]
    rows = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(simhash), pa.array(list(least))], ["id", "simhash", "least"])

    def groups(bits):
        packed = pa.Table.from_batches(fuzzy_lines._entries([rows], masks, bits)).sort_by("part")
        assert packed.num_rows <= 1 << bits
        found = collections.defaultdict(set)
        for r in pa.Table.from_batches(fuzzy_lines._members(packed.to_batches())).to_pylist():
            found[r["bucket"]].add(r["id"])
        return sorted(map(sorted, found.values()))

    assert groups(1) == groups(5) == groups(fuzzy_lines.PART_BITS) == [[7, *range(200, 300)]] * len(masks)
