"""Filter audit, block join and hard negatives: kernels against plain arithmetic, and rows
with nulls, ties, repeats, odd vectors and clashing names. The registered queries are
compared with SQL in test_llm_queries.py."""

import collections
import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import filter_audit, hard_negatives, tiles, vector_join

WORD_LONG = " ".join(f"w{k}" for k in range(250))


# -- filter audit ----------------------------------------------------------------


def brute_audit(fails):
    """Counts by applying the filters one after the other to rows of (set of letters, good, toxic)."""
    out = {}
    for order in map("".join, itertools.permutations("ABCDE")):
        left = list(fails)
        for step, f in enumerate(order, 1):
            gone = [r for r in left if f in r[0]]
            left = [r for r in left if f not in r[0]]
            failing = sum(f in r[0] for r in fails)
            out[order, step] = [len(left), len(gone), failing - len(gone), sum(r[0] == {f} for r in fails),
                                sum(r[1] for r in gone), sum(r[2] for r in gone)]
    total = collections.Counter()
    for (order, step), row in out.items():
        total[order[step - 1]] += row[1]
    return {k: (*row, total[k[0][k[1] - 1]]) for k, row in out.items()}


def audited(df):
    found = collections.defaultdict(dict)
    for r in df.collect():
        found[r.part][r.filter_order, r.step] = tuple(r[c] for c in filter_audit.COUNTS)
    return found


def test_contractions_equal_filtering_in_a_row():
    rng = np.random.default_rng(1)
    tensor, fails = np.zeros((3, 2, 2, 2, 2, 2), np.int64), []
    for _ in range(400):
        bits, good, toxic = rng.integers(0, 2, 5), bool(rng.integers(0, 2)), bool(rng.integers(0, 2))
        for kind in [0, *[1] * good, *[2] * toxic]:
            tensor[(kind, *bits)] += 1
        fails.append(({f for f, b in zip("ABCDE", bits) if b}, good, toxic))
    counts, want = filter_audit.audit_part(tensor), brute_audit(fails)
    for o, s in itertools.product(range(120), range(5)):
        got = tuple(counts[c][o, s] for c in filter_audit.COUNTS)
        assert got == want[filter_audit.LETTERS[o], s + 1]


def test_each_filter_by_itself():
    bits = lambda text: filter_audit.failures(text)[0]
    assert bits(WORD_LONG) == 0
    assert bits(None) == bits("") == 0b0001
    assert bits("a " * 199 + "b") == 0b0010 and bits("a " * 199) == 0b0011
    # 3 % of capitals pass, more fail.
    assert bits("x" * 97 + "ABC") == 0b0001 and bits("x" * 96 + "ABCD") == 0b0101
    assert bits("é" * 97 + "ABC") == 0b0001
    assert all(bits(WORD_LONG + c) == 0b1000 for c in "#$%&*|") and bits(WORD_LONG + "@") == 0
    # No-break and other Unicode spaces part no words; \x1c neither.
    assert bits("a b\x1cc " * 200) == 0b0010


def test_audit_of_odd_rows(spark):
    rows = [(1, WORD_LONG, "en"), (2, WORD_LONG, "en"), (2, WORD_LONG, "en"), (3, WORD_LONG, None), (None, WORD_LONG, "en"),
            (4, None, "en"), (5, "", "en"), (None, None, None), (6, "A # " * 9, ""), (7, WORD_LONG * 900, "de"), (7, "x", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    docs = docs.withColumns({c: F.lit("x") for c in ("part", "flags", "digest", "rows", "quality", "toxic", "n", "cell")})
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (4, None, None), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    fails = collections.defaultdict(list)
    first = {t: min((i for i, u, _ in rows if (u or "") == t and i is not None), default=None) for t in {u or "" for _, u, _ in rows}}
    for i, text, lang in rows:
        flags, _ = filter_audit.failures(text)
        own = {f for k, f in enumerate("ABCD") if flags >> k & 1} | ({"E"} if i is not None and i > first[text or ""] else set())
        fails[lang or ""].append((own, i in (1, 6), i == 1))
    got = audited(filter_audit.audit_filters(docs, labels))
    assert set(got) == {"en", "", "de"}
    assert all(got[p] == brute_audit(fails[p]) for p in fails)
    assert all(len(v) == 600 for v in got.values())
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0
    assert audited(filter_audit.audit_filters(docs, labels.limit(0)))["en"][("ABCDE", 1)][4:6] == (0, 0)


def test_audit_of_one_hot_text(spark):
    """A text that is all of the table."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(WORD_LONG).alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audited(filter_audit.audit_filters(docs, labels))["en"]
    assert got["EABCD", 1][:4] == (1, 3999, 0, 3999)


# -- tiles -----------------------------------------------------------------------


def test_best_keeps_the_first_of_each_group():
    rng = np.random.default_rng(2)
    best, seen = tiles.Best(5, 4, np.int64), []
    for _ in range(30):
        n = rng.integers(0, 20)
        g, s, i = rng.integers(0, 5, n), rng.integers(0, 6, n), rng.integers(0, 10**6, n)
        best.add(g, s, i)
        seen += zip(g.tolist(), s.tolist(), i.tolist())
    want = {g: sorted((-s, i) for h, s, i in seen if h == g)[:4] for g in range(5)}
    got = {g: list(zip((-s).tolist(), i.tolist())) for g, s, i in best.lists()}
    assert got == want
    assert best.last.tolist() == [-want[g][-1][0] for g in range(5)]


def test_tiles_are_read_as_a_stream():
    """A tile over several batches, several tiles in a batch, one without queries and one
    without candidates."""
    rows = [(0, 0, 1), (0, 1, 2), (0, 1, 3), (1, 1, 4), (2, 0, 5), (3, 0, 6), (3, 0, 7), (3, 1, 8)]

    class Pairs:
        def __init__(self, queries):
            self.queries, self.rows = queries.column("v").to_pylist(), []

        def add(self, batch):
            self.rows += batch.column("v").to_pylist()

        def results(self):
            yield (self.queries, self.rows)

    for size in (1, 2, 3, 8):
        batches = [
            pa.RecordBatch.from_pydict({c: [r[k] for r in rows[a : a + size]] for k, c in enumerate(("t", "k", "v"))})
            for a in range(0, len(rows), size)
        ]
        assert list(tiles.tile_results(batches, 1, Pairs)) == [([1], [2, 3]), ([6, 7], [8])]


# -- block join ------------------------------------------------------------------


def brute_nearest(vectors, every, k):
    out = set()
    for q, x in vectors.items():
        if q % every == 0:
            near = sorted((-float(vector_join.inner(x[None], y[None])[0]), i) for i, y in vectors.items() if i != q and len(y) == len(x))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])}
    return out


def test_bounds_hold_for_vectors_of_any_size():
    rng = np.random.default_rng(3)
    for scale in (1.0, 1e-3, 1e12, 1e30, 1e-30, 1e200, 1e-250):
        for dim in (1, 7, 64, 2_500):
            x = rng.normal(size=(40, dim)) * scale * np.exp(rng.normal(size=(40, 1)) * 2)
            codes, s, norm, left = vector_join.coded(x)
            rows = pa.table({"vec_id": np.arange(40), "codes": [c.tobytes() for c in codes], "vector": [v.tobytes() for v in x],
                             "scale": s, "norm": norm, "residual": left})
            block = vector_join.Block(rows, "<f8")
            lower, upper = vector_join.bounds(block, block)
            exact = x @ x.T
            with np.errstate(invalid="ignore"):
                assert not ((lower > exact) | (upper < exact)).any()
            if scale == 1.0 and dim == 64:
                assert np.median(upper - lower) < 0.05 * np.median(norm) ** 2


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_of_odd_vectors(spark, kind):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    # Ties: equal vectors under many ids, queries among them.
    rows += [(i, [1.0, 0.5] * 4) for i in range(60, 100)]
    rows += [(100, [0.0] * 8), (101, None), (102, []), (103, [1.0, None] * 4), (104, [float("nan")] * 8),
             (105, [float("inf")] * 8), (None, [9.0] * 8), (110, [1.0, 2.0]), (120, [3.0, 1.0]), (130, [5.0]),
             (140, [-1e-44 if kind == "float" else -1e-300] * 8), (150, [3e38] + [1e30] * 7), (160, [-3e38] * 8)]
    rows += rows[:30]
    vectors = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(5)
    vectors = vectors.withColumns({c: F.lit(1) for c in ("dim", "scale", "_kind", "_block", "rank", "query_id", "codes", "score")})
    real = {i: np.array(v, np.float32 if kind == "float" else float) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    got = [tuple(r) for r in vector_join.nearest(vectors, F.col("vec_id") % 10 == 0, k=7).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_nearest(real, 10, 7)
    assert vector_join.nearest(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert vector_join.nearest(vectors.filter("vec_id = 130"), F.lit(True)).count() == 0


def test_nearest_over_many_tiles(spark, monkeypatch):
    """Small blocks and sections, an id twice with two vectors: the least counts."""
    monkeypatch.setattr(tiles, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(tiles, "SECTION_ROWS", 300)
    rng = np.random.default_rng(5)
    real = {i: v.astype(np.float32) for i, v in enumerate(rng.normal(size=(1500, 6)))}
    rows = [(i, v.tolist()) for i, v in real.items()] + [(3, [100.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in vector_join.nearest(vectors, F.col("vec_id") % 5 == 0, k=20).collect()}
    assert got == brute_nearest(real, 5, 20)


def test_few_pairs_are_computed_again():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4_000, 64)).astype(np.float32)
    codes, s, norm, left = vector_join.coded(x)
    rows = pa.table({"vec_id": np.arange(len(x)), "codes": [c.tobytes() for c in codes], "vector": [v.tobytes() for v in x],
                     "scale": s, "norm": norm, "residual": left})
    search = vector_join.Search(rows.slice(0, 50), 20, "<f4")
    for a in range(0, len(x), 500):
        search.add(rows.slice(a, 500))
    assert search.computed < 0.06 * 50 * len(x)


# -- hard negatives --------------------------------------------------------------


def test_lookups_give_exact_products():
    rng = np.random.default_rng(7)
    for dim in (1, 8, 13, 64):
        for size in (1, 300, 1 << 24):
            x = rng.integers(-size, size + 1, (70, dim))
            bits, packed = hard_negatives.planes(x)
            rows = pa.table({"vec_id": np.arange(70), "bits": bits, "planes": packed})
            assert (hard_negatives.numbers(hard_negatives.matrix(rows))[:, :dim] == x).all()
            anchors = hard_negatives.Anchors(rows.slice(0, 30))
            (_, found), = anchors.scored(rows)
            assert (found == x @ x[:30].T).all()
            assert found.dtype == (np.int64 if size == 1 << 24 else np.int32)


def brute_mined(rows, every=100, n_pos=5, n_neg=5):
    out = set()
    whole = {i: (label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in rows}
    for a, (label, x) in whole.items():
        if a % every:
            continue
        near = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in whole.items() if i != a and len(y) == len(x))
        for s, p, _ in [r for r in near if r[2] == label][:n_pos]:
            inside = [(t, i) for t, i, other in near if other != label and 80 * -s <= 100 * -t <= 100 * -s]
            out |= {(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(inside[:n_neg])}
    return out


def mined(df, **options):
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_hard_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=9) + 1.5).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(90)]
    # Ties among positives and negatives; labels of any value; vectors of another length.
    rows += [(i, [1.5] * 9, i % 4) for i in range(90, 140)] + [(i, [1.0, 0.5], i % 2) for i in range(140, 170)]
    rows += [(200, [-1.0] * 9, -5), (201, [-1.0] * 9, -5), (210, [0.0] * 9, 77), (211, [0.0] * 9, 77)]
    odd = [(220, None, 1), (221, [1.0] * 9, None), (230, [], 1), (240, [1.0, None], 1), (250, [float("nan")] * 9, 0), (None, [1.0] * 9, 1)]
    vectors = spark.createDataFrame(rows + odd + rows[:25], "vec_id long, embedding array<float>, label int").repartition(4)
    vectors = vectors.withColumns({c: F.lit(1) for c in ("dim", "bits", "planes", "_section", "rank", "anchor_id")})
    want = brute_mined(rows, every=10)
    assert len(want) > 100 and mined(vectors, every=10) == want
    assert mined(vectors.limit(0)) == mined(vectors.filter("label = 2")) == set()


def test_hard_negatives_over_many_tiles(spark, monkeypatch):
    """One label holds most rows, and one vector a third of them."""
    monkeypatch.setattr(tiles, "BLOCK_BYTES", 100_000)
    monkeypatch.setattr(tiles, "SECTION_ROWS", 100)
    rng = np.random.default_rng(9)
    rows = [(i, ([0.4] * 8 if i % 3 == 0 else rng.normal(size=8).tolist()), 0 if i % 5 else 1 + i % 2) for i in range(900)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(vectors, every=20) == brute_mined(rows, every=20)


def test_labels_are_turned(spark):
    rows = spark.createDataFrame([(0, 9), (7, 3), (8, 3), (14, None), (None, 4)], "vec_id long, label int")
    assert [r.label for r in hard_negatives.turned_labels(rows).collect()] == [0, 4, 3, None, 4]


def test_no_tile_is_a_cross_join(spark, sf_dir):
    from conftest import formatted_plan

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    for df in (vector_join.nearest(vectors, F.col("vec_id") % 20 == 0), hard_negatives.hard_negatives(vectors)):
        plan = formatted_plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
