"""Quality classifier by co-training: one model sees what a page says, the other what is
known about it, and each labels pages for the other.

Every unlabelled document takes part in every round: both views score it where it is, and
the surest share of all is passed on. What comes to the driver are counts of scores, and a
bounded sample of the rows that a view is fitted on, each weighted by what it stands for.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import free_names, small_batches, written
from broadsheet.operators.joins import broadcast_if_few

# Bounds on the rows that a view is fitted on, chosen by hash of doc_id and weighted back
# to what they stand for: labelled ones of each class, and those of each class that the
# other view has labelled.
MAX_GOOD, MAX_BAD, MAX_GIVEN = 3_000, 2_000, 1_000
ROUNDS = 4
# Pseudo-labels that a view gives in a round, as a share of all unlabelled documents, and
# how sure of them it must be.
SHARE, SURE = 0.03, 0.95
# Scores are counted by their log-odds in steps of 1 / STEP, up to BINS / 2 of them either way.
STEP, BINS = 64, 4096
# Every fifth labelled row is for calibration, not for fitting.
CALIBRATION = 5
THRESHOLD = 0.5

CONTENT_DIM = 1024
SLOTS = 32
STEPS, PENALTY = 150, 3e-4
LAYOUT = (
    "chars", "lines", "line_length", "upper", "digits", "marks", "symbols", "spaces", "distinct",
    "top_word", "word_length", "repeated_lines", "ended_lines", "repeats", "other",
)
META_DIM = len(LAYOUT) + 1 + 2 * SLOTS
_SYMBOLS = np.frombuffer("#*$%&|<>=+~^_{}[]\\/@".encode(), np.uint8)
_MARKS = np.frombuffer(b".,;:!?'\"()-", np.uint8)
TOKENS = re.compile(r"\S+")


def content_vector(text: str) -> np.ndarray:
    """Hashed counts of the text's character trigrams, damped and of unit length."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = np.zeros(CONTENT_DIM, np.float32)
    if len(c) >= 3:
        with np.errstate(over="ignore"):
            h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) + c[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + c[2:]
            h *= np.uint64(0x94D049BB133111EB)
        out[:] = np.sqrt(np.bincount((h >> np.uint64(54)).astype(np.int64), minlength=CONTENT_DIM))
        out /= np.linalg.norm(out)
    return out


def metadata_vector(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Layout figures of the page, its language and its source; what the words are is
    not looked at."""
    out = np.zeros(META_DIM, np.float32)
    out[len(LAYOUT)] = 1
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n, words, lines = max(len(data), 1), TOKENS.findall(text), [x for x in text.split("\n") if x.strip()]
    kinds = np.bincount(data, minlength=256)
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    counts = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    out[: len(LAYOUT)] = (
        math.log1p(len(text)) / 10, math.log1p(len(lines)) / 5, math.log1p(len(text) / n_lines) / 10,
        kinds[65:91].sum() / n, kinds[48:58].sum() / n, kinds[_MARKS].sum() / n * 5,
        kinds[_SYMBOLS].sum() / n * 5, kinds[[32, 9, 10]].sum() / n, len(counts) / n_words,
        max(counts.values(), default=0) / n_words, len(text) / n_words / 20, 1 - len(set(lines)) / n_lines if lines else 0,
        sum(x.rstrip()[-1] in ".!?" for x in lines) / n_lines, same / n_words, kinds[128:].sum() / n,
    )
    # The vocabulary grows slower than a text: the share of distinct words by length.
    out[LAYOUT.index("distinct")] *= math.log1p(n_words) / 5
    out[len(LAYOUT) + 1 + zlib.crc32(str(lang).encode()) % SLOTS] = 0.3
    out[len(LAYOUT) + 1 + SLOTS + zlib.crc32(str(source).encode()) % SLOTS] = 0.3
    return out


def _features(batches):
    for batch in batches:
        x, m = [], []
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            x.append(content_vector(text).astype("<f2").tobytes())
            m.append(metadata_vector(text, lang, source).tobytes())
        columns = [batch.column("quality"), batch.column("order"), pa.array(x), pa.array(m)]
        yield pa.RecordBatch.from_arrays(columns, ["quality", "order", "content", "metadata"])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model, by gradient steps of adaptive size."""
    w, b, moments = np.zeros(x.shape[1]), 0.0, np.zeros((2, x.shape[1] + 1))
    weight = (weight / weight.sum()).astype(np.float32)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -30, 30)))
        g = weight * (p - y)
        grad = np.append(g @ x + PENALTY * w / len(y) ** 0.5, g.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        move = 0.2 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a score into the log-odds of its label, by Newton
    steps held in by a mild pull to (1, 0)."""
    x, at = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1.0 * (at - [1.0, 0.0])
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2)
        at = at - np.clip(np.linalg.solve(hessian, grad), -1, 1)
    return max(float(at[0]), 1e-3), float(at[1])


class CoTrained:
    """Two models and their calibrations."""

    def __init__(self, views: list[tuple[np.ndarray, float]], scales: list[tuple[float, float]], joint):
        self.views, self.scales, self.joint = views, scales, joint

    def log_odds(self, features: list[np.ndarray]) -> list[np.ndarray]:
        return [a * (x @ w + b) + c for x, (w, b), (a, c) in zip(features, self.views, self.scales)]

    def scores(self, features: list[np.ndarray]) -> list[np.ndarray]:
        """Of content, of metadata, and of both."""
        one, two = self.log_odds(features)
        both = self.joint[0] * (one + two) / 2 + self.joint[1]
        return [1 / (1 + np.exp(-np.clip(z, -500, 500))) for z in (one, two, both)]


def _packed(batches):
    """Features of unlabelled documents, in a byte and in two for each number."""
    for batch in batches:
        scales, x, m = [], [], []
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            v = content_vector(text)
            scales.append(float(v.max()))
            x.append(np.rint(v / max(scales[-1], 1e-9) * 255).astype(np.uint8).tobytes())
            m.append(metadata_vector(text, lang, source).astype("<f2").tobytes())
        columns = [batch.column("draw"), pa.array(scales, pa.float32()), pa.array(x, pa.binary()), pa.array(m, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["draw", "scale", "content", "metadata"])


def _unpacked(scales, contents, metadata) -> list[np.ndarray]:
    x = np.frombuffer(b"".join(contents), np.uint8).reshape(-1, CONTENT_DIM).astype(np.float32)
    x *= (np.asarray(scales, np.float32) / 255)[:, None]
    return [x, np.frombuffer(b"".join(metadata), "<f2").reshape(-1, META_DIM).astype(np.float32)]


def _bins(features: list[np.ndarray], models) -> list[np.ndarray]:
    """The step of each row's log-odds under each view's model."""
    return [np.clip(np.floor((x @ w.astype(np.float32) + b) * STEP) + BINS // 2, 0, BINS - 1).astype(np.int64) for x, (w, b) in zip(features, models)]


def _given(features: list[np.ndarray], history) -> list[np.ndarray]:
    """The label that each view has been given for each row, -1 for none: that of the first
    round in which the other view was sure. `history` has each round's models and cuts."""
    out = [np.full(len(features[0]), -1) for _ in features]
    for models, cuts in history:
        for v, (own, (bad, good)) in enumerate(zip(_bins(features, models), cuts)):
            other = out[1 - v]
            free = other < 0
            other[free & (own >= good)] = 1
            other[free & (own <= bad)] = 0
    return out


def _batch_features(batch) -> list[np.ndarray]:
    return _unpacked(*(batch.column(c).to_pylist() for c in ("scale", "content", "metadata")))


def _counted(batches, history, models):
    """Rows that the other view has no label for, by view and step of the log-odds."""
    counts = np.zeros((2, BINS), np.int64)
    for batch in batches:
        if batch.num_rows:
            features = _batch_features(batch)
            given = _given(features, history)
            for v, own in enumerate(_bins(features, models)):
                counts[v] += np.bincount(own[given[1 - v] < 0], minlength=BINS)
    v, step = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (v, step, counts[v, step])], ["view", "step", "n"])


def _drawn(batches, history, shares):
    """Rows that have labels, those of each view and label in their share, by hash."""
    for batch in batches:
        if not batch.num_rows:
            continue
        draw = batch.column("draw").to_numpy()
        for v, given in enumerate(_given(_batch_features(batch), history)):
            for label in (0, 1):
                rows = np.flatnonzero((given == label) & (draw < shares[v][label]))
                if len(rows):
                    part = batch.take(pa.array(rows))
                    columns = [pa.array(np.full(len(rows), k)) for k in (v, label)]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, *(part.column(c) for c in ("scale", "content", "metadata"))],
                        ["view", "label", "scale", "content", "metadata"],
                    )


def _cuts(counts: np.ndarray, quota: float, prior: float) -> tuple[int, int]:
    """The steps up to which a view calls documents bad, and from which good: the surest of
    either class, in the classes' shares of the quota, but none that it is not sure of."""
    sure = math.log(SURE / (1 - SURE)) * STEP
    above, below = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    # Documents of one step go together, so the step that fills the quota may exceed it.
    good = max([0, *np.flatnonzero(above >= max(1, quota * prior))])
    bad = min([BINS - 1, *np.flatnonzero(below >= max(1, quota * (1 - prior)))])
    return int(min(bad, math.floor(-sure) + BINS // 2 - 1)), int(max(good, math.ceil(sure) + BINS // 2))


def _exchange(rounds: int, labelled, y, weight, held, pool: DataFrame, prior: float) -> list[tuple[np.ndarray, float]]:
    """The rounds: each view is fitted on the labels and on what the other view was sure of
    among all of `pool`. How sure it is, is calibrated on the rows that are `held` back:
    a view that fits its own labels perfectly may still be no judge of others."""
    n, history = pool.count(), []
    totals, drawn = np.zeros((2, 2), np.int64), [[], []]

    def fit(v: int) -> tuple[np.ndarray, float]:
        x, labels, weights = [labelled[v]], [y], [weight]
        # Together they weigh no more than the labels.
        less = min(1.0, weight.sum() / max(1, totals[v].sum()))
        for label, features in drawn[v]:
            x.append(features)
            labels.append(np.full(len(features), label))
            weights.append(np.full(len(features), less * totals[v][label] / len(features)))
        return fit_logistic(np.concatenate(x), np.concatenate(labels), np.concatenate(weights))

    def judge(v: int) -> tuple[np.ndarray, float]:
        w, b = fit(v)
        a, c = calibrate(held[0][v] @ w + b, *held[1:])
        return a * w, a * b + c

    for _ in range(rounds if n else 0):
        models = [judge(v) for v in (0, 1)]
        counts = np.zeros((2, BINS), np.int64)
        got = pool.mapInArrow(lambda b, h=list(history), m=models: _counted(b, h, m), "view long, step long, n long")
        for r in got.groupBy("view", "step").agg(F.sum("n").alias("n")).collect():
            counts[r.view, r.step] = r.n
        cuts = [_cuts(c, n * SHARE, prior) for c in counts]
        history.append((models, cuts))
        for v, (bad, good) in enumerate(cuts):
            totals[1 - v] += [counts[v, : bad + 1].sum(), counts[v, good:].sum()]
        shares = (MAX_GIVEN / np.maximum(totals, 1)).tolist()
        schema = "view long, label long, scale float, content binary, metadata binary"
        rows = pool.mapInArrow(lambda b, h=list(history), s=shares: _drawn(b, h, s), schema).toPandas()
        drawn = [[], []]
        for (v, label), part in rows.groupby(["view", "label"]):
            drawn[v].append((label, _unpacked(part.scale.to_numpy(), part.content, part.metadata)[v]))
    return [fit(v) for v in (0, 1)]


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> CoTrained:
    """Fit on `labels` (doc_id, quality) of `docs` (doc_id, text, lang, source) and on all
    documents without label. Without labels of both classes all documents score alike."""
    small_batches(docs.sparkSession)
    order = F.xxhash64("doc_id")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1))
    n = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    parts = [
        part.orderBy(order, "doc_id").limit(m)
        for part, m in ((known.filter("quality = 1"), MAX_GOOD), (known.filter("quality = 0"), MAX_BAD))
    ]
    # At most MAX_GOOD + MAX_BAD pairs of numbers go to every task.
    chosen = parts[0].union(parts[1])
    rows = _inputs(docs).join(F.broadcast(written(chosen, "chosen")), "doc_id").withColumn("order", order)
    got = rows.mapInArrow(
        _features, "quality int, order long, content binary, metadata binary"
    ).toPandas().sort_values("order")
    x = [
        np.frombuffer(b"".join(got.content), "<f2").reshape(-1, CONTENT_DIM).astype(np.float32),
        np.frombuffer(b"".join(got.metadata), "<f4").reshape(-1, META_DIM),
    ]
    y = got.quality.to_numpy()
    del got
    is_good, is_bad = y == 1, y == 0
    total = is_good.sum() + is_bad.sum()
    if not is_good.any() or not is_bad.any():
        z = 5.0 if is_good.any() or not total else -5.0
        blank = [(np.zeros(CONTENT_DIM), z), (np.zeros(META_DIM), z)]
        return CoTrained(blank, [(1.0, 0.0)] * 2, (1.0, 0.0))
    # A class cut by its bound counts for all its rows.
    weight = np.where(is_good, max(1.0, n[1] / MAX_GOOD), max(1.0, n[0] / MAX_BAD))
    known_rows = np.flatnonzero(y >= 0)
    aside = known_rows[::CALIBRATION] if len(known_rows) >= 50 else known_rows
    fitted = np.setdiff1d(known_rows, aside) if len(known_rows) >= 50 else known_rows
    if len(set(y[fitted])) < 2 or len(set(y[aside])) < 2:
        aside = fitted = known_rows
    prior = float((weight * is_good)[known_rows].sum() / weight[known_rows].sum())
    unlabelled = _inputs(docs).filter("doc_id is not null").join(broadcast_if_few(known.select("doc_id")), "doc_id", "left_anti")
    draw = (F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("draw")
    pool = unlabelled.select(draw, "text", "lang", "source")
    schema = "draw double, scale float, content binary, metadata binary"
    pool = written(pool.mapInArrow(_packed, schema), "unlabelled") if rounds else pool.limit(0)
    held = ([v[aside] for v in x], y[aside], weight[aside])
    views = _exchange(rounds, [v[fitted] for v in x], y[fitted], weight[fitted], held, pool, prior)
    held, w = y[aside], weight[aside]
    scales = [calibrate(v[aside] @ m + b, held, w) for v, (m, b) in zip(x, views)]
    model = CoTrained(views, scales, (1.0, 0.0))
    one, two = model.log_odds([v[aside] for v in x])
    model.joint = calibrate((one + two) / 2, held, w)
    return model


def _inputs(docs: DataFrame) -> DataFrame:
    """The columns that count; missing ones are null."""
    has = lambda c: F.col(c) if c in docs.columns else F.lit(None)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text, has("lang").cast("string").alias("lang"),
        has("source").cast("string").alias("source"),
    )


SCORED = "doc_id long, content_score double, metadata_score double, score double"


def _scored(batches, model: CoTrained, carried: list[str], read: list[str]):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            columns = [part.column(c).to_pylist() for c in read]
            x = np.stack([content_vector(t) for t in columns[0]])
            m = np.stack([metadata_vector(*r) for r in zip(*columns)])
            scores = [pa.array(s.astype(float)) for s in model.scores([x, m])]
            names = [*carried, "content_score", "metadata_score", "score"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *scores], names)


def score_quality(docs: DataFrame, model: CoTrained) -> DataFrame:
    """The columns of `docs` with content_score, metadata_score, score and accepted
    (score of at least a half) beside them; columns with these names are replaced, all
    others kept.

    lang and source may be null or missing. A null or empty text is scored as an empty
    page. Rows are scored each alone, with or without doc_id; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("content_score", "metadata_score", "score", "accepted")
    has = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    read = free_names(docs, "_text", "_lang", "_source")
    wide = docs.withColumns(dict(zip(read, (F.coalesce("text", F.lit("")), has("lang"), has("source")))))
    kept = docs.columns
    schema = docs.schema
    for c in ("content_score", "metadata_score", "score"):
        schema = schema.add(c, "double")
    scored = wide.mapInArrow(lambda batches: _scored(batches, model, kept, read), schema)
    return scored.withColumn("accepted", F.col("score") >= THRESHOLD)
