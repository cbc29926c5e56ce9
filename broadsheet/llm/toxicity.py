"""Toxicity by multiple-instance learning: labels are of documents, scores of sentences.

A document is toxic if one of its sentences is: its score is the noisy-or of theirs,
1 - prod(1 - p). The sentence model, a logistic one over words, is trained through that
from document labels alone, and so can point at the sentences that make a document toxic.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import crc_bucket, small_batches, written

FOLDS = 5
# Bounds on the labelled rows of each class that the model is fitted on, chosen by hash;
# rows are weighted back to the shares of the classes among all labels.
MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
# Words the model may use: those whose document shares differ most between the classes,
# by standard errors.
MAX_WORDS, MIN_Z = 20_000, 3.5
STEPS, RATE, PENALTY = 400, 0.1, 1e-3
THRESHOLD = 0.5

SENTENCES = re.compile(r"[^.!?\n]*[^\s.!?][^.!?\n]*[.!?]*")
TOKENS = re.compile(r"\w+")


def spans(text: str | None) -> list[tuple[int, int]]:
    """Sentences as (start, end): up to a mark that ends one, or the end of the line."""
    return [m.span() for m in SENTENCES.finditer(text)] if text else []


def _sample(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[DataFrame, dict[int, float]]:
    """Labelled rows outside the held-out fold, at most so many of each class, and the
    weight of a row of each class."""
    label = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    label = label.filter(F.col("toxic").isin(0, 1) & (crc_bucket("doc_id", folds) != 0))
    n = {r.toxic: r["count"] for r in label.groupBy("toxic").count().collect()}
    bounds = {1: MAX_TOXIC, 0: MAX_CLEAN}
    parts = [label.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(m) for k, m in bounds.items()]
    # At most MAX_TOXIC + MAX_CLEAN pairs of numbers go to every task.
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(parts[0].union(parts[1])), "doc_id")
    weights = {k: max(1.0, n.get(k, 0) / m) for k, m in bounds.items()}
    return written(rows.select("doc_id", "text", F.col("toxic").cast("int")), "labelled"), weights


def _words_of_classes(batches):
    for batch in batches:
        rows = []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows += ((w, toxic, 1 - toxic) for w in set(TOKENS.findall(text.lower())))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["word", "toxic", "clean"])


def _instances(batches, index: dict[str, int]):
    """Words of each sentence by number; sentences without any are only counted."""
    for batch in batches:
        out = []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = [[index[w] for w in set(TOKENS.findall(text[a:b].lower())) if w in index] for a, b in spans(text)]
            full = [f for f in found if f]
            out.append((toxic, max(len(found), 1) - len(full), [x for f in full for x in f], [len(f) for f in full]))
        if out:
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "blank", "words", "lengths"])


def fit_noisy_or(toxic, blank, words, lengths, n_words: int, weights, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Word weights and bias that make the labels of the bags likeliest, by gradient
    steps of adaptive size."""
    bag_of = np.repeat(np.arange(len(toxic)), [len(x) for x in lengths])
    lengths = np.concatenate([np.asarray(x, np.int64) for x in lengths] + [np.zeros(0, np.int64)])
    words = np.concatenate([np.asarray(x, np.int64) for x in words] + [np.zeros(0, np.int64)])
    sentence_of = np.repeat(np.arange(len(lengths)), lengths)
    n_bags, n_sentences = len(toxic), len(lengths)
    w, bias = start.astype(float).copy(), -5.0
    moments = np.zeros((2, n_words + 1))
    weights = weights / weights.sum()
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sentence_of, w[words], n_sentences)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + math.exp(-bias))
        clean = np.bincount(bag_of, np.log1p(-np.minimum(p, 1 - 1e-12)), n_bags) + blank * math.log1p(-p0)
        score = -np.expm1(clean)
        # Derivative of the loss by z is p for a clean bag and -p * clean / score else.
        pull = weights * np.where(toxic == 1, -np.exp(clean) / np.maximum(score, 1e-9), 1.0)
        g = pull[bag_of] * p
        grad = np.append(np.bincount(words, g[sentence_of], n_words) + PENALTY * w / len(toxic) ** 0.5,
                         g.sum() + (pull * blank).sum() * p0)
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


class ToxicityModel:
    """Weights of words and a bias: all there is to score a text."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def sentence_scores(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, score) of each sentence; an empty text is one empty sentence."""
        out, weights = [], self.weights
        for a, b in spans(text) or [(0, 0)]:
            z = self.bias + sum(weights[w] for w in set(TOKENS.findall(text[a:b].lower())) & weights.keys()) if b else self.bias
            out.append((a, b, 1 / (1 + math.exp(-max(min(z, 500.0), -500.0)))))
        return out


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> ToxicityModel:
    """Fit on `labels` (doc_id, toxic) of rows whose crc32(doc_id) mod `folds` is not 0.
    Without labels of both classes the model knows no words."""
    rows, class_weights = _sample(docs, labels, folds)
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    a, b = sizes.get(1, 0), sizes.get(0, 0)
    if not a or not b:
        share = a / max(a + b, 1)
        return ToxicityModel({}, 5.0 if share > 0.5 else -5.0)
    df = (
        rows.select("text", "toxic").mapInArrow(_words_of_classes, "word string, toxic long, clean long")
        .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).filter("t + c >= 3")
    )
    share = (F.col("t") + F.col("c")) / (a + b)
    error = F.sqrt(share * (1 - share) * (1 / a + 1 / b) + 1e-12)
    z = F.abs(F.col("t") / a - F.col("c") / b) / error
    best = df.withColumn("z", z).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(MAX_WORDS).toPandas()
    index = {w: i for i, w in enumerate(best.word)}
    # The sampled rows again, as numbers of words they share with the chosen ones.
    bags = rows.select("text", "toxic").mapInArrow(
        lambda batches: _instances(batches, index), "toxic int, blank int, words array<int>, lengths array<int>"
    ).toPandas()
    start = 0.5 * np.log((best.t / a + 0.5 / a) / (best.c / b + 0.5 / b)).to_numpy() if len(best) else np.zeros(0)
    toxic = bags.toxic.to_numpy()
    weights = np.where(toxic == 1, class_weights[1], class_weights[0])
    w, bias = fit_noisy_or(toxic, bags.blank.to_numpy(), bags.words, bags.lengths, len(index), weights, start)
    return ToxicityModel({x: float(w[i]) for x, i in index.items()}, bias)


SCORED = pa.schema(
    [("doc_id", pa.int64()), ("score", pa.float64()), ("n_sentences", pa.int64()),
     ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]
)


def _scored(batches, model: ToxicityModel):
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = model.sentence_scores(text)
            clean = sum(math.log1p(-min(p, 1 - 1e-12)) for _, _, p in found)
            offending = [{"start": a, "end": b, "score": p} for a, b, p in found if p >= THRESHOLD]
            rows.append((doc_id, -math.expm1(clean), len(found), offending))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCORED)], schema=SCORED)


def score_toxicity(docs: DataFrame, model: ToxicityModel, folds: int = FOLDS) -> DataFrame:
    """One row for each row of `docs` (doc_id, text; other columns are not read): doc_id,
    held_out, score, predicted, n_sentences and the places and scores of the sentences
    that offend.

    A null or empty text counts as one empty sentence. A row without doc_id is scored
    and counts as held out. Rows are scored each alone; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _scored(batches, model),
        "doc_id long, score double, n_sentences long, offending array<struct<start: int, end: int, score: double>>",
    )
    return rows.select(
        "doc_id", F.coalesce(crc_bucket("doc_id", folds) == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_sentences", "offending",
    )
