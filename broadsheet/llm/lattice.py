"""Language-model scores: the probability of a text summed over all its segmentations
into the pieces of an existing vocabulary.

A word is a walk through a lattice over its characters, whose arcs are the vocabulary's
pieces and nothing else. Their weights are the vocabulary's own scores, as shares of all;
a round of expectation and maximisation over the words of the training texts moves them
from there. The weights of all words and of the end of a text sum to one, so a text's
probability is the product of its words' and the end's, each word's the sum over all its
segmentations.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import MASK, crc_bucket, lower_words, small_batches, written

FOLDS = 10
ADD = 0.1
EM_ROUNDS = 1
# Weight of the vocabulary's own scores against the corpus, in words.
PRIOR = 2000.0
# The words with the highest counts, so many at most (about 100 bytes each), go to every
# task; the others meet their texts by a join.
FREQUENT = 200_000
# Words that a task counts before it passes their counts on.
COUNTED = 400_000
SPACE = "▁"
BASE = 0x9E3779B97F4A7C15
MINUS = -1e30


class Pieces:
    """The vocabulary as arrays: hashes of its pieces, in order, and log weights."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int]):
        self.pieces = pieces
        self.byte_ids = byte_ids
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int32)
        self.longest = max(map(len, pieces))
        self.initial = np.array([p.startswith(SPACE) for p in pieces])
        # Scores are ranks: the weight of a piece falls with its rank.
        self.prior = 1.0 / (3.0 - np.array(scores))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.single = {p for p in pieces if len(p) == 1}

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * BASE + ord(c) + 1) & MASK
        return h

    @classmethod
    @lru_cache(maxsize=2)
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores, byte_ids = [], [], {}
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = len(pieces)
            pieces.append(sp.id_to_piece(i))
            scores.append(max(sp.get_score(i), -1e6))
        return cls(pieces, scores, byte_ids)

    def normalised(self, expected: np.ndarray | None = None, stops: float = 0.0) -> tuple[np.ndarray, float]:
        """Log weights of the pieces and of the end of a word, given expected counts.
        Pieces that begin a word sum to one; the others sum to one with the end."""
        first, stop_share = self.initial, 0.3
        weights = self.prior / np.where(first, self.prior[first].sum(), self.prior[~first].sum()) * PRIOR
        weights[~first] *= 1 - stop_share
        stop = PRIOR * stop_share
        if expected is not None:
            weights, stop = weights + expected, stop + stops
        total = np.where(first, weights[first].sum(), weights[~first].sum() + stop)
        return np.log(weights / total), math.log(stop / (weights[~first].sum() + stop))

    def arcs(self, chars: np.ndarray):
        """(start, end, rows, piece) of all pieces found in the padded words, by start."""
        m, width = chars.shape
        for i in range(width):
            h = np.zeros(m, np.uint64)
            for j in range(i, min(width, i + self.longest)):
                with np.errstate(over="ignore"):
                    h = h * np.uint64(BASE) + chars[:, j] + np.uint64(1)
                maybe = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                real = self.hashes[at] == h[maybe]
                if real.any():
                    yield i, j + 1, maybe[real], self.ids[at[real]]


def _padded(lengths: np.ndarray) -> np.ndarray:
    """Widths to pad to: in steps of four, further apart beyond."""
    steep = np.exp(np.ceil(np.log(np.maximum(lengths, 1)) / 0.2) * 0.2)
    return np.where(lengths <= 40, -(-lengths // 4) * 4, np.ceil(steep)).astype(int)


def lattice(words: list[str], pieces: Pieces, log_p: np.ndarray, log_stop: float, expected: bool = False):
    """Log marginal probability of each word over its segmentations by the forward
    recursion; with `expected` also the expected uses of the pieces."""
    out, uses = np.zeros(len(words)), np.zeros(len(log_p))
    words = [SPACE + w for w in words]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    widths = _padded(lengths)
    for width in np.unique(widths):
        group = np.flatnonzero(widths == width)
        for part in np.array_split(group, -(-len(group) * width // 400_000)):
            text = np.array([words[k] for k in part], f"<U{width}")
            chars = text.view("<u4").reshape(len(part), width).astype(np.uint64)
            ends, rows = lengths[part], np.arange(len(part))
            forward = np.full((len(part), width + 1), MINUS)
            forward[:, 0] = 0.0
            found, lone = [], _fallback(words, part, pieces, log_p)
            for i, j, r, ids in _with_fallback(pieces.arcs(chars), lone):
                w = log_p[ids] if ids is not None else lone[i][1]
                forward[r, j] = np.logaddexp(forward[r, j], forward[r, i] + w)
                if expected:
                    found.append((i, j, r, ids, w))
            total = forward[rows, ends]
            out[part] = total + log_stop
            if expected:
                backward = np.full_like(forward, MINUS)
                backward[rows, ends] = 0.0
                for i, j, r, ids, w in reversed(found):
                    backward[r, i] = np.logaddexp(backward[r, i], backward[r, j] + w)
                for i, j, r, ids, w in found:
                    if ids is not None:
                        p = np.exp(forward[r, i] + w + backward[r, j] - total[r])
                        uses += np.bincount(ids, p, len(log_p))
    return (out, uses) if expected else out


def _fallback(words, part, pieces: Pieces, log_p) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Arcs over single characters that are no piece, by their bytes: start -> (rows,
    log weights)."""
    found: dict[int, list] = {}
    for row, k in enumerate(part):
        if not pieces.single.issuperset(words[k]):
            for i, c in enumerate(words[k]):
                if c not in pieces.single:
                    data = c.encode("utf-8", "surrogatepass")
                    found.setdefault(i, []).append((row, sum(log_p[pieces.byte_ids[x]] for x in data)))
    return {i: tuple(map(np.array, zip(*x))) for i, x in found.items()}


def _with_fallback(arcs, lone):
    """Arcs in the order of their starts, those by bytes among them."""
    left = sorted(lone)
    for arc in arcs:
        while left and left[0] <= arc[0]:
            i = left.pop(0)
            yield i, i + 1, lone[i][0], None
        yield arc
    for i in left:
        yield i, i + 1, lone[i][0], None


def _counted(batches):
    """Counts of words in training texts and in the others, of bounded memory."""
    counts = {True: Counter(), False: Counter()}

    def out(train: bool):
        n = pa.array(list(counts[train].values()), pa.int64())
        c = n if train else pa.array([0] * len(n), pa.int64())
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts[train]), pa.string()), c, n], ["word", "c", "n"])
        counts[train].clear()
        return batch

    for batch in batches:
        for text, train in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[train].update(lower_words(text.as_py()))
            if len(counts[train]) > COUNTED:
                yield out(train)
    for train in counts:
        yield out(train)


def _expected(batches, path: str, log_p, log_stop):
    pieces, uses, n = Pieces.load(path), None, 0
    for batch in batches:
        words = batch.column(0).to_pylist()
        if words:
            _, more = lattice(words, pieces, log_p, log_stop, expected=True)
            uses, n = more if uses is None else uses + more, n + len(words)
    if n:
        # The uses of the end of a word stand behind those of the pieces.
        ids = np.flatnonzero(uses > 1e-9)
        columns = [np.append(ids, len(uses)).astype(np.int32), np.append(uses[ids], float(n))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["piece", "uses"])


def _scored_words(batches, path: str, log_p, log_stop, stats: dict):
    pieces = Pieces.load(path)
    for batch in batches:
        if batch.num_rows:
            c = batch.column(1).to_numpy().astype(float)
            by_pieces = lattice(batch.column(0).to_pylist(), pieces, log_p, log_stop)
            score = (by_pieces + math.log1p(-stats["end"])) / math.log(10)
            base = np.log10((c + ADD) / stats["below"])
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(score), pa.array(base)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "c", "n", "score", "base"])


PART = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
     ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.string())),
     ("times", pa.list_(pa.int32()))]
)


def _scored_texts(batches, frequent, end_base: float, end_score: float, end_known: int):
    """Sums over a text's frequent words and its end, and its other words."""
    number, known_of, base_of, score_of = frequent.value
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = lower_words(text.as_py())
            at = np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words))
            rare = Counter([words[i] for i in np.flatnonzero(at < 0)])
            at = at[at >= 0]
            rows.append((
                row, doc_id, len(words) + 1, end_known + int(known_of[at].sum()), end_base + float(base_of[at].sum()),
                end_score + float(score_of[at].sum()), list(rare), list(rare.values()),
            ))
            row += 1
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), PART)]
            yield pa.RecordBatch.from_arrays(columns, schema=PART)


def word_statistics(rows: DataFrame) -> tuple[DataFrame, dict]:
    """The words of all texts with their counts in training texts (c) and in all (n), and
    the totals that weights and base scores need."""
    counts = rows.select("text", "train").mapInArrow(_counted, "word string, c long, n long")
    counts = written(counts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "words")
    t = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("N"), F.count_if(F.expr("c > 0")).alias("V"),
    ).first()
    ends = rows.filter("train").count()
    n = t.N + ends
    v = t.V + (1 if ends else 0)
    # The share of ends; without training texts it is a half, and without words all but all.
    end = min(ends / n, 1 - 1e-9) if n else 0.5
    stats = {"train_tokens": n, "V": v, "ends": ends, "end": end, "below": n + ADD * (v + 1)}
    return counts, stats


def fitted_weights(words: DataFrame, vocabulary: str, em_rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float]:
    """Log weights of the pieces and of the end of a word: the vocabulary's own, moved by
    the expected uses of the pieces in the distinct `words`."""
    pieces = Pieces.load(vocabulary)
    log_p, log_stop = pieces.normalised()
    for _ in range(em_rounds):
        # As many rows as the vocabulary has pieces come to the driver.
        got = (
            words.mapInArrow(lambda b, p=log_p, s=log_stop: _expected(b, vocabulary, p, s), "piece int, uses double")
            .groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        )
        uses = np.zeros(len(log_p) + 1)
        for r in got:
            uses[r.piece] = r.uses
        log_p, log_stop = pieces.normalised(uses[:-1], uses[-1])
    return log_p, log_stop


def _least_count(table: DataFrame) -> float:
    """The least count of the words that go to every task, so that these are FREQUENT at
    most. Counts are gathered by eighths of their powers of two: a few hundred rows."""
    step = F.floor(F.log2("n") * 8).cast("int")
    room, least = FREQUENT, math.inf
    for r in table.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = 2 ** (r.step / 8) - 1e-9
    return least


def lattice_scores(docs: DataFrame, vocabulary: str, folds: int = FOLDS, em_rounds: int = EM_ROUNDS) -> DataFrame:
    """One row for each row of `docs` (doc_id, text; other columns are not read): doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score and score, the last two log10.

    `vocabulary` is a sentencepiece model file; its pieces and their scores are used as
    they are, and with `em_rounds` 0 nothing else is. The file's scores are ranks, so a
    piece's share falls with its rank. Rows whose crc32(doc_id) mod `folds` is not 0 are
    learned from. Null
    and empty texts have the end token alone. A row without doc_id is scored but never
    learned from; it counts as held out. Rows that repeat count each for itself. No rows
    give no rows; without training rows all words have the weights of the vocabulary.
    """
    spark = docs.sparkSession
    small_batches(spark)
    bucket = crc_bucket("doc_id", folds)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(bucket != 0, F.lit(False)).alias("train"),
    )
    counts, stats = word_statistics(rows)
    log_p, log_stop = fitted_weights(counts.filter("c > 0").select("word"), vocabulary, em_rounds)
    table = counts.mapInArrow(
        lambda b: _scored_words(b, vocabulary, log_p, log_stop, stats),
        "word string, c long, n long, score double, base double",
    )
    table = written(table, "word-scores")
    common = table.filter(F.col("n") >= _least_count(table)).select("word", "c", "base", "score").toPandas()
    frequent = spark.sparkContext.broadcast((
        {w.encode(): i for i, w in enumerate(common.word)}, (common.c > 0).to_numpy(np.int64),
        common.base.to_numpy(), common.score.to_numpy(),
    ))
    end_base = math.log10((stats["ends"] + ADD) / stats["below"])
    end_score = math.log10(max(stats["end"], 1e-9))
    schema = ("row long, doc_id long, n_tokens long, n_known long, base double, score double, "
              "rare array<string>, times array<int>")  # fmt: skip
    parts = rows.select("doc_id", "text").mapInArrow(
        lambda b: _scored_texts(b, frequent, end_base, end_score, int(stats["ends"] > 0)), schema
    )
    parts = written(parts, "text-scores")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = rare.select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    more = (
        rare.join(table.select("word", "c", F.col("score").alias("s"), F.col("base").alias("b")), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"),
            F.sum(F.col("times") * F.col("b")).alias("b"), F.sum(F.col("times") * F.col("s")).alias("s"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    held_out = F.coalesce(bucket == 0, F.lit(True)).alias("held_out")
    return parts.drop("rare", "times").join(more, "row", "left").select(
        "doc_id", held_out, "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"),
        F.lit(stats["train_tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + zero("b")).alias("base_score"), (F.col("score") + zero("s")).alias("score"),
    )
