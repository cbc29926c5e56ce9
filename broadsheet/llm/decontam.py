"""Benchmark decontamination by latent semantic retrieval.

Passages of the corpus are TF-IDF vectors over all of the benchmark's terms. A randomised
singular value decomposition of the matrix of passages, computed where the passages are,
gives the latent space: it is fitted on all of them and on the benchmark's own. Its rounds
need of the passages only how often two terms share one, which is counted once. Documents
that lack the words for any item hold none, whatever their order; of all others, every passage close to a benchmark passage by cosine
is a candidate, and a longest common subsequence of words, and for paraphrases the answer,
decide.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import document_keys, free_names, identified, small_batches, written
from broadsheet.operators.joins import broadcast_if_few

# A passage is two blocks of words; passages begin at every block.
BLOCK = 16
WIDTH = 2 * BLOCK
RANK, OVERSAMPLE, POWER_ROUNDS = 96, 16, 2
COSINE = 0.5
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.8
MIN_ANSWER = 3
# Items that are searched for in one pass: their terms go to every task, about 100 bytes
# each. A longer benchmark takes one pass for each so many items.
ITEMS = 20_000

TOKENS = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.!?\n]+")


def terms_of(text: str) -> list[str]:
    return TOKENS.findall(text.lower())


class Item:
    """A benchmark passage: its words, and those of its answer (the column `answer`, or
    its last sentence that has some words)."""

    def __init__(self, item_id: int, text: str | None, answer: str | None = None):
        self.item_id, self.words = item_id, terms_of(text or "")
        if answer is None:
            sentences = [s for s in SENTENCE_END.split(text or "") if len(terms_of(s)) >= MIN_ANSWER]
            answer = sentences[-1] if sentences else ""
        self.answer = terms_of(answer)

    def segments(self) -> Iterator[list[str]]:
        last = max(0, len(self.words) - BLOCK)
        for at in range(0, max(1, last), BLOCK):
            yield self.words[at : at + WIDTH]


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence: a row of the table in one integer."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if m := places.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


# Bytes of Latin-1 text: letters, digits and _ in lower case, all else as a space.
LATIN = bytes(ord(chr(i).lower()) if TOKENS.match(chr(i)) else 32 for i in range(256))


def in_latin(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Of a vocabulary the words that Latin-1 text can have."""
    return {w.encode("latin-1"): i for w, i in vocabulary.items() if max(w) <= "\xff"}


def _numbers(text: str, vocabulary: dict[str, int], latin: dict[bytes, int]) -> np.ndarray:
    """The numbers of `terms_of` a text; Latin-1 text is parted as bytes."""
    try:
        words, numbers = text.encode("latin-1").translate(LATIN).split(), latin
    except UnicodeEncodeError:
        words, numbers = terms_of(text), vocabulary
    return np.fromiter(map(numbers.get, words, repeat(-1)), np.int32, len(words))


def _block_counts(batches, n_terms: int):
    """Blocks that have each term, and all blocks (as term -1)."""
    df, total = np.zeros(n_terms + 1, np.int64), 0
    for batch in batches:
        for _, docs in _chunks(batch, 0):
            rows = np.concatenate([np.pad(d, (0, -len(d) % BLOCK), constant_values=-1) for d in docs]).reshape(-1, BLOCK)
            rows.sort(axis=1)
            fresh = np.ones(rows.shape, bool)
            fresh[:, 1:] = rows[:, 1:] != rows[:, :-1]
            df += np.bincount(rows[fresh] + 1, minlength=len(df))
            total += len(rows)
    found = np.flatnonzero(df[1:])
    columns = [np.append(found, -1), np.append(df[1:][found], total)]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "n"])


def _numbered(batches, shared):
    """The documents as numbers of the benchmark's terms, -1 for any other word."""
    vocabulary = shared.value
    latin = in_latin(vocabulary)
    for batch in batches:
        ids = [_numbers(text.as_py(), vocabulary, latin) for text in batch.column(2)]
        ends = np.append(0, np.cumsum([len(x) for x in ids]))
        words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids or [np.zeros(0, np.int32)])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), words], ["_id", "_version", "terms"])


class Passages:
    """Rows of the matrix of passages, for some documents: a passage begins at every
    block, and its row is that of its block and of the next one of its document."""

    def __init__(self, docs: list[np.ndarray]):
        blocks = np.array([-(-len(d) // BLOCK) for d in docs], np.int64)
        self.first = np.cumsum(blocks) - blocks
        self.doc = np.repeat(np.arange(len(docs)), blocks)
        self.start = (np.arange(len(self.doc)) - self.first[self.doc]) * BLOCK
        self.followed = np.append(self.doc[1:] == self.doc[:-1], False)[: len(self.doc)]
        term = np.concatenate(docs)
        block = np.concatenate([f + np.arange(len(d)) // BLOCK for f, d in zip(self.first, docs)])
        self.block, self.term = block[term >= 0], term[term >= 0]

    def __len__(self) -> int:
        return len(self.doc)

    def times(self, weighted: np.ndarray) -> np.ndarray:
        """The passages' rows times a matrix whose rows are weighted by idf already."""
        y = np.zeros((len(self) + 1, weighted.shape[1]), np.float32)
        if len(self.term):
            starts = np.flatnonzero(np.append(True, self.block[1:] != self.block[:-1]))
            counts = np.diff(np.append(starts, len(self.block)))
            # The first terms of all blocks, the second ones of those that have two, and so on.
            order = np.argsort(-counts, kind="stable")
            starts, left = starts[order], np.cumsum(np.bincount(counts)[::-1])[::-1]
            sums = weighted[self.term[starts]]
            for i in range(1, counts.max()):
                sums[: left[i + 1]] += weighted[self.term[starts[: left[i + 1]] + i]]
            y[self.block[starts]] = sums
        y[:-1][self.followed] += y[1:][self.followed]
        return y[:-1]

    def transposed_times(self, left: np.ndarray, out: np.ndarray) -> None:
        """Adds the transposed rows times `left`, without idf, to `out`."""
        if len(self.term):
            both = left.copy()
            both[1:][self.followed[:-1]] += left[:-1][self.followed[:-1]]
            kind = np.uint16 if len(out) < 1 << 16 else np.int32
            order = np.argsort(self.term.astype(kind), kind="stable")
            t = self.term[order]
            starts = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            out[t[starts]] += np.add.reduceat(both[self.block[order]], starts, axis=0)


# Words of the documents that are worked on at once.
CHUNK = 1 << 16


def _chunks(batch, column: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The documents of a batch in parts of bounded size, each with its first row."""
    terms = batch.column(column)
    ends, words = terms.offsets.to_numpy(), terms.values.to_numpy()
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK, side="right")) - 1)
        yield at, [words[ends[i] : ends[i + 1]] for i in range(at, end)]
        at = end


SLICE = 256
# Up to so many terms the products of the matrix of passages with itself are counted, in one
# pass over the passages: 150 MB in a task. For more terms each round is such a pass.
TOGETHER = 6_144


def _together(batches, n_terms: int):
    """A'A without idf, over the task's passages: how often two terms stand in a passage
    together. In slices of terms, compressed."""
    pairs, own = np.zeros(n_terms * n_terms, np.int32), np.zeros(n_terms, np.int32)
    for batch in batches:
        for _, docs in _chunks(batch, 0):
            p = Passages(docs)
            # A block is in the passage that begins with it, and in the one before.
            twice = np.append(False, p.followed[:-1])[p.block]
            np.add.at(own, p.term, 1 + twice.astype(np.int32))
            # Blocks numbered so that only those of a document lie next to each other.
            place, term = p.block + p.doc[p.block], p.term.astype(np.int64)
            first, apart = np.arange(len(term)), 1
            while len(first := first[first < len(term) - apart]):
                gap = place[first + apart] - place[first]
                first, gap = first[gap <= 1], gap[gap <= 1]
                a, b = term[first], term[first + apart]
                key = np.minimum(a, b) * n_terms + np.maximum(a, b)
                np.add.at(pairs, key, np.int32(1))
                np.add.at(pairs, key[(gap == 0) & twice[first]], np.int32(1))
                apart += 1
    pairs = pairs.reshape(n_terms, n_terms)
    for i in range(0, n_terms, SLICE):
        rows = pairs[i : i + SLICE] + pairs[:, i : i + SLICE].T
        at = np.arange(len(rows))
        rows[at, i + at] += own[i : i + SLICE]
        yield _slice(i // SLICE, rows)


def _slice(i: int, rows: np.ndarray) -> pa.RecordBatch:
    data = zlib.compress(np.ascontiguousarray(rows).tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([data])], ["slice", "data"])


def _summed(batches):
    """Sums of compressed slices that lie next to each other, one at a time in memory."""
    held, total = None, None
    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            more = np.frombuffer(zlib.decompress(data.as_buffer()), np.int32).astype(np.int64)
            if i == held:
                total = total + more
            else:
                if held is not None:
                    yield _slice(held, total)
                held, total = i, more
    if held is not None:
        yield _slice(held, total)


def _multiplied(batches, shared):
    """Slices of A'A, as counted, times the basis."""
    idf, basis = shared.value
    weighted = basis.astype(float) * idf[:, None]
    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = np.frombuffer(zlib.decompress(data.as_buffer()), np.int64).reshape(-1, len(idf))
            out = rows.astype(float) @ weighted * idf[i * SLICE : i * SLICE + len(rows), None]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([out.tobytes()])], ["slice", "data"])


def _products(batches, shared):
    """A'A times the basis, summed over the task's passages, in slices of terms."""
    idf, basis = shared.value
    weighted = basis * idf[:, None]
    out = np.zeros(basis.shape, np.float64)
    for batch in batches:
        for _, docs in _chunks(batch, 0):
            p = Passages(docs)
            p.transposed_times(p.times(weighted), out)
    out *= idf[:, None]
    slices = range(0, len(out), SLICE)
    columns = [pa.array([i // SLICE for i in slices], pa.int32()), pa.array([out[i : i + SLICE].tobytes() for i in slices])]
    yield pa.RecordBatch.from_arrays(columns, ["slice", "data"])


def _added(batches):
    """Sums of slices that lie next to each other, one at a time in memory."""
    held, total = None, None
    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            more = np.frombuffer(data)
            if i == held:
                total = total + more
            else:
                if held is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([total.tobytes()])], ["slice", "data"])
                held, total = i, more
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([total.tobytes()])], ["slice", "data"])


def latent_space(hits: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The first right singular vectors (terms by rank) of the matrix of passages, by
    subspace iteration from a random start. Each round is one pass over the passages, or
    over the counts of terms that stand together in them, which is the same product; what
    comes to the driver is terms by rank, however many passages there are."""
    n, size = len(idf), min(len(idf), rank + OVERSAMPLE)
    basis = np.random.default_rng(7).standard_normal((n, size)).astype(np.float32)
    product = basis
    parts = max(1, min(-(-n // SLICE), 64))
    schema = "slice int, data binary"

    def by_slice(sums: DataFrame) -> DataFrame:
        return sums.repartition(parts, "slice").sortWithinPartitions("slice")

    if n <= TOGETHER:
        # Each task gives all of the counts: tasks in proportion to the cores, not to the input.
        tasks = max(8, 2 * hits.sparkSession.sparkContext.defaultParallelism)
        counts = hits.select("terms").coalesce(tasks).mapInArrow(lambda rows: _together(rows, n), schema)
        counts = written(by_slice(counts).mapInArrow(_summed, schema), "together")
    for _ in range(POWER_ROUNDS + 1):
        shared = hits.sparkSession.sparkContext.broadcast((idf, basis))
        if n <= TOGETHER:
            total = counts.mapInArrow(lambda rows, b=shared: _multiplied(rows, b), schema)
        else:
            sums = hits.select("terms").mapInArrow(lambda rows, b=shared: _products(rows, b), schema)
            total = by_slice(sums).mapInArrow(_added, schema)
        got = {r.slice: np.frombuffer(r.data) for r in total.collect()}
        product = np.concatenate([got[i].reshape(-1, size) for i in sorted(got)]) if got else np.zeros((n, size))
        previous, basis = basis, np.linalg.qr(product)[0].astype(np.float32)
    values, turn = np.linalg.eigh(previous.T.astype(float) @ product)
    best = np.argsort(-values)[: min(rank, size)]
    best = best[values[best] > 1e-9]
    if not len(best):
        return np.eye(n, min(rank, n), dtype=np.float32)
    return (previous @ turn[:, best]).astype(np.float32)


# Documents by items that are looked at in one go: 32 MB of counts.
CELLS = 4_000_000


class Postings:
    """For each term the items that have it, and how often."""

    def __init__(self, words: list[list[int]], n_terms: int):
        keys = np.array([t * len(words) + k for k, ws in enumerate(words) for t in ws], np.int64)
        keys, self.count = np.unique(keys, return_counts=True)
        term, self.item = np.divmod(keys, max(1, len(words)))
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.n_items = len(words)

    def held(self, docs: list[np.ndarray]) -> np.ndarray:
        """At most so many words of each item can stand in each document: those that the
        document has at all."""
        terms = [np.unique(d[d >= 0]) for d in docs]
        term, doc = np.concatenate(terms), np.repeat(np.arange(len(docs)), [len(t) for t in terms])
        n = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        key = np.repeat(doc, n) * self.n_items + self.item[at]
        return np.bincount(key, self.count[at], len(docs) * self.n_items).reshape(len(docs), -1)


class Query:
    """The benchmark's side of the search: what each task needs to know of it."""

    def __init__(self, items: list[Item], vocabulary: dict[str, int], idf: np.ndarray, space: np.ndarray):
        self.ids = [item.item_id for item in items]
        self.words = [[vocabulary[w] for w in item.words] for item in items]
        self.answers = [[vocabulary[w] for w in item.answer] for item in items]
        self.weighted = space * idf[:, None]
        queries, item_of = [], []
        for k, item in enumerate(items):
            for segment in item.segments():
                y = self.weighted[[vocabulary[w] for w in segment]].sum(axis=0)
                if (norm := np.linalg.norm(y)) > 1e-6:
                    queries.append(y / norm)
                    item_of.append(k)
        self.queries = np.array(queries, np.float32).reshape(-1, space.shape[1])
        self.item_of = np.array(item_of, np.int64)
        self.in_words, self.in_answers = (Postings(w, len(idf)) for w in (self.words, self.answers))
        self.distinct = [np.unique(np.array(w, np.int32), return_counts=True) for w in self.words]
        self.n_words, self.n_answers = (np.array([len(w) for w in x]) for x in (self.words, self.answers))

    def possible(self, docs: list[np.ndarray]) -> np.ndarray:
        """Whether a document has words enough for an item, in whatever order: without
        them it cannot hold the item, close or not."""
        common = self.in_words.held(docs)
        out = common >= PARAPHRASE * self.n_words - 1e-6
        # The answer's words matter for few documents.
        some = np.flatnonzero(out.any(axis=1))
        if len(some):
            given = self.in_answers.held([docs[i] for i in some])
            told = (self.n_answers > 0) & (given >= ANSWER * self.n_answers - 1e-6)
            out[some] &= told | (common[some] >= VERBATIM * self.n_words - 1e-6)
        return out

    def in_one_place(self, doc: np.ndarray, k: int) -> bool:
        """Whether words enough for an item, each as often as the item has it at most, stand
        as close together as the longest stretch that is compared with it."""
        terms, n = self.distinct[k]
        at = np.searchsorted(terms, doc)
        hit = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == doc)
        blocks = len(doc) // BLOCK + 1
        held = np.bincount(hit // BLOCK * len(terms) + at[hit], minlength=blocks * len(terms)).reshape(blocks, -1)
        # A stretch of so many words touches so many blocks.
        wide = min(blocks, (WIDTH + 3 * len(self.words[k])) // BLOCK + 2)
        upto = np.concatenate([np.zeros((1, len(terms)), np.int64), np.cumsum(held, axis=0)])
        common = np.minimum(upto[wide:] - upto[: len(upto) - wide], n).sum(axis=1)
        return bool(common.max() >= PARAPHRASE * self.n_words[k] - 1e-6)

    def candidates(self, docs: list[np.ndarray], threshold: float) -> Iterator[tuple[int, int, list[tuple[int, float]]]]:
        """(document, item, passages): of documents with words enough for an item in one
        place, the passages that are close to a segment of it. Only these are projected."""
        step = max(1, CELLS // max(1, len(self.ids)))
        for at in range(0, len(docs), step):
            possible = self.possible(docs[at : at + step])
            for doc, k in zip(*np.nonzero(possible)):
                possible[doc, k] = self.in_one_place(docs[at + doc], k)
            some = np.flatnonzero(possible.any(axis=1))
            if len(some):
                found = self.near(Passages([docs[at + i] for i in some]), possible[some], threshold)
                for (doc, k), passages in found.items():
                    yield int(at + some[doc]), k, passages

    def near(self, p: Passages, possible: np.ndarray, threshold: float) -> dict[tuple[int, int], list[tuple[int, float]]]:
        """First words and cosines of the passages that are close to a segment of an item,
        by document and item."""
        out: dict[tuple[int, int], list[tuple[int, float]]] = {}
        y = p.times(self.weighted)
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
        rows = np.arange(len(p))
        step = max(1, CELLS // max(1, len(self.queries)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            cosine = y[part] @ self.queries.T
            r, q = np.nonzero((cosine >= threshold) & possible[p.doc[part]][:, self.item_of])
            for doc, item, start, c in zip(
                p.doc[part[r]].tolist(), self.item_of[q].tolist(), p.start[part[r]].tolist(), cosine[r, q].tolist()
            ):
                out.setdefault((doc, item), []).append((start, c))
        return out


def _regions(starts: list[int], around: int, n: int) -> list[tuple[int, int]]:
    """Stretches of words about candidate passages, those that overlap joined."""
    out: list[tuple[int, int]] = []
    for s in sorted(starts):
        a, b = max(0, s - around), min(n, s + WIDTH + around)
        if out and a <= out[-1][0] + around:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


LEAKS = pa.schema(
    [("_id", pa.int64()), ("_version", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()),
     ("common", pa.float64()), ("answer", pa.float64()), ("kind", pa.string())]
)


def _judged(batches, shared, threshold):
    query = shared.value
    for batch in batches:
        rows = []
        for at, docs in _chunks(batch, 2):
            for doc, k, passages in query.candidates(docs, threshold):
                item, answer, words = query.words[k], query.answers[k], docs[doc]
                best = (0.0, 0.0)
                for a, b in _regions([start for start, _ in passages], len(item), len(words)):
                    region = words[a:b].tolist()
                    common = common_subsequence(item, region) / len(item)
                    given = common_subsequence(answer, region) / len(answer) if answer else 0.0
                    best = max(best, (common, given))
                if best[0] >= VERBATIM:
                    kind = "verbatim"
                elif best[0] >= PARAPHRASE and best[1] >= ANSWER:
                    kind = "paraphrase"
                else:
                    continue
                keys = (batch.column(c)[at + doc].as_py() for c in (0, 1))
                rows.append((*keys, query.ids[k], max(c for _, c in passages), *best, kind))
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), LEAKS)]
            yield pa.RecordBatch.from_arrays(columns, schema=LEAKS)


def _search(own: DataFrame, items: list[Item], threshold: float) -> DataFrame:
    context = own.sparkSession.sparkContext
    vocabulary = {w: i for i, w in enumerate(sorted({w for item in items for w in (*item.words, *item.answer)}))}
    shared = context.broadcast(vocabulary)
    hits = own.select("_id", "_version", "text").mapInArrow(
        lambda b: _numbered(b, shared), "_id long, _version long, terms array<int>"
    )
    hits = written(hits, "passages")
    counts = hits.select("terms").mapInArrow(lambda b: _block_counts(b, len(vocabulary)), "term long, n long")
    # A number for each term of the benchmark comes to the driver.
    df, total = np.zeros(len(vocabulary), np.int64), 1
    for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r.term >= 0:
            df[r.term] = r.n
        else:
            total = max(1, r.n)
    idf = np.log((1.0 + total) / (1.0 + df)).astype(np.float32) + np.float32(1e-3)
    own_rows = own.sparkSession.createDataFrame([([vocabulary[w] for w in item.words],) for item in items], "terms array<int>")
    fitted_on = hits.select("terms").union(own_rows)
    query = context.broadcast(Query(items, vocabulary, idf, latent_space(fitted_on, idf)))
    leaks = hits.mapInArrow(
        lambda b: _judged(b, query, threshold),
        "_id long, _version long, item_id long, cosine double, common double, answer double, kind string",
    )
    # A document that repeats is found with each of its rows.
    return written(leaks.dropDuplicates(["_id", "_version", "item_id"]), "leaks")


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = COSINE) -> DataFrame:
    """(_id, _version, item_id, cosine, common, answer, kind): the documents of `docs`
    (doc_id, text) that hold a passage of `benchmark` (item_id, text, and answer where
    there is one), with the keys that `identified` gives them.

    A document holds an item if at least 80 % of its words stand in their order near a
    passage close to it ("verbatim"), or at least 50 % and 80 % of those of its answer
    ("paraphrase"). Null and empty texts hold nothing; items without words are held by
    nothing; items that repeat are each reported. Rows that repeat are one document. An
    empty table on either side gives no rows.
    """
    small_batches(docs.sparkSession)
    own = identified(docs).select("_id", "_version", F.coalesce("text", F.lit("")).alias("text"))
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long"), "text", answer.alias("answer")).orderBy("item_id", "text")
    out, block = None, []
    # The benchmark is the query side: it is read in blocks, each searched for in turn.
    for row in rows.toLocalIterator():
        item = Item(row.item_id, row.text, row.answer)
        if item.words:
            block.append(item)
        if len(block) == ITEMS:
            found = _search(own, block, threshold)
            out, block = found if out is None else out.union(found), []
    if block:
        found = _search(own, block, threshold)
        out = found if out is None else out.union(found)
    if out is None:
        schema = "_id long, _version long, item_id long, cosine double, common double, answer double, kind string"
        return docs.sparkSession.createDataFrame([], schema)
    return out


def leaking_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = COSINE) -> DataFrame:
    """One row for each pair of document and benchmark item it holds: doc_id, item_id,
    cosine, common, answer, kind. See `find_leaks`."""
    leaks = find_leaks(docs, benchmark, threshold)
    # `_id` is doc_id but for documents without one.
    nulls = F.xxhash64(F.lit(True), F.coalesce("text", F.lit("")))
    unnamed = docs.filter("doc_id is null").select(nulls.alias("_version"), F.lit(-1).cast("long").alias("_id")).distinct()
    unnamed = unnamed.withColumn("_null", F.lit(True))
    joined = leaks.join(broadcast_if_few(unnamed), ["_id", "_version"], "left")
    doc_id = F.when(F.col("_null").isNull(), F.col("_id")).alias("doc_id")
    return joined.select(doc_id, "item_id", "cosine", "common", "answer", "kind")


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = COSINE) -> DataFrame:
    """`docs` without the documents that hold a benchmark passage; all columns are kept,
    whatever their names."""
    leaks = find_leaks(docs, benchmark, threshold).select("_id", "_version").distinct()
    keys = free_names(docs, "_id", "_version")
    made = dict(zip(keys, document_keys()))
    leaks = leaks.withColumnsRenamed(dict(zip(("_id", "_version"), keys)))
    return docs.withColumns(made).join(broadcast_if_few(leaks), keys, "left_anti").select(*docs.columns)
