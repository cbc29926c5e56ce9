"""Hard negatives by Four-Russians scoring.

Components are whole numbers, and a candidate is kept as the bits of its components: for
each bit and each group of eight components one byte. For an anchor, the sums of all
subsets of the eight components of a group are tabled once, so a byte looks up what eight
components add to the score; doubling from bit to bit gives the exact inner product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import small_batches, written
from broadsheet.llm.tiles import Best, dealt, distinct_vectors, in_batches, rows_by_key, tile_results

# How components become whole numbers, what a query's anchors are and how
# labels are changed; then how many positives and negatives, and the window of a negative.
SCALE, EVERY, TURNED, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES, PERCENT = 5, 5, 80
GROUP = 8
# Whole components stay within 2**24, or sums could leave 64 bits.
LIMIT = 1 << 24
# Anchors to a set of tables: 256 KB for a group of eight components, which a core's cache holds.
SUBBLOCK = 256

BITS = "vec_id long, dim int, label long, bits int, planes binary"
POSITIVE_LISTS = pa.schema([
    ("vec_id", pa.int64()), ("positive_ids", pa.list_(pa.int64())), ("positive_scores", pa.list_(pa.int64())),
])
MINED = pa.schema([
    ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
    ("positive_score", pa.int64()), ("negative_score", pa.int64()),
])


def planes(whole: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """How many bits each row needs in two's complement, and its bits: for each bit from
    the lowest to the sign, a byte for each group of eight components, the first component
    lowest. Missing components of the last group are 0."""
    n, dim = whole.shape
    padded = np.zeros((n, -(-dim // GROUP) * GROUP), np.int64)
    padded[:, :dim] = whole
    # ~x has as many bits as x, but for the sign.
    size = np.where(padded < 0, ~padded, padded).max(axis=1, initial=0)
    bits = np.frexp(size.astype(np.float64))[1] + 1
    out = []
    for row, b in zip(padded, bits):
        each = (row >> np.arange(b)[:, None] & 1).astype(np.uint8)
        out.append(np.packbits(each, axis=1, bitorder="little").tobytes())
    return bits.astype(np.int32), out


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * values.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def _packed(batches):
    for batch in batches:
        ids, labels = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        lists = batch.column(1)
        values, starts = whole_numbers(lists.flatten().to_numpy()), np.cumsum(np.r_[0, lists.value_lengths().to_numpy()])
        dims = np.diff(starts)
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            bits, packed = planes(values[starts[own][:, None] + np.arange(dim)])
            columns = [ids[own], np.full(len(own), dim, np.int32), labels[own], bits, packed]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["vec_id", "dim", "label", "bits", "planes"])


def matrix(rows) -> np.ndarray:
    """The bytes of all rows as [bit, group, row], the sign repeated up to the longest."""
    bits = rows.column("bits").to_numpy()
    packed = np.array(rows.column("planes").to_pylist(), object)
    most = int(bits.max())
    groups = len(packed[0]) // int(bits[0])
    out = np.empty((most, groups, len(bits)), np.uint8)
    for b in np.unique(bits):
        own = np.flatnonzero(bits == b)
        each = np.frombuffer(b"".join(packed[own]), np.uint8).reshape(len(own), b, groups).transpose(1, 2, 0)
        out[:b, :, own] = each
        out[b:, :, own] = each[-1]
    return out


def numbers(bytes_: np.ndarray) -> np.ndarray:
    """The components that [bit, group, row] stands for, as [row, component]."""
    bits = np.unpackbits(bytes_, axis=1, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(len(bits), dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.tensordot(weights, bits, 1).T


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """[group, byte, anchor]: what the components of a group that a byte names add up to."""
    tables = np.zeros((anchors.shape[1] // GROUP, 1 << GROUP, len(anchors)), dtype)
    for g in range(len(tables)):
        for bit in range(GROUP):
            half = 1 << bit
            tables[g, half : 2 * half] = tables[g, :half] + anchors[:, GROUP * g + bit].astype(dtype)
    return tables


def scores(tables: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    """[candidate, anchor]: exact inner products, by lookups, shifts and additions."""
    total = np.zeros((bytes_.shape[2], tables.shape[2]), tables.dtype)
    looked_up = np.empty_like(total)
    for bit in range(len(bytes_) - 1, -1, -1):
        total <<= 1
        # The highest bit is the sign and counts downwards.
        add = np.subtract if bit == len(bytes_) - 1 else np.add
        for table, index in zip(tables, bytes_[bit]):
            np.take(table, index, axis=0, out=looked_up, mode="clip")
            add(total, looked_up, out=total)
    return total


class Anchors:
    """Anchors of a tile with their tables, in parts that a core's cache holds."""

    def __init__(self, rows):
        self.ids = rows.column("vec_id").to_numpy()
        self.whole = numbers(matrix(rows))
        self.most = int(np.abs(self.whole).sum(axis=1).max())
        self.parts, self.kind = [], None

    def scored(self, rows):
        """(first anchor, scores) of each part against the rows."""
        bytes_ = matrix(rows)
        # No sum on the way exceeds the largest component by the sum of an anchor's.
        kind = np.int32 if self.most << len(bytes_) < 1 << 31 else np.int64
        if kind is not self.kind:
            cuts = range(0, len(self.ids), SUBBLOCK)
            self.kind, self.parts = kind, [subset_sums(self.whole[a : a + SUBBLOCK], kind) for a in cuts]
        for k, tables in enumerate(self.parts):
            yield k * SUBBLOCK, scores(tables, bytes_)


def _lists(keys: dict[str, np.ndarray], best: Best):
    """The lists so far, one row each, with the columns of `keys` for the group."""
    found = list(best.lists())
    if found:
        groups = np.array([g for g, _, _ in found])
        columns = {c: pa.array(v[groups]) for c, v in keys.items()}
        columns["ids"] = pa.array([i for _, _, i in found], pa.list_(pa.int64()))
        columns["scores"] = pa.array([s for _, s, _ in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict(columns)


class Positives:
    """The first rows of the anchors' own label; all rows of a tile have that label."""

    def __init__(self, rows, k: int):
        self.anchors = Anchors(rows)
        self.best = Best(len(self.anchors.ids), k, np.int64)

    def add(self, rows) -> None:
        ids = rows.column("vec_id").to_numpy()
        for first, found in self.anchors.scored(rows):
            a = slice(first, first + found.shape[1])
            reached = found >= self.best.last[a]
            reached &= ids[:, None] != self.anchors.ids[a]
            j, i = np.nonzero(reached)
            self.best.add(i + first, found[j, i], ids[j])

    def results(self):
        yield from _lists({"anchor_id": self.anchors.ids}, self.best)


class Negatives:
    """For each anchor and positive, the first rows of another label within the window."""

    def __init__(self, rows, k: int, percent: int):
        self.anchors = Anchors(rows)
        self.labels = rows.column("label").to_numpy()
        ids = rows.column("positive_ids").to_pylist()
        self.place = np.repeat(np.arange(len(ids)), [len(p) for p in ids])
        self.positive = np.array([i for p in ids for i in p], np.int64)
        self.high = np.array([s for p in rows.column("positive_scores").to_pylist() for s in p], np.int64)
        # The least whole score that reaches the share.
        self.low = -(-percent * self.high // 100)
        self.best = Best(len(self.place), k, np.int64)

    def add(self, rows) -> None:
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        for first, found in self.anchors.scored(rows):
            pairs = slice(*np.searchsorted(self.place, [first, first + found.shape[1]]))
            low = np.maximum(self.low[pairs], self.best.last[pairs])
            column = self.place[pairs] - first
            # The widest window of each anchor leaves few rows to compare with all of its windows.
            least = np.full(found.shape[1], np.iinfo(np.int64).max)
            np.minimum.at(least, column, low)
            most = np.full(found.shape[1], np.iinfo(np.int64).min)
            np.maximum.at(most, column, self.high[pairs])
            reached = (found >= least) & (found <= most)
            reached &= labels[:, None] != self.labels[first : first + found.shape[1]]
            j, i = np.nonzero(reached)
            starts = np.searchsorted(column, np.arange(found.shape[1] + 1))
            count = np.diff(starts)[i]
            # Each of these rows beside each of its anchor's windows.
            row = np.repeat(np.arange(len(i)), count)
            pair = np.repeat(starts[i], count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            score = found[j, i].astype(np.int64)[row]
            inside = (score >= low[pair]) & (score <= self.high[pairs][pair])
            self.best.add(pair[inside] + pairs.start, score[inside], ids[j[row[inside]]])

    def results(self):
        keys = {"anchor_id": self.anchors.ids[self.place], "positive_id": self.positive, "positive_score": self.high}
        yield from _lists(keys, self.best)


def _first_of(lists: list[dict], k: int) -> list[tuple[int, int]]:
    """(-score, id) of the first `k` over lists of the same group."""
    return sorted((-s, i) for row in lists for s, i in zip(row["scores"], row["ids"]))[:k]


def _merged_positives(batches, k: int):
    def made():
        for anchor, rows in rows_by_key(batches):
            first = _first_of(rows, k)
            yield anchor, [i for _, i in first], [-s for s, _ in first]

    return in_batches(made(), POSITIVE_LISTS)


def _merged_negatives(batches, k: int):
    def made():
        for anchor, rows in rows_by_key(batches):
            by_positive: dict[int, list[dict]] = {}
            for row in rows:
                by_positive.setdefault(row["positive_id"], []).append(row)
            for positive, lists in by_positive.items():
                own = lists[0]["positive_score"]
                for n, (s, i) in enumerate(_first_of(lists, k)):
                    yield anchor, positive, n + 1, i, own, -s

    return in_batches(made(), MINED)


def _by(lists: DataFrame, key: str) -> DataFrame:
    return lists.repartition(key).sortWithinPartitions(key)


def turned_labels(vectors: DataFrame) -> DataFrame:
    """Labels as the miner takes them: every seventh row has the next one."""
    label = F.col("label").cast("long")
    turned = F.pmod(label + 1, F.lit(LABELS))
    return vectors.withColumn("label", F.when(F.col("vec_id") % TURNED == 0, turned).otherwise(label))


def hard_negatives(
    vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each
    row whose vec_id is divisible by `every`, and each of its first `positives` other rows
    of the same label, the first `negatives` rows of another label that score at least
    `percent` of what the positive does and no more than it. Higher scores come first,
    ties by the smaller vec_id; all there are where there are fewer.

    Of `vectors` the columns vec_id, embedding and label are read. Rows with a null id,
    label or vector, an empty vector, or a null or non-finite component take no part. An
    id that repeats counts once, with the least of its vectors and its least label.
    Components are floor(256 * x), held within 2**24. Vectors of different lengths are
    not compared. A positive of a negative score has no window, so no rows. No rows, or a
    single label, give no rows.
    """
    small_batches(vectors.sparkSession)
    if not isinstance(vectors.schema["embedding"].dataType.elementType, (T.FloatType, T.DoubleType)):
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = distinct_vectors(vectors.withColumn("label", F.col("label").cast("long")), "label")
    rows = written(rows.mapInArrow(_packed, BITS), "bit-planes")
    dim = rows.agg(F.max("dim")).first()[0] or 0
    is_anchor = F.col("vec_id") % every == 0
    # The tables of an anchor, 256 sums of up to 8 bytes for each group, and its lists.
    held = (-(-dim // GROUP)) * (8 << GROUP) + 24 * max(positives, positives * negatives) + 200

    tiles = dealt(rows.filter(is_anchor), rows, ["dim", "label"], held)
    lists = tiles.mapInArrow(
        lambda batches: tile_results(batches, 4, lambda q: Positives(q, positives)),
        "anchor_id long, ids array<long>, scores array<long>",
    )
    found = _by(lists, "anchor_id").mapInArrow(
        lambda batches: _merged_positives(batches, positives),
        "vec_id long, positive_ids array<long>, positive_scores array<long>",
    )
    found = written(found, "positives")

    none = F.lit(None).cast("array<long>")
    anchors = rows.join(found, "vec_id")
    others = rows.withColumns({"positive_ids": none, "positive_scores": none})
    tiles = dealt(anchors, others, ["dim"], held)
    lists = tiles.mapInArrow(
        lambda batches: tile_results(batches, 3, lambda q: Negatives(q, negatives, percent)),
        "anchor_id long, positive_id long, positive_score long, ids array<long>, scores array<long>",
    )
    return _by(lists, "anchor_id").mapInArrow(
        lambda batches: _merged_negatives(batches, negatives),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )

