"""Boosted trees over sparse vectors, for all folds of a cross-validation at once.

MLlib's trees look at every feature of a row in every level of every tree and keep each
row's bins, one integer a feature, for each model apart. Of some thousand features of a
text all but a hundred are zero. Here a row is kept once for all models, as the bins of
what is not zero; what falls into the bin of zero is what a node's rows leave over. The
same levels of all models are one job. Thresholds, gains, leaves and weights are MLlib's,
and so is the model that comes of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import ensure_checkpoint_dir

# Rows that are kept and worked on as one piece.
PIECE_ROWS = 16_384
# Rows of a task: a part of them sends its figures once, however many its pieces.
TASK_ROWS = 131_072
# Up to so many bins in all, each model's trees grow in one task: a job a level would take longer.
TASK_ENTRIES = 1 << 23
# In a node, or a whole table, of up to so many cells each is added up, in the order of the rows,
# as MLlib does. No sum is taken as a rest then, so that equal gains, of which few rows have many,
# fall as there.
SMALL_CELLS, SMALL_TABLE = 1 << 16, 1 << 19
# In other nodes gains as near as this, as a share of the mean square, are equal.
SLACK = 1e-10
# Beyond this depth the nodes of a level are too many to be added up at once.
MAX_DEPTH = 10
# MLlib's: rows that thresholds are chosen from, and the impurity that counts as none.
THRESHOLD_ROWS = 10_000
EPSILON = 2.220446049250313e-16
TREE_PARAMS = (
    "cacheNodeIds checkpointInterval featuresCol impurity labelCol leafCol maxBins maxDepth maxMemoryInMB "
    "minInfoGain minInstancesPerNode minWeightFractionPerNode predictionCol seed"
).split()
NODES = """treeID INT, nodeData STRUCT<id: INT, prediction: DOUBLE, impurity: DOUBLE,
    impurityStats: ARRAY<DOUBLE>, rawCount: BIGINT, gain: DOUBLE, leftChild: INT, rightChild: INT,
    split: STRUCT<featureIndex: INT, leftCategoriesOrThreshold: ARRAY<DOUBLE>, numCategories: INT>>"""


def can_boost(estimator) -> bool:
    """Whether `boost` grows the trees that this estimator would."""
    return (
        type(estimator) is GBTClassifier
        and estimator.getSubsamplingRate() == 1.0
        and estimator.getFeatureSubsetStrategy() == "all"
        and estimator.getImpurity() == "variance"
        and estimator.getMinWeightFractionPerNode() == 0.0
        and estimator.getMaxDepth() <= MAX_DEPTH
        and not estimator.isDefined(estimator.weightCol)
        and not estimator.isDefined(estimator.validationIndicatorCol)
    )


# -- thresholds ------------------------------------------------------------


def _entries(vectors: pa.StructArray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of what is not zero, row by row, of unwrapped vectors."""
    part = lambda name: pc.struct_field(vectors, name)
    lengths = part("values").value_lengths().to_numpy(zero_copy_only=False)
    dense = part("type").to_numpy(zero_copy_only=False) == 1
    rows = np.repeat(np.arange(len(vectors)), lengths)
    values = part("values").flatten().to_numpy(zero_copy_only=False)
    features = np.empty(len(values), np.int64)
    written_out = np.repeat(dense, lengths)
    features[~written_out] = part("indices").flatten().to_numpy(zero_copy_only=False)
    features[written_out] = np.tile(np.arange(size), int(dense.sum()))
    kept = values != 0
    return rows[kept], features[kept], values[kept]


def _feature_thresholds(values: np.ndarray, counts: np.ndarray, expected: float, most: int) -> np.ndarray:
    """MLlib's: between all values if they are few, or else where about as many rows lie
    between two as between any others."""
    if len(values) == 0:
        return np.empty(0)
    zeros = expected - counts.sum()
    if zeros > EPSILON * expected * 100:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(float), at, zeros)
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2.0
    stride = expected / (most + 1)
    found, target, reached = [], stride, np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            found.append((values[i - 1] + values[i]) / 2.0)
            target += stride
    return np.array(found)


def _thresholds(rows: DataFrame, n: int, size: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """Each feature's, from the rows that MLlib would draw for it: all, or some ten thousand."""
    bins = min(max_bins, n)
    wanted = max(bins * bins, THRESHOLD_ROWS)
    share = wanted / n if wanted < n else 1.0
    if share < 1.0:
        spark = rows.sparkSession
        drawn_by = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = rows._jdf.rdd().sample(False, share, drawn_by)
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    found = rows.select(F.unwrap_udt(rows.columns[0]).alias("v")).toArrow().column("v").combine_chunks()
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    _, features, values = _entries(found, size)
    order = np.lexsort((values, features))
    features, values = features[order], values[order]
    first = np.flatnonzero(np.r_[True, (features[1:] != features[:-1]) | (values[1:] != values[:-1])][: len(values)])
    counts = np.diff(np.r_[first, len(values)])
    features, values = features[first], values[first]
    ends = np.searchsorted(features, np.arange(size + 1))
    return [
        _feature_thresholds(values[a:b], counts[a:b], share * n, bins - 1) for a, b in zip(ends[:-1], ends[1:])
    ]


# -- bins ------------------------------------------------------------------


@dataclass
class Bins:
    """One model's bins, side by side for all features, and what they have to do with the
    fine ones that are kept for all models."""

    thresholds: list[np.ndarray]
    offset: np.ndarray
    feature: np.ndarray
    place: np.ndarray
    zero: np.ndarray
    of_fine: np.ndarray
    fine_feature: np.ndarray
    fine_zero: np.ndarray


@dataclass
class Fine:
    """Bins between the thresholds of all models."""

    size: int
    thresholds: list[np.ndarray]
    offset: np.ndarray

    def kept(self, batch: pa.RecordBatch, lanes: np.ndarray) -> Iterator[dict]:
        """Pieces of a batch of (fold, label, vector)."""
        for at in range(0, batch.num_rows, PIECE_ROWS):
            cut = batch.slice(at, PIECE_ROWS)
            rows, features, values = _entries(cut.column(2), self.size)
            codes = np.empty(len(rows), np.int32)
            order = np.argsort(features, kind="stable")
            ends = np.searchsorted(features[order], np.arange(self.size + 1))
            for f in np.flatnonzero(np.diff(ends)):
                which = order[ends[f] : ends[f + 1]]
                codes[which] = self.offset[f] + np.searchsorted(self.thresholds[f], values[which])
            by_code = np.argsort(codes, kind="stable")
            fold = cut.column(0).to_numpy(zero_copy_only=False)
            yield {
                "label": 2 * cut.column(1).to_numpy(zero_copy_only=False) - 1,
                "used": fold[None, :] != lanes[:, None],
                "counts": np.bincount(rows, minlength=cut.num_rows).astype(np.int32),
                "codes": codes,
                "rows_by_code": rows[by_code].astype(np.int32),
                "ends": np.searchsorted(codes[by_code], np.arange(self.offset[-1] + 1)).astype(np.int32),
            }


def _offsets(thresholds: list[np.ndarray]) -> np.ndarray:
    return np.r_[0, np.cumsum([len(t) + 1 for t in thresholds])].astype(np.int64)


def _bins(thresholds: list[np.ndarray], fine: Fine) -> Bins:
    offset = _offsets(thresholds)
    sizes = np.diff(offset)
    feature = np.repeat(np.arange(len(sizes)), sizes)
    of_fine = np.concatenate(
        [
            o + np.r_[0, np.searchsorted(t, every, side="right")]
            for o, t, every in zip(offset, thresholds, fine.thresholds)
        ]
    )
    zero = lambda start, cuts: start[:-1] + [np.searchsorted(t, 0.0) for t in cuts]
    return Bins(
        thresholds,
        offset,
        feature,
        np.arange(offset[-1]) - offset[feature],
        zero(offset, thresholds),
        of_fine.astype(np.int32),
        np.repeat(np.arange(fine.size), np.diff(fine.offset)),
        zero(fine.offset, fine.thresholds).astype(np.int32),
    )


# -- trees -----------------------------------------------------------------


@dataclass
class Node:
    """A node by its number in the heap from 1 on. (rows, sum, sum of squares) are those
    the parent's split had for it."""

    number: int
    stats: tuple[float, float, float] | None
    leaf: bool = False
    valid: bool = True
    gain: float = -1.0
    feature: int = -1
    cut: int = -1
    children: tuple[int, int] | None = None
    merged: float | None = None

    def value(self) -> float:
        if self.merged is not None:
            return self.merged
        return self.stats[1] / self.stats[0] if self.stats[0] else 0.0


@dataclass
class Tree:
    nodes: dict[int, Node] = field(default_factory=dict)

    def routes(self, bins: Bins, fine: Fine) -> list[list[tuple[int, int, int, int, bool]]]:
        """By level (node, first code of its feature, first code to its right, end of the
        feature's codes, whether zero goes right)."""
        out: list = []
        for node in sorted((x for x in self.nodes.values() if x.children), key=lambda x: x.number):
            level = node.number.bit_length() - 1
            out.extend([] for _ in range(level + 1 - len(out)))
            threshold, lo, hi = bins.thresholds[node.feature][node.cut], *fine.offset[node.feature : node.feature + 2]
            right = lo + 1 + int(np.searchsorted(fine.thresholds[node.feature], threshold))
            out[level].append((node.number, int(lo), int(right), int(hi), bool(threshold < 0.0)))
        return out

    def values(self) -> np.ndarray:
        at = np.zeros(max(self.nodes) + 1)
        for node in self.nodes.values():
            at[node.number] = node.value()
        return at


@dataclass
class Growth:
    """What the estimator asks of its trees."""

    iterations: int
    step: float
    max_depth: int
    min_rows: int
    min_gain: float
    again: int
    rows: list[int]

    @staticmethod
    def of(estimator: GBTClassifier, rows: list[int]) -> Growth:
        return Growth(
            estimator.getMaxIter(),
            estimator.getStepSize(),
            estimator.getMaxDepth(),
            max(estimator.getMinInstancesPerNode(), 1),
            estimator.getMinInfoGain(),
            max(estimator.getCheckpointInterval(), 1),
            rows,
        )

    def weight(self, m: int) -> float:
        return self.step if m else 1.0


def _impurity(n, total, squares):
    return (squares - (total * total) / n) / n


def _routed(piece: dict, routes) -> np.ndarray:
    """The node of each row."""
    at = np.ones(len(piece["label"]), np.int32)
    rows, ends = piece["rows_by_code"], piece["ends"]
    for level in routes:
        right, split = np.zeros(len(at), bool), np.zeros(1 << len(bin(level[-1][0])), bool)
        for number, lo, middle, hi, zero_right in level:
            split[number] = True
            if zero_right:
                right |= at == number
            there = rows[ends[lo] : ends[middle]] if zero_right else rows[ends[middle] : ends[hi]]
            right[there[at[there] == number]] = not zero_right
        at = np.where(split[at], 2 * at + right, at)
    return at


def _residual(label: np.ndarray, scored: np.ndarray | None) -> np.ndarray:
    with np.errstate(over="ignore"):
        return label if scored is None else 4.0 * label / (1.0 + np.exp(2.0 * label * scored))


def _scored(piece: dict, scored: dict | None, trees: dict) -> dict:
    """Scores by model with one more tree of each: (routes, values, weight)."""
    new = {lane: w * values[_routed(piece, routes)] for lane, (routes, values, w) in trees.items()}
    return new if scored is None else {lane: scored[lane] + one for lane, one in new.items()}


def _sums(keys, counts, figures, n: int, width: int) -> np.ndarray:
    """(node, figure, bin): rows and figures of rows that have `counts` keys each."""
    weights = [None, *[np.repeat(w, counts) for w in figures]]
    out = np.empty((n, len(weights), width))
    for i, w in enumerate(weights):
        out[:, i] = np.bincount(keys, w, n * width).reshape(n, width)
    return out


def _added_up(piece: dict, scored, lane: int, bins: Bins, routes, wanted: Sequence[int], small) -> np.ndarray:
    """(node, figure, bin): rows, sum and sum of squares of one model's wanted nodes."""
    residual = _residual(piece["label"], None if scored is None else scored[lane])
    squares = residual * residual
    n, width = len(wanted), int(bins.offset[-1])
    slots = np.full(2 << max(wanted).bit_length(), n, np.int32)
    slots[list(wanted)] = np.arange(n)
    slot = np.where(piece["used"][lane], slots[_routed(piece, routes)], n)
    counts, codes = piece["counts"], piece["codes"]
    large = np.append(~np.asarray(small), False)
    if large.any():
        there = large[slot]
        at, listing, listed, figures = slot, counts, codes, (residual, squares)
        if not there.all():
            at, listing, listed = slot[there], counts[there], codes[np.repeat(there, counts)]
            figures = residual[there], squares[there]
        keys = np.repeat(at * np.int64(width), listing) + bins.of_fine[listed]
        out = _sums(keys, listing, figures, n, width)
        # What a feature does not list is zero: the rest of the node's rows.
        for i, w in enumerate((None, *figures)):
            rest = np.bincount(at, w, n)[:, None] - np.add.reduceat(out[:, i], bins.offset[:-1], axis=1)
            out[:, i, bins.zero] += rest
    else:
        out = np.zeros((n, 3, width))
    ends = np.r_[0, np.cumsum(counts)]
    for k in np.flatnonzero(small):
        rows = np.flatnonzero(slot == k)
        if len(rows):
            listed = [codes[ends[r] : ends[r + 1]] for r in rows]
            every = np.tile(bins.fine_zero, (len(rows), 1))
            given = np.concatenate(listed)
            every[np.repeat(np.arange(len(rows)), counts[rows]), bins.fine_feature[given]] = given
            size = np.full(len(rows), every.shape[1])
            out[k] = _sums(bins.of_fine[every].ravel(), size, (residual[rows], squares[rows]), 1, width)[0]
    return out


def _best(summed: np.ndarray, stats, bins: Bins, min_rows: int, min_gain: float, slack: float) -> dict:
    """The split that gains most, of equal ones the first; each sum is taken as MLlib does.
    With sums that are a rest, gains count as equal, or as none, within the slack."""
    sizes = np.diff(bins.offset)
    wide = np.zeros((3, len(sizes), int(sizes.max())))
    wide.reshape(3, -1)[:, bins.feature * wide.shape[2] + bins.place] = summed
    upto = np.cumsum(wide, axis=2)
    left, every = upto[:, :, :-1], upto[:, :, -1:]
    right = every - left
    there = np.arange(left.shape[2])[None, :] < (sizes - 1)[:, None]
    if slack or not there.any():
        # Of the node's own rows, not what was left of its parent's.
        stats = tuple(float(x) for x in every[:, 0, 0]) if slack or stats is None else stats
    if not there.any():
        return {"stats": stats, "valid": False}
    if stats is None:
        f, s = np.unravel_index(int(np.argmax(there)), there.shape)
        stats = tuple(float(x) for x in left[:, f, s] + right[:, f, s])
    impurity = _impurity(*stats) if stats[0] else 0.0
    allowed = there & (left[0] >= min_rows) & (right[0] >= min_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        n = left[0] + right[0]
        gain = impurity - left[0] / n * _impurity(*left) - right[0] / n * _impurity(*right)
    gain = np.where(allowed & (gain >= min_gain), gain, -np.inf)
    slack *= stats[2] / stats[0] if stats[0] else 0.0
    f, s = np.unravel_index(int(np.argmax(gain >= gain.max() - slack)), gain.shape)
    if gain[f, s] <= (slack or -np.inf):
        return {"stats": stats, "valid": False}
    sides = [tuple(float(x) for x in side[:, f, s]) for side in (left, right)]
    return {"stats": stats, "valid": True, "gain": float(gain[f, s]), "feature": int(f), "cut": int(s), "sides": sides}


def _settle(node: Node, found: dict, max_depth: int, tree: Tree) -> list[Node]:
    """Write what was found into the node; the children that may be split further."""
    node.stats, node.valid = found["stats"], found["valid"]
    level = node.number.bit_length() - 1
    if not found["valid"] or found["gain"] <= 0 or level == max_depth:
        node.leaf = True
        return []
    node.gain, node.feature, node.cut = found["gain"], found["feature"], found["cut"]
    node.children = (2 * node.number, 2 * node.number + 1)
    children = [Node(number, stats) for number, stats in zip(node.children, found["sides"])]
    for child in children:
        child.leaf = level + 1 == max_depth or abs(_impurity(*child.stats)) < EPSILON
        tree.nodes[child.number] = child
    return [child for child in children if not child.leaf]


# -- growing ---------------------------------------------------------------


def _one_by_one(rdd: RDD) -> RDD:
    """Each piece pickled alone, so that two of these can be zipped as they are."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _pieces(rows: DataFrame, estimator: GBTClassifier, fine: Fine, lanes: np.ndarray) -> RDD:
    def kept(batches):
        for batch in batches:
            for piece in fine.kept(batch, lanes):
                yield pa.RecordBatch.from_pydict({"piece": [CPickleSerializer().dumps(piece)]})

    vectors = rows.select("fold", estimator.getLabelCol(), F.unwrap_udt(estimator.getFeaturesCol()).alias("v"))
    packed = vectors.mapInArrow(kept, "piece BINARY").rdd
    return _one_by_one(packed.map(lambda r: CPickleSerializer().loads(bytes(r.piece))))


def _part_sums(index: int, part, lanes: Sequence[int], bins, routes, wanted, small) -> list[tuple]:
    """((model, node), (part, figures)) of the pieces of one part."""
    sums: dict = {}
    for piece, scored in part:
        for lane in lanes:
            if wanted[lane]:
                new = _added_up(piece, scored, lane, bins[lane], routes[lane], wanted[lane], small[lane])
                sums[lane] = sums[lane] + new if lane in sums else new
    return [((lane, x), (index, s)) for lane, found in sums.items() for x, s in zip(wanted[lane], found)]


def _best_of_parts(pair, known: dict, bins, growth: Growth) -> tuple:
    (lane, number), parts = pair
    stats, is_small = known[lane, number]
    summed = None
    for _, one in sorted(parts, key=lambda x: x[0]):
        summed = one if summed is None else summed + one
    slack = 0.0 if is_small else SLACK
    return (lane, number), _best(summed, stats, bins[lane], growth.min_rows, growth.min_gain, slack)


def _grow(lanes: Sequence[int], bins, fine: Fine, growth: Growth, find) -> list[Tree]:
    """One tree of each model, level by level, by what `find` finds for their open nodes."""
    trees = [Tree({1: Node(1, None)}) for _ in lanes]
    open_nodes = [[tree.nodes[1]] for tree in trees]
    while any(open_nodes):
        routes = {lane: tree.routes(bins[lane], fine) for lane, tree in zip(lanes, trees)}
        wanted = {lane: [x.number for x in nodes] for lane, nodes in zip(lanes, open_nodes)}
        rows = {lane: [x.stats[0] if x.stats else growth.rows[lane] for x in nodes] for lane, nodes in zip(lanes, open_nodes)}
        most = SMALL_TABLE if max(growth.rows) * fine.size <= SMALL_TABLE else SMALL_CELLS
        small = {lane: [n * fine.size <= most for n in found] for lane, found in rows.items()}
        known = {
            (lane, x.number): (x.stats, is_small)
            for lane, nodes in zip(lanes, open_nodes)
            for x, is_small in zip(nodes, small[lane])
        }
        found = find(routes, wanted, small, known)
        open_nodes = [
            [c for x in nodes for c in _settle(x, found[lane, x.number], growth.max_depth, tree)]
            for lane, nodes, tree in zip(lanes, open_nodes, trees)
        ]
    return trees


def _grown_in_one_task(pair, bins, fine: Fine, growth: Growth) -> tuple[int, list[Tree]]:
    """All trees of one model from the parts of its rows."""
    lane, parts = pair
    pieces = [(index, piece) for index, part in sorted(parts, key=lambda x: x[0]) for piece in part]
    scores = [None] * len(pieces)

    def find(routes, wanted, small, known):
        sums: dict = {}
        for index in dict.fromkeys(i for i, _ in pieces):
            part = [(piece, scored) for (i, piece), scored in zip(pieces, scores) if i == index]
            for key, one in _part_sums(index, part, [lane], bins, routes, wanted, small):
                sums.setdefault(key, []).append(one)
        return dict(_best_of_parts(pair, known, bins, growth) for pair in sums.items())

    trees = []
    for m in range(growth.iterations):
        if m:
            step = (trees[-1].routes(bins[lane], fine), trees[-1].values(), growth.weight(m - 1))
            scores = [_scored(piece, scored, {lane: step}) for (_, piece), scored in zip(pieces, scores)]
        trees += _grow([lane], bins, fine, growth, find)
    return lane, trees


def _grown_together(pieces: RDD, lanes: Sequence[int], bins, fine: Fine, growth: Growth) -> list[list[Tree]]:
    """All trees of all models, a job for each level of one tree of each."""
    sc = pieces.context
    scores, steps, grown = None, [], []

    def find(routes, wanted, small, known):
        together = pieces.map(lambda piece: (piece, None)) if scores is None else pieces.zip(scores)
        sums = together.mapPartitionsWithIndex(
            lambda i, part: _part_sums(i, part, lanes, bins.value, routes, wanted, small)
        )
        by_node = sums.groupByKey(min(len(known), sc.defaultParallelism))
        return dict(by_node.map(lambda pair: _best_of_parts(pair, known, bins.value, growth)).collect())

    for m in range(growth.iterations):
        if m:
            routed = [(t.routes(b, fine), t.values()) for t, b in zip(grown[-1], bins.value)]
            steps.append({lane: (*r, growth.weight(m - 1)) for lane, r in zip(lanes, routed)})
            # Now and then from the beginning, so that what a lost score is made of stays short.
            again, before = (m - 1) % growth.again == 0, scores
            scores = _next_scores(pieces, None if again else before, steps if again else steps[-1:])
            scores.persist(StorageLevel.MEMORY_AND_DISK)
        grown.append(_grow(lanes, bins.value, fine, growth, find))
        if m > 1:
            before.unpersist()
    if scores is not None:
        scores.unpersist()
    return [[trees[i] for trees in grown] for i in range(len(lanes))]


def _next_scores(pieces: RDD, scores: RDD | None, steps: Sequence) -> RDD:
    def scored(pair):
        piece, now = pair
        for trees in steps:
            now = _scored(piece, now, trees)
        return now

    together = pieces.map(lambda piece: (piece, None)) if scores is None else pieces.zip(scores)
    return _one_by_one(together.map(scored))


def boost(estimator: GBTClassifier, rows: DataFrame, folds: int) -> list[GBTClassificationModel]:
    """What the estimator makes of the rows outside of each fold, and last of all rows. The
    rows, (fold, label, vector), are read several times and should be materialised."""
    features = estimator.getFeaturesCol()
    lanes = list(range(folds + 1))
    outside = [*range(folds), None]
    sizes = {r.fold: r["count"] for r in rows.groupBy("fold").count().collect()}
    total = sum(sizes.values())
    size = len(rows.select(features).first()[0])
    session = rows.sparkSession

    def at_once(do, over: Sequence) -> list:
        with ThreadPool(len(lanes)) as pool:
            return pool.map(inheritable_thread_target(session)(do), over, chunksize=1)

    def thresholds_outside(fold: int | None) -> list[np.ndarray]:
        side = rows if fold is None else rows.filter(F.col("fold") != fold)
        return _thresholds(side.select(features), total - sizes.get(fold, 0), size, estimator.getMaxBins(), estimator.getSeed())

    thresholds = at_once(thresholds_outside, outside)
    every = [np.unique(np.concatenate(per_feature)) for per_feature in zip(*thresholds)]
    fine = Fine(size, every, _offsets(every))
    sc = session.sparkContext
    bins = sc.broadcast([_bins(t, fine) for t in thresholds])
    growth = Growth.of(estimator, [total - sizes.get(fold, 0) for fold in outside])

    parts = max(1 if total <= 2 * PIECE_ROWS else sc.defaultParallelism, -(-total // TASK_ROWS))
    # Parts of a small table stay as they are, as sums are taken by part.
    dealt = rows if total * size <= SMALL_TABLE else rows.coalesce(parts)
    pieces = _pieces(dealt, estimator, fine, np.array([*range(folds), -1]))
    pieces.persist(StorageLevel.MEMORY_AND_DISK)
    if pieces.map(lambda piece: len(piece["codes"])).sum() <= TASK_ENTRIES:
        dealt = pieces.glom().zipWithIndex().flatMap(lambda part: [(lane, (part[1], part[0])) for lane in lanes])
        whole = dealt.groupByKey(len(lanes)).map(lambda pair: _grown_in_one_task(pair, bins.value, fine, growth))
        grown = [trees for _, trees in sorted(whole.collect(), key=lambda x: x[0])]
    else:
        grown = _grown_together(pieces, lanes, bins, fine, growth)
    pieces.unpersist()
    folder = f"{ensure_checkpoint_dir(session)}/boosted/{uuid.uuid4().hex}"
    estimator.save(f"{folder}/estimator")
    said = json.loads(session.read.text(f"{folder}/estimator/metadata").first()[0])
    return at_once(
        lambda lane: _model(session, f"{folder}/{lane}", said, growth, grown[lane], thresholds[lane], size), lanes
    )


# -- the model -------------------------------------------------------------


def _node_rows(tree: Tree, thresholds: list[np.ndarray]) -> list[tuple]:
    """Nodes in preorder; two leaves that say the same are one."""
    out: list = []

    def leaf(node: Node) -> bool:
        """After its children were looked at."""
        if node.children:
            a, b = (tree.nodes[c] for c in node.children)
            if leaf(a) & leaf(b) and a.value() == b.value():
                node.children, node.merged = None, a.value()
        return node.children is None

    def walk(node: Node) -> int:
        at = len(out)
        out.append(None)
        n, total, squares = node.stats
        impurity = _impurity(n, total, squares) if node.valid and n else -1.0
        if node.children:
            left, right = (walk(tree.nodes[c]) for c in node.children)
            split = (node.feature, [float(thresholds[node.feature][node.cut])], -1)
            rest = (node.gain, left, right, split)
        else:
            rest = (-1.0, -1, -1, (-1, [], -1))
        out[at] = (at, node.value(), impurity, [n, total, squares], int(n), *rest)
        return at

    leaf(tree.nodes[1])
    walk(tree.nodes[1])
    return out


def _model(session, path: str, said: dict, growth: Growth, trees, thresholds, size: int) -> GBTClassificationModel:
    """Written as MLlib writes such a model, and read by it."""
    whole = said | {
        "class": "org.apache.spark.ml.classification.GBTClassificationModel",
        "numFeatures": size,
        "numTrees": len(trees),
    }
    of_tree = lambda params: {k: v for k, v in params.items() if k in TREE_PARAMS}
    described = said | {
        "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
        "paramMap": of_tree(said["paramMap"]),
        "defaultParamMap": of_tree(said["defaultParamMap"]),
    }
    about = [
        (m, json.dumps(described | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), growth.weight(m)) for m in range(len(trees))
    ]
    nodes = [(m, row) for m, tree in enumerate(trees) for row in _node_rows(tree, thresholds)]
    write = lambda df, to: df.coalesce(1).write.parquet(f"{path}/{to}")
    session.createDataFrame([(json.dumps(whole),)], "value STRING").coalesce(1).write.text(f"{path}/metadata")
    write(session.createDataFrame(about, "_1 INT, _2 STRING, _3 DOUBLE"), "treesMetadata")
    write(session.createDataFrame(nodes, NODES), "data")
    return GBTClassificationModel.load(path)
