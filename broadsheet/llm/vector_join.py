"""Nearest neighbours by a block matrix join.

Vectors are rounded to int8. The product of two blocks of codes is one matrix product,
whose sums are exact, and the rounding errors bound how far it is from the true inner
product. Pairs whose upper bound reaches a query's k-th score so far are computed again
from the original vectors in double precision, and the lists of all sections are merged.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import small_batches, written
from broadsheet.llm.tiles import Best, dealt, distinct_vectors, in_batches, rows_by_key, stacked, tile_results

K = 20
LEVELS = 127
# Queries to a product; with a batch of candidates a tile of 8 MB.
SUBBLOCK = 2_048
# float32 holds sums of int8 products exactly up to so many components.
EXACT_DIM = (1 << 24) // LEVELS**2
# Scales and norms within these bounds neither overflow nor vanish in float32.
FLOAT32_SAFE = 1e15
# Rounding of the scaled products, as a share of the norms.
SLACK = 1e-5

CODED = "vec_id long, dim int, codes binary, vector binary, scale double, norm double, residual double"


def coded(vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """int8 codes of the rows, the scale of each, its norm and the norm of what rounding
    left over; norms are rounded up."""
    x = vectors.astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        scale = np.abs(x).max(axis=1) / LEVELS
        # A vector too small to be scaled has codes of 0, and is all residual.
        codes = np.clip(np.rint(np.divide(x, scale[:, None], out=np.zeros_like(x), where=scale[:, None] > 0)), -LEVELS, LEVELS)
        up = 1 + 1e-9
        left = np.linalg.norm(x - codes * scale[:, None], axis=1) * up
        return codes.astype(np.int8), scale, np.linalg.norm(x, axis=1) * up, left


def _coded(batches, dtype: str):
    for batch in batches:
        ids = batch.column(0).to_numpy()
        lists = batch.column(1)
        values, starts = lists.flatten().to_numpy(), np.cumsum(np.r_[0, lists.value_lengths().to_numpy()])
        dims = np.diff(starts)
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            x = values[starts[own][:, None] + np.arange(dim)].astype(dtype)
            codes, scale, norm, residual = coded(x)
            columns = [ids[own], np.full(len(own), dim, np.int32), [c.tobytes() for c in codes], [v.tobytes() for v in x], scale, norm, residual]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["vec_id", "dim", "codes", "vector", "scale", "norm", "residual"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows, as floats: in float32 by stretches of components
    whose sums it holds."""
    if a.shape[1] <= EXACT_DIM:
        return a.astype(np.float32) @ b.astype(np.float32).T
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_DIM):
        out += products(a[:, k : k + EXACT_DIM], b[:, k : k + EXACT_DIM])
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(a.shape[1]):
            total += a[:, k].astype(np.float64) * b[:, k]
    return total


class Block:
    """Rows of one side of a tile."""

    def __init__(self, rows, dtype: str):
        self.ids = rows.column("vec_id").to_numpy()
        self.codes, self.vectors = stacked(rows.column("codes"), "i1"), stacked(rows.column("vector"), dtype)
        self.scale, self.norm, self.residual = (rows.column(c).to_numpy() for c in ("scale", "norm", "residual"))

    def part(self, a: int, b: int) -> Block:
        other = object.__new__(Block)
        other.__dict__ = {k: v[a:b] for k, v in self.__dict__.items()}
        return other

    def narrow(self) -> bool:
        with np.errstate(invalid="ignore"):
            return bool((self.norm < FLOAT32_SAFE).all() and (self.scale > 1 / FLOAT32_SAFE).all())


def bounds(q: Block, c: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of all rows of `q` with all of `c`."""
    kind = np.float32 if q.narrow() and c.narrow() else np.float64
    about = products(q.codes, c.codes).astype(kind, copy=False)
    with np.errstate(over="ignore", invalid="ignore"):
        about *= q.scale.astype(kind)[:, None]
        about *= c.scale.astype(kind)
        # <x, y> - <x', y'> = <x - x', y'> + <x, y - y'>, and |y'| <= |y| + |y - y'|.
        error = np.multiply.outer((q.residual + SLACK * q.norm).astype(kind), (c.norm + c.residual).astype(kind))
        error += np.multiply.outer(q.norm.astype(kind), c.residual.astype(kind))
        return about - error, np.add(about, error, out=error)


class Search:
    """The k nearest of one section for a block of queries."""

    def __init__(self, queries, k: int, dtype: str):
        self.k, self.dtype = k, dtype
        self.queries = Block(queries, dtype)
        self.parts = [self.queries.part(a, a + SUBBLOCK) for a in range(0, len(self.queries.ids), SUBBLOCK)]
        self.best = [Best(len(p.ids), k, np.float64) for p in self.parts]
        self.computed = 0

    def add(self, rows) -> None:
        candidates = Block(rows, self.dtype)
        for q, best in zip(self.parts, self.best):
            lower, upper = bounds(q, candidates)
            own = q.ids[:, None] == candidates.ids
            lower[own] = -np.inf
            reached = best.last.copy()
            short = np.flatnonzero(np.isneginf(reached))
            if len(short) and lower.shape[1] > self.k:
                # The k-th lower bound here is below the k-th score of all.
                known = np.where(np.isnan(lower[short]), -np.inf, lower[short])
                reached[short] = -np.partition(-known, self.k - 1, axis=1)[:, self.k - 1]
            # Rounded down, or the bound of an equal score could fall short of it.
            reached = np.nextafter(reached.astype(upper.dtype), -np.inf)
            # A bound that is not a number rules nothing out.
            left = ~(upper < reached[:, None]) & ~own
            i, j = np.nonzero(left)
            self.computed += len(i)
            best.add(i, inner(q.vectors[i], candidates.vectors[j]), candidates.ids[j])

    def results(self):
        for q, best in zip(self.parts, self.best):
            found = list(best.lists())
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.ids[[g for g, _, _ in found]]), pa.array([i for _, _, i in found], pa.list_(pa.int64())),
                     pa.array([s for _, s, _ in found], pa.list_(pa.float64()))],
                    names=["query_id", "ids", "scores"],
                )


NEIGHBOURS = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _merged(batches, k: int):
    """The first k over all lists of a query: a heap of the heads of sorted lists."""
    def made():
        for query, rows in rows_by_key(batches):
            lists = (zip((-s for s in r["scores"]), r["ids"]) for r in rows)
            for n, (s, i) in enumerate(itertools.islice(heapq.merge(*lists), k)):
                yield query, n + 1, i, -s

    return in_batches(made(), NEIGHBOURS)


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with `is_query` its `k` nearest other
    rows by inner product, nearest first, ties by the smaller vec_id; all of them where
    there are fewer. The result is exact: recall is 1.

    Of `vectors` the columns vec_id and embedding are read. Rows with a null id or vector,
    with a null or non-finite component, and vectors that are empty or all zero take no
    part. An id that repeats counts once, with the least of its vectors. Vectors of
    different lengths are not compared. Equal vectors are ranked by id. No rows, or a
    single one, give no rows.
    """
    small_batches(vectors.sparkSession)
    element = vectors.schema["embedding"].dataType.elementType
    dtype = "<f4" if isinstance(element, T.FloatType) else "<f8"
    if not isinstance(element, (T.FloatType, T.DoubleType)):
        vectors = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = distinct_vectors(vectors).filter(F.exists("embedding", lambda x: x != 0))
    rows = written(rows.mapInArrow(lambda batches: _coded(batches, dtype), CODED), "coded-vectors")
    dim = rows.agg(F.max("dim")).first()[0] or 0
    # Codes, vector and, for each of the k, a score, an id and a number of the group.
    held = dim * (1 + np.dtype(dtype).itemsize) + 24 * k + 100
    queries = rows.filter(is_query)
    tiles = dealt(queries, rows, ["dim"], held)
    lists = tiles.mapInArrow(
        lambda batches: tile_results(batches, 3, lambda q: Search(q, k, dtype)),
        "query_id long, ids array<long>, scores array<double>",
    )
    lists = lists.repartition("query_id").sortWithinPartitions("query_id")
    return lists.mapInArrow(lambda batches: _merged(batches, k), "query_id long, rank int, vec_id long, score double")
