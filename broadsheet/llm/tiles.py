"""Searches of a block of vectors against all others: how the tiles are dealt to tasks.

Queries are cut into blocks that fit a task's memory and candidates into sections; a tile
is one block against one section. Each row goes to the tiles it takes part in, and a task
reads a tile as a stream: first its queries, then its candidates, batch by batch.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.joins import broadcast_if_few

# Bytes of queries, with all that is kept for them, that a task holds.
BLOCK_BYTES = 64 << 20
# A section has at most so many rows, and at least so many where tasks lie idle.
SECTION_ROWS, SMALL_SECTION = 1 << 20, 1_000
MAX_TASKS = 50_000

QUERY, CANDIDATE = 0, 1


def distinct_vectors(vectors: DataFrame, *columns: str) -> DataFrame:
    """(vec_id, embedding, `columns`) of the rows that take part: none of these null, the
    vector not empty and all its components finite. An id that repeats is one row, that
    with the least vector and then the least of the other columns."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", *columns)
    for c in whole.columns:
        whole = whole.filter(F.col(c).isNotNull())
    whole = whole.filter((F.size("embedding") > 0) & finite)
    least = F.min(F.struct("embedding", *columns)).alias("least")
    return whole.groupBy("vec_id").agg(least).select("vec_id", "least.*")


def dealt(queries: DataFrame, candidates: DataFrame, keys: Sequence[str], query_bytes: int) -> DataFrame:
    """Rows of both, alike in their columns, sorted into tiles: columns *keys, _block,
    _section and _kind before the others. Queries meet the candidates of the same `keys`.
    `query_bytes` is what a task holds for one query.

    A row's block or section is a hash of its vec_id, so a hot key is dealt out as evenly
    as any, and no row is dropped."""
    spark = candidates.sparkSession
    asked = queries.groupBy(*keys).agg(F.count("*").alias("_queries"))
    there = candidates.groupBy(*keys).agg(F.count("*").alias("_rows"))
    blocks = F.greatest(F.ceil(F.col("_queries") * query_bytes / BLOCK_BYTES), F.lit(1))
    tasks = 2 * spark.sparkContext.defaultParallelism
    idle = F.least(F.ceil(F.lit(tasks) / blocks), F.ceil(F.col("_rows") / SMALL_SECTION))
    sizes = asked.join(there, list(keys)).select(
        *keys, blocks.cast("int").alias("_blocks"),
        F.greatest(F.ceil(F.col("_rows") / SECTION_ROWS), idle).cast("int").alias("_sections"),
    )
    tiles = sizes.agg(F.sum(F.col("_blocks").cast("long") * F.col("_sections"))).first()[0] or 0
    # One row for each value of the keys: labels or lengths of vectors.
    sizes = broadcast_if_few(sizes)

    def placed(df: DataFrame, kind: int) -> DataFrame:
        own, other = ("_block", "_section") if kind == QUERY else ("_section", "_block")
        columns = df.columns
        df = df.join(sizes, list(keys)).withColumns({
            own: F.pmod(F.xxhash64("vec_id", F.lit(own)), F.col(f"{own}s")).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)),
            "_kind": F.lit(kind),
        })
        return df.select(*keys, "_block", "_section", "_kind", *(c for c in columns if c not in keys))

    rows = placed(queries, QUERY).unionByName(placed(candidates, CANDIDATE))
    tile = [*keys, "_block", "_section"]
    # By number, as adaptive execution would merge what is small in bytes but long in work.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(2 * tiles, MAX_TASKS))
    return rows.repartition(tasks, *tile).sortWithinPartitions(*tile, "_kind")


def runs(batch: pa.RecordBatch, n_keys: int) -> Iterator[pa.RecordBatch]:
    """The batch cut where one of its first columns changes."""
    cuts = np.zeros(max(batch.num_rows - 1, 0), bool)
    for column in batch.columns[:n_keys]:
        values = column.to_numpy(zero_copy_only=False)
        cuts |= values[1:] != values[:-1]
    edges = [0, *(np.flatnonzero(cuts) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def tile_results(batches, n_keys: int, opened: Callable[[pa.Table], object]) -> Iterator[pa.RecordBatch]:
    """Stream tiles through `opened(queries)`, an object with add(candidates) and
    results(). The first `n_keys` columns name the tile, the next one the kind of row."""
    key, queries, tile = None, [], None
    for batch in batches:
        for run in runs(batch, n_keys + 1):
            own = tuple(run.column(k)[0].as_py() for k in range(n_keys))
            if own != key:
                if tile is not None:
                    yield from tile.results()
                key, queries, tile = own, [], None
            rest = pa.RecordBatch.from_arrays(run.columns[n_keys + 1 :], names=run.schema.names[n_keys + 1 :])
            if run.column(n_keys)[0].as_py() == QUERY:
                queries.append(rest)
            elif queries:
                if tile is None:
                    tile = opened(pa.Table.from_batches(queries))
                tile.add(rest)
    if tile is not None:
        yield from tile.results()


def stacked(column, dtype: str) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), -1)


def ranked(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first `k` of each group, by group, score downwards, id upwards."""
    order = np.lexsort((ids, -scores, groups))
    own = groups[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
    return order[rank < k]


class Best:
    """The first `k` of each of `n` groups so far, by score downwards and id upwards."""

    def __init__(self, n: int, k: int, dtype):
        self.k = k
        self.group, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, dtype), np.zeros(0, np.int64)
        # The k-th score of each group; the least value where there are fewer.
        self.least = -np.inf if np.issubdtype(dtype, np.floating) else np.iinfo(dtype).min
        self.last = np.full(n, self.least, dtype)

    def add(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        touched = np.zeros(len(self.last), bool)
        touched[group] = True
        old = touched[self.group]
        g = np.r_[self.group[old], group]
        s, i = np.r_[self.score[old], score.astype(self.score.dtype)], np.r_[self.id[old], id_]
        first = ranked(g, s, i, self.k)
        g, s, i = g[first], s[first], i[first]
        self.group = np.r_[self.group[~old], g]
        self.score, self.id = np.r_[self.score[~old], s], np.r_[self.id[~old], i]
        full = np.flatnonzero(np.bincount(g, minlength=len(self.last)) == self.k)
        # Of a full group the last row has the k-th score.
        ends = np.searchsorted(g, full, side="right") - 1
        self.last[full] = s[ends]

    def lists(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(group, scores, ids) of every group that has any, in their order."""
        order = ranked(self.group, self.score, self.id, self.k)
        g, s, i = self.group[order], self.score[order], self.id[order]
        edges = np.flatnonzero(np.r_[True, g[1:] != g[:-1], True]) if len(g) else np.zeros(0, np.int64)
        for a, b in zip(edges, edges[1:]):
            yield int(g[a]), s[a:b], i[a:b]


def rows_by_key(batches) -> Iterator[tuple[object, list[dict]]]:
    """Rows of a partition sorted by its first column, those of one value together."""
    key, held = None, []
    for batch in batches:
        for run in runs(batch, 1):
            own = run.column(0)[0].as_py()
            if held and own != key:
                yield key, held
                held = []
            key = own
            held += run.to_pylist()
    if held:
        yield key, held


def in_batches(rows: Iterator[tuple], schema: pa.Schema, n: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of up to `n`."""
    while held := list(itertools.islice(rows, n)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
