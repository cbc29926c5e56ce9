"""How filters applied in a row interact: what each removes, in every order.

Every document is a cell of a 2x2x2x2x2 tensor, one axis for each filter, index 0 where it
passes and 1 where it fails. The tensor of a part's counts says all about that part, so
the texts are read once and the 120 orders are contractions of 32 numbers.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import small_batches

FILTERS = "ABCDE"
# The limits of the filters.
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"

# What a step asks of each axis: the documents that pass, those that fail, or all.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
ORDERS = list(itertools.permutations(range(len(FILTERS))))
LETTERS = ["".join(FILTERS[f] for f in order) for order in ORDERS]

FLAGS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("flags", pa.int32()), ("digest", pa.binary())])
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def failures(text: str | None) -> tuple[int, bytes]:
    """Bits of the filters A to D that a text fails, and the digest by which E finds
    identical texts."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    flags = (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, CAPITALS))) > CAPITALS_PERCENT * len(text)) << 2
        | (len(data) != len(data.translate(None, SYMBOLS))) << 3
    )
    return flags, hashlib.sha256(data).digest()


def _flagged(batches):
    for batch in batches:
        found = [failures(t.as_py()) for t in batch.column(2)]
        flags = pa.array([f for f, _ in found], pa.int32())
        digests = pa.array([d for _, d in found], pa.binary())
        ids, parts = batch.column(0).cast(pa.int64()), batch.column(1).fill_null("")
        yield pa.RecordBatch.from_arrays([ids, parts, flags, digests], schema=FLAGS)


def flagged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, flags, digest) of every document: the only pass over the texts."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text")
    return rows.mapInArrow(_flagged, "doc_id long, part string, flags int, digest binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cell, good, toxic, n): documents by the filters they fail, as bits of `cell`,
    and by what the labels say.

    Filter E asks for the smallest id of a text in the whole table. The copies of a text
    are counted by what they share, with the smallest id and the rows under it kept on
    the way, so a text that makes up a third of the table is a few rows from each task.
    """
    is_one = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(is_one("quality")).alias("good"), F.max(is_one("toxic")).alias("toxic")
    )
    rows = flagged(docs).join(marks, "doc_id", "left").withColumns({
        "good": F.coalesce("good", F.lit(False)), "toxic": F.coalesce("toxic", F.lit(False)),
        "nameless": F.col("doc_id").isNull(),
    })
    shared = ["digest", "flags", "part", "good", "toxic", "nameless"]
    # Rows of one id are together since the join.
    rows = rows.groupBy("doc_id", *shared).agg(F.count("*").alias("rows"))
    least = F.min(F.struct("doc_id", "rows"))
    copies = rows.groupBy(*shared).agg(F.sum("rows").alias("rows"), least.alias("least"))
    # A text has as many rows here as there are parts and labels.
    copies = copies.withColumn("first", F.min("least.doc_id").over(Window.partitionBy("digest")))
    # Rows without an id come neither before nor after others.
    original = F.when(F.col("nameless"), F.col("rows")).otherwise(
        F.when(F.col("least.doc_id") == F.col("first"), F.col("least.rows")).otherwise(0)
    )
    e = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("flags").alias("cell"), original.alias("n")),
        F.struct((F.col("flags") + e).alias("cell"), (F.col("rows") - original).alias("n")),
    )
    dealt = copies.select("part", "good", "toxic", F.inline(both))
    return dealt.groupBy("part", "cell", "good", "toxic").agg(F.sum("n").alias("n"))


def selectors() -> tuple[np.ndarray, ...]:
    """What each step of each order asks of each axis, as [axis, order, step, 2]: of those
    it keeps, those it removes, and those that fail its filter or its filter alone."""
    made = np.empty((4, len(FILTERS), len(ORDERS), len(FILTERS), 2), np.int64)
    for o, order in enumerate(ORDERS):
        for step, own in enumerate(order):
            before = order[:step]
            for f in range(len(FILTERS)):
                kept = PASS if f == own or f in before else ALL
                removed = FAIL if f == own else PASS if f in before else ALL
                made[:, f, o, step] = kept, removed, FAIL if f == own else ALL, FAIL if f == own else PASS
    return tuple(made)


SELECTORS = selectors()
# Which filter each step of each order applies, as [order, step, filter].
APPLIES = np.array([[[f == own for f in range(len(FILTERS))] for own in order] for order in ORDERS], np.int64)


def contracted(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """[kind, order, step]: the sums over the selected cells of [kind, a, b, c, d, e]."""
    return np.einsum("kabcde,ota,otb,otc,otd,ote->kot", tensor, *chosen, optimize=True)


def audit_part(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every order and step from [all, good, toxic] x 2x2x2x2x2."""
    kept, removed, fails, alone = SELECTORS
    gone = contracted(tensor, removed)
    by_filter = np.einsum("ot,otf->f", gone[0], APPLIES)
    return {
        "kept": contracted(tensor[:1], kept)[0],
        "removed": gone[0],
        "redundant": contracted(tensor[:1], fails)[0] - gone[0],
        "unique_fails": contracted(tensor[:1], alone)[0],
        "good_lost": gone[1],
        "toxic_lost": gone[2],
        "shapley": np.einsum("f,otf->ot", by_filter, APPLIES),
    }


def _audited(rows: pa.Table) -> pa.Table:
    """The report of one part from its rows of counts, at most 4 for each of 32 cells."""
    cell, n = rows.column("cell").to_numpy(), rows.column("n").to_numpy()
    tensor = np.zeros((3, 1 << len(FILTERS)), np.int64)
    for kind, mask in enumerate((np.ones(len(n), bool), rows.column("good").to_numpy(), rows.column("toxic").to_numpy())):
        np.add.at(tensor[kind], cell[mask], n[mask])
    # The lowest bit is filter A, but the first axis of a reshape is the highest.
    tensor = tensor.reshape(3, *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
    counts = audit_part(tensor)
    steps = len(FILTERS)
    columns = {
        "part": pa.array([rows.column("part")[0].as_py()] * len(ORDERS) * steps, pa.string()),
        "filter_order": pa.array(np.repeat(LETTERS, steps)),
        "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(ORDERS))),
    }
    return pa.table(columns | {c: pa.array(counts[c].ravel()) for c in COUNTS})


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every part (lang), order of the five filters and step: documents kept after the
    step, removed by it, failing its filter but removed earlier (`redundant`), failing its
    filter only (`unique_fails`), removed though of good quality or as toxic, and the sum
    over all orders of what its filter removes (`shapley`).

    Of `docs` the columns doc_id, lang and text are read, of `labels` doc_id, quality and
    toxic; others are ignored. A null text is empty, a null lang is the part ''. Rows that
    repeat count each for itself; of identical texts those under the smallest doc_id pass
    filter E, repeated ones too, and so does every row without a doc_id, as it is neither
    smaller nor larger than another. A document is good or toxic if any label of its
    doc_id says so. No rows give no rows.
    """
    return cells(docs, labels).groupBy("part").applyInArrow(_audited, AUDIT)
