"""Near-duplicates by HyperMinHash: compressed registers, bands, corrected estimates, and
a check of every link on the full sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import free_names, hashed, lower_words, rolling, small_batches, written
from broadsheet.llm.graph import components
from broadsheet.operators.joins import broadcast_if_few

SHINGLE = 5
PERCENT = 85
# 24 bands of 4 registers: a pair at the threshold shares no band with probability 2e-8.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
# Estimates may fall short of the threshold by so many standard errors.
ERRORS = 5.0
# Shingles on either side of a comparison in memory: 2 MB each.
PART = 200_000

_random = np.random.default_rng(0x4D696E48)
MULTIPLIERS = _random.integers(1 << 62, (1 << 64) - 1, REGISTERS, np.uint64) | np.uint64(1)


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of all words together where
    there are fewer; none without words."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(rolling(hashed(words), min(n, len(words))))


def registers(h: np.ndarray) -> np.ndarray:
    """For each register's hash function the smallest value over the set, kept as its
    count of leading zeros and the first bits after the leading one."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(h), 1024):
            np.minimum(least, np.multiply.outer(h[i : i + 1024], MULTIPLIERS).min(axis=0), out=least)
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    return (zeros << MANTISSA_BITS | np.clip(mantissa, 0, (1 << MANTISSA_BITS) - 1)).astype("<u2")


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, less the equal ones to be
    expected of unrelated sets of sizes n and m."""
    zeros = np.arange(64, dtype=np.float64)
    upper, lower = -np.exp2(-zeros - 1), -np.exp2(-zeros)
    with np.errstate(divide="ignore"):
        falls = lambda s: np.exp(np.log1p(upper) * s[:, None]) - np.exp(np.log1p(lower) * s[:, None])
        chance = (falls(n) * falls(m)).sum(axis=1) / (1 << MANTISSA_BITS)
    return (equal / REGISTERS - chance) / (1 - chance)


SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("registers", pa.binary())]
)


def _sketched(batches):
    for batch in batches:
        ids, ns, sets, regs = batch.column(0), [], [], []
        for text in batch.column(1):
            h = shingles(text.as_py())
            ns.append(len(h))
            sets.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
            regs.append(registers(h).tobytes() if len(h) else None)
        columns = [ids.cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip((ns, sets, regs), list(SKETCH)[1:]))]
        yield pa.RecordBatch.from_arrays(columns, schema=SKETCH)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, registers): 192 bytes a document; nulls without words."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_sketched, "doc_id long, n_shingles long, set_id binary, registers binary")


def _estimated(batches, percent: int):
    low = percent / 100 - ERRORS * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, n, m, ra, rb = batch.columns
        stack = lambda c: np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(-1, REGISTERS)
        n, m = n.to_numpy().astype(float), m.to_numpy().astype(float)
        similar = estimate((stack(ra) == stack(rb)).sum(axis=1), n, m) >= low
        # No pair of sets is more alike than their sizes.
        similar &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(similar))


def _hash_rows(batches):
    for batch in batches:
        h = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(h, pa.list_(pa.int64()))], ["node", "hashes"]
        )


def _paired(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        own = table.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", *(f"{c}_{s}" for c in columns for s in ("a", "b")))


def _links_between(table: pa.Table, percent: int) -> pa.Table:
    """Links between the documents of side 0 and those of side 1 that are of another
    component, one for each document and component: sets are compared in full, in
    memory. No list of pairs is made."""
    side, nodes, groups = (table.column(c).to_numpy() for c in ("side", "node", "component"))
    hashes = table.column("hashes").combine_chunks()
    sizes = np.diff(hashes.offsets.to_numpy())
    _, number = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
    first = np.cumsum(sizes) - sizes
    right = np.flatnonzero(side == 1)
    elements = np.concatenate([number[first[k] : first[k] + sizes[k]] for k in right])
    starts = np.cumsum(sizes[right]) - sizes[right]
    mark, out = np.zeros(number.max(initial=-1) + 1, np.int32), []
    for k in np.flatnonzero(side == 0):
        own = number[first[k] : first[k] + sizes[k]]
        mark[own] = 1
        both = np.add.reduceat(mark[elements], starts)
        mark[own] = 0
        linked = (100 * both >= percent * (sizes[k] + sizes[right] - both)) & (groups[right] != groups[k])
        found = right[linked]
        _, one = np.unique(groups[found], return_index=True)
        out += ((nodes[k], nodes[x]) for x in found[one])
    a, b = zip(*out) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links_across(mixed: DataFrame, hashes: DataFrame, percent: int) -> DataFrame:
    """All links that join components in `mixed` (bucket, node, component), as far as it
    takes to connect them. Documents that share a bucket form a family. Links inside its
    largest component are not wanted, so the others are compared with all of the family;
    both sides are dealt out by the size of their sets, so that a task holds two parts
    of bounded size however large the family."""
    leaders = mixed.groupBy("bucket").agg(F.min("node").alias("a"))
    families = components(mixed.join(leaders, "bucket").select("a", F.col("node").alias("b")))
    rows = mixed.select("node", "component").distinct().join(families.toDF("node", "family"), "node")
    rows = written(rows.join(hashes.select("node", F.size("hashes").cast("long").alias("n")), "node"), "families")
    sizes = rows.groupBy("family", "component").agg(F.sum("n").alias("n"))
    sizes = sizes.groupBy("family").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all")
    )
    parts = lambda n: F.ceil(n / F.lit(float(PART))).cast("int")
    sizes = sizes.select(
        "family", "main", F.greatest(parts(F.col("all") - F.col("most")), F.lit(1)).alias("lefts"),
        parts(F.col("all")).alias("rights"),
    )
    rows = rows.join(broadcast_if_few(sizes), "family")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("family", "i", "j", "side", "node", "component")
    left = rows.filter("component <> main").withColumns({"side": F.lit(0), "i": deal("lefts"), "j": upto("rights")})
    right = rows.withColumns({"side": F.lit(1), "j": deal("rights"), "i": upto("lefts")})
    # The sets come to their parts, by document, only when these are known; and what is
    # dealt by family alone before would satisfy the grouping and stay in one task.
    dealt = left.select(*columns).union(right.select(*columns)).join(hashes, "node")
    return dealt.repartition("family", "i", "j").groupBy("family", "i", "j").applyInArrow(
        lambda table: _links_between(table, percent), "a long, b long"
    )


def _labelled(members: DataFrame, groups: DataFrame) -> DataFrame:
    joined = members.join(groups.withColumnRenamed("id", "node"), "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text;
    other columns are not read).

    Documents are linked whose sets of word shingles have a Jaccard similarity of at
    least `percent` / 100. component_id is the smallest doc_id that can be reached over
    links, and kept is whether it is the row's own. Null, empty and blank texts have
    empty sets and are linked with nothing. A doc_id names one document: rows that share
    it are linked, whatever their texts. Rows without doc_id are linked with nothing:
    component_id is null and they are kept. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    rows = written(sketch(docs), "sketches")
    # One node for each distinct set, named by its smallest doc_id.
    sets = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")
    )
    sets = written(sets, "sets")
    band = lambda i: F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS))
    members = sets.select("node", F.explode(F.array(*(band(i) for i in range(BANDS)))).alias("bucket"))
    full = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    members = written(members.join(full, "bucket").select("bucket", "leader", "node"), "members")

    # The full sets of documents that share a bucket with another, from their texts.
    some = broadcast_if_few(written(members.select(F.col("node").alias("doc_id")).distinct(), "nodes"))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(some, "doc_id")
    hashes = written(texts.mapInArrow(_hash_rows, "node long, hashes array<long>"), "hashes")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of candidate pairs those that the registers allow and the full sets confirm."""
        close = _paired(pairs, sets, "n", "registers").mapInArrow(
            lambda batches: _estimated(batches, percent), "a long, b long"
        )
        both = F.size(F.array_intersect("hashes_a", "hashes_b"))
        union = F.size("hashes_a") + F.size("hashes_b") - both
        return _paired(close, hashes, "hashes").filter(100 * both >= percent * union).select("a", "b")

    # Rows that share a doc_id though their sets differ.
    again = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 and doc_id is not null")
    again = rows.join(broadcast_if_few(again.select("doc_id")), "doc_id").join(sets.select("set_id", "node"), "set_id")
    same = again.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    # First each member of a bucket against one leader: links grow with the members.
    stars = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    links = written(confirmed(stars.distinct()).union(same), "confirmed")
    groups = components(links)
    # Then documents that share a bucket with one of another group: any of them may be
    # linked still.
    labelled = _labelled(members.select("bucket", "node"), groups)
    spans = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    mixed = labelled.join(spans.filter("x < y").select("bucket"), "bucket").select("bucket", "node", "component")
    more = written(_links_across(written(mixed, "mixed"), hashes, percent), "confirmed")
    if not more.isEmpty():
        groups = components(links.union(more))

    by_set = _labelled(sets.select("set_id", "node"), groups).select("set_id", "component")
    out = rows.select("doc_id", "n_shingles", "set_id").join(by_set, "set_id", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.col("doc_id").isNull() | F.col("doc_id").eqNullSafe(component)
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), kept.alias("kept")
    )


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose documents are kept (see `near_duplicates`), with all
    columns, whatever their names. Of rows that share a doc_id one stays, the first by a hash of its text;
    rows without doc_id all stay."""
    found = near_duplicates(docs, percent).select("doc_id", "kept")
    gone = written(found.filter("not kept").select("doc_id").distinct(), "gone")
    gone_id, again_id, key_id = free_names(docs, "_gone", "_again", "_key")
    key = F.col("doc_id").cast("long")
    rest = docs.join(broadcast_if_few(gone.toDF(gone_id)), key == F.col(gone_id), "left_anti")
    again = docs.groupBy(key.alias(again_id)).agg(F.count("*").alias("n")).filter((F.col("n") > 1) & F.col(again_id).isNotNull())
    again = written(again.select(again_id), "again")
    if again.isEmpty():
        return rest
    again = broadcast_if_few(again)
    single = rest.join(again, key == F.col(again_id), "left_anti")
    # The first row is found in the map tasks, so one id may have any number of rows.
    order = F.struct(F.xxhash64("text"), F.col("text"))
    several = rest.join(again, key == F.col(again_id), "left_semi").groupBy(key.alias(key_id)).agg(
        F.min_by(F.struct(*(F.col(c) for c in docs.columns)), order).alias("row")
    )
    return single.unionByName(several.select("row.*"))
