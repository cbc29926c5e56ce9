"""Fuzzy line dedup: SimHash of normalised lines, candidates by pigeonhole blocks, a check
of edit similarity, and one occurrence kept of each connected group.

A SimHash tells lines apart by its distance, but of lines that are four fifths alike it
differs in more bits than blocks can be found by: a changed word in ten is some eight bits.
So each line has blocks of a second kind, made of the least hashes of its word triples,
two at a time; lines that agree in one of them are compared by SimHash and length, and
what is left by its edits.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import document_keys, free_names, identified, mix, small_batches, written
from broadsheet.llm.edits import edit_bounds, edit_distance, edits_at_most  # noqa: F401
from broadsheet.llm.graph import components
from broadsheet.operators.joins import broadcast_if_few

BITS = 64
# Lines whose SimHashes differ in so many bits at most share a block of them for certain.
DISTANCE = 2
# Of the least hashes under so many seeds, any two make a block: the least chance to miss a
# pair is 1 in 30 where lines share half of their triples, and falls fast from there.
SEEDS = 5
# Blocks of SimHashes are made for so many lines, however many there are: lines further apart
# than DISTANCE are candidates by the blocks they happen to share, which must be the same
# for a pair whatever else the table holds.
MASK_LINES = 1 << 28
# Candidates that differ in more bits are not compared: unrelated lines differ in 31 on the
# average, those that are linked in 8, and in more than this hardly ever.
WIDE = 24
# Lines are linked if so much of the longer one is left unedited, in percent.
PERCENT = 80
# A line is compared with its buckets' leaders up to so many times the edits of close ones.
BEYOND = 3
# Lines to be removed that are sent to every task, at most: 12 bytes each.
BROADCAST_LINES = 2_000_000

# Bytes of normalised text: A-Z as a-z, digits as 0, white space in a line as a space.
_FROM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789\t\x0b\x0c\r"
NORMAL = bytes.maketrans(_FROM, b"abcdefghijklmnopqrstuvwxyz" + b"0" * 9 + b" " * 4)
BASE = 0x9E3779B97F4A7C15
# Bytes of text that are worked on at once: their arrays stay in the processor's cache.
CHUNK = 1 << 17


def normalise(line: str) -> str:
    """A-Z to lower case, any digit as 0, white space as single spaces."""
    words = line.encode("utf-8", "surrogatepass").translate(NORMAL).split(b" ")
    return b" ".join(w for w in words if w).decode("utf-8", "surrogatepass")


class Powers:
    """Powers of an odd base modulo 2**64, and of its inverse."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.append(np.uint64(1), np.full(n, BASE, np.uint64)))
                self.down = np.cumprod(np.append(np.uint64(1), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)))
        return self.up, self.down


POWERS = Powers()


_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_random = np.random.default_rng(0x6C696E65)
SEED_FACTORS = _random.integers(1 << 62, (1 << 64) - 1, SEEDS, np.uint64) | np.uint64(1)


class LineHashes(NamedTuple):
    """Of the lines of a text that have a word: their numbers, their identity (two 64-bit
    hashes of their words in order), their SimHash, their characters, and for each seed the
    least hash of their word triples; all after normalising."""

    number: np.ndarray
    identity: np.ndarray
    simhash: np.ndarray
    length: np.ndarray
    least: np.ndarray


def line_hashes(text: bytes) -> LineHashes:
    """A SimHash has the bits that most hashes of the line's pairs of neighbouring words have
    set, its beginning and its end among them. Words are hashed from sums over the text's
    bytes, without taking it apart.
    """
    data = np.frombuffer(text.translate(NORMAL), np.uint8)
    up, down = POWERS.get(len(data) + 1)
    breaks, gap = data == 10, np.ones(len(data) + 2, bool)
    np.bitwise_or(data == 32, breaks, out=gap[1:-1])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return LineHashes(none, np.zeros((0, 2), np.uint64), none, none, np.zeros((0, SEEDS), np.uint64))
    line = np.cumsum(breaks, dtype=np.int32)[starts].astype(np.int64)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    counts = np.diff(np.append(first, len(line)))
    # All bytes but those that go on with a character.
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)).astype(np.int64)
    length = np.add.reduceat(chars[ends] - chars[starts], first) + counts - 1
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)]))
        words = mix((sums[ends] - sums[starts]) * down[starts])
        weight = up[np.arange(len(line)) - np.repeat(first, counts)]
        one = np.add.reduceat(words * weight, first)
        two = np.add.reduceat(mix(words ^ np.uint64(0xD6E8FEB86659FD93)) * weight, first)
        # Each line with its end as one more word.
        at = np.arange(len(words)) + np.repeat(np.arange(len(first)), counts)
        heads = first + np.arange(len(first))
        tokens = np.full(len(words) + len(first), _END)
        tokens[at] = words
        before = np.append(_START, tokens[:-1])
        before[heads] = _START
        pairs = mix(before * np.uint64(BASE) + tokens)
        earlier = np.append(_START, before[:-1])
        earlier[heads] = _START
        triples = mix(pairs + earlier * np.uint64(0xC2B2AE3D27D4EB4F))
        least = np.stack([np.minimum.reduceat(triples * f, heads) for f in SEED_FACTORS], 1)
    bits = np.unpackbits(pairs.view(np.uint8).reshape(-1, 8), axis=1)
    # Votes of up to 255 pairs fit into a byte, and eight of them are added as one number.
    since = np.arange(len(pairs)) - np.repeat(heads, counts + 1)
    pieces = np.flatnonzero(since % 255 == 0)
    votes = np.add.reduceat(bits.view(np.uint64), pieces, axis=0).view(np.uint8)
    if len(pieces) > len(heads):
        votes = np.add.reduceat(votes, np.flatnonzero(since[pieces] == 0), axis=0, dtype=np.int32)
    simhash = np.packbits(votes > (counts[:, None] + 1) // 2, axis=1).view("<i8").ravel()
    return LineHashes(line[first], np.stack([mix(one), mix(two)], 1), simhash, length, least)


COMPARED = "a long, b long, low int, high int, close boolean"
# Rows and bytes of texts that are compared at once.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1 << 14, 1 << 24


def _gathered(batches):
    """Batches put together to tables of many rows."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= ROWS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def _compared(batches, percent: int, beyond: int):
    """Pairs with bounds of their edits, and whether they are close."""
    for table in _gathered(batches):
        low, high, close = edit_bounds(table.column(2).to_pylist(), table.column(3).to_pylist(), percent, beyond)
        ids = (table.column(k).combine_chunks() for k in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [*ids, pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(close)], ["a", "b", "low", "high", "close"]
        )


LINES = pa.schema(
    [("doc_id", pa.int64()), ("version", pa.int64()), ("pos", pa.int32()), ("line", pa.binary(16)), ("simhash", pa.int64()),
     ("length", pa.int32()), ("least", pa.list_(pa.int64()))]
)


def _lines(batches):
    for batch in batches:
        texts = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column(2)]
        ids, versions = (batch.column(c).to_numpy() for c in (0, 1))
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= CHUNK):
                size += len(texts[end])
                end += 1
            found = line_hashes(b"\n".join(texts[start:end]))
            number = found.number
            # The first line of each text among all lines of the chunk.
            heads = np.append(0, np.cumsum([t.count(b"\n") + 1 for t in texts[start : end - 1]])).astype(np.int64)
            doc = np.searchsorted(heads, number, side="right") - 1
            keys = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(16), len(number), [None, pa.py_buffer(np.ascontiguousarray(found.identity).tobytes())]
            )
            columns = [pa.array(ids[start:end][doc]), pa.array(versions[start:end][doc]),
                       pa.array((number - heads[doc]).astype(np.int32)), keys.cast(pa.binary()), pa.array(found.simhash),
                       pa.array(found.length.astype(np.int32)),
                       pa.ListArray.from_arrays(pa.array(np.arange(0, found.least.size + 1, SEEDS), pa.int32()), pa.array(found.least.view(np.int64).ravel()))]
            if len(number):
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in LINES])
            start = end


def tables_for(n_lines: int) -> list[int]:
    """Masks of blocks such that any two values that differ in at most DISTANCE bits
    agree under one of them: of m blocks at most DISTANCE differ, so m - DISTANCE agree.
    More lines take more and longer masks, which keep buckets small; the candidates that
    pass the distance are the same for any m."""
    m = DISTANCE + 1
    while m < 8 and 2 ** (BITS * (m - DISTANCE) / m) < 16 * n_lines:
        m += 1
    edges = [round(BITS * i / m) for i in range(m + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(m)]
    masks = [sum(c) for c in combinations(blocks, m - DISTANCE)]
    return [x - (1 << 64) if x >= 1 << 63 else x for x in masks]


# Buckets are dealt out by their first 12 bits, fewer for few lines, and told apart by the 32 that
# follow: lines that share a bucket by chance alone are compared like others.
PART_BITS = 12
# A part has the buckets of so many lines, up to 2 ** PART_BITS parts.
PART_LINES = 1 << 8
# Lines whose buckets are sorted at once.
SORTED = 1 << 16
ENTRY = np.dtype([("rest", "<u4"), ("id", "<u4")])


def _buckets(simhash: np.ndarray, least: np.ndarray, masks: list[int]) -> np.ndarray:
    """The buckets of lines: one for each mask, and one for each two of the least hashes."""
    values = [simhash & np.uint64(x & (1 << 64) - 1) for x in masks]
    with np.errstate(over="ignore"):
        values += [mix(least[:, i]) * np.uint64(BASE) + least[:, k] for i, k in combinations(range(SEEDS), 2)]
        return np.stack([mix(mix(v) + np.uint64(i + 1) * np.uint64(0xD6E8FEB86659FD93)) for i, v in enumerate(values)], 1)


def _entries(batches, masks: list[int], bits: int = PART_BITS):
    """The buckets of lines, packed: an entry for each bucket and line, those of a part
    next to each other. Ids share their upper half with the others of the row."""

    def packed(held):
        ids, simhash, least = (np.concatenate(c) for c in zip(*held))
        for upper in np.unique(ids >> 32):
            some = ids >> 32 == upper
            buckets = _buckets(simhash[some], least[some], masks)
            part = (buckets >> np.uint64(64 - bits)).astype(np.uint16).ravel()
            entries = np.empty(len(part), ENTRY)
            entries["rest"] = (buckets >> np.uint64(32 - bits)).ravel() & np.uint64(0xFFFFFFFF)
            entries["id"] = np.repeat(ids[some] & 0xFFFFFFFF, buckets.shape[1])
            entries = entries[np.argsort(part, kind="stable")]
            counts = np.bincount(part, minlength=1 << bits)
            parts = np.flatnonzero(counts)
            ends = np.append(0, np.cumsum(counts[parts])) * ENTRY.itemsize
            data = pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(entries.tobytes())])
            columns = [pa.array(parts, pa.int32()), pa.array(np.full(len(parts), upper), pa.int64()), data]
            yield pa.RecordBatch.from_arrays(columns, ["part", "upper", "data"])

    held, size = [], 0
    for batch in batches:
        least = batch.column(2).flatten().to_numpy().view(np.uint64).reshape(-1, SEEDS)
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), least))
        size += batch.num_rows
        if size >= SORTED:
            yield from packed(held)
            held, size = [], 0
    if size:
        yield from packed(held)


def _members(batches):
    """Of the buckets with two or more lines: bucket, line, lines in it, and the least line
    as their leader. Rows of a part come next to each other."""

    def shared(part, held):
        entries = np.concatenate([np.frombuffer(data.as_buffer(), ENTRY) for _, data in held])
        upper = np.repeat([u for u, _ in held], [len(data.as_buffer()) // ENTRY.itemsize for _, data in held])
        # Most are alone in their bucket.
        order = np.argsort(entries["rest"])
        same = np.diff(entries["rest"][order]) == 0
        order = order[np.append(same, False) | np.append(False, same)]
        rest, ids = entries["rest"][order].astype(np.int64), upper[order] << 32 | entries["id"][order]
        order = np.lexsort((ids, rest))
        rest, ids = rest[order], ids[order]
        fresh = np.append(True, (rest[1:] != rest[:-1]) | (ids[1:] != ids[:-1]))[: len(ids)]
        rest, ids = rest[fresh], ids[fresh]
        if not len(ids):
            return
        starts = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
        n = np.diff(np.append(starts, len(ids)))
        bucket = np.int64(part) << 32 | rest
        columns = [bucket, ids, np.repeat(n, n), np.repeat(ids[starts], n)]
        found = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "id", "n", "leader"])
        yield found.filter(pa.array(np.repeat(n, n) > 1))

    now, held = None, []
    for batch in batches:
        for part, upper, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if part != now and held:
                yield from shared(now, held)
                held = []
            now = part
            held.append((upper, data))
    if held:
        yield from shared(now, held)


# A bucket's lines are compared in tiles of two blocks. A block has about so many lines, and no more
# characters than so many.
BLOCK_LINES, BLOCK_CHARS = 1 << 10, 1 << 22
# Pairs of lines that are looked at, and pairs of texts that are compared, at once.
LOOKED_AT, MEASURED = 1 << 19, 1 << 14


def _near_pairs(rows: dict[str, np.ndarray], buckets: np.ndarray, percent: int):
    """Places of two rows of a tile, of different blocks if it has two, that may be close and are in
    different groups. Two lines that share more than one bucket come in the first of them only."""
    n = len(rows["id"])
    own = np.stack([rows[c] for c in ("bucket", "first", "second")], 1)
    edges = np.append(np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(1))), n)
    counts = np.repeat(edges[1:], np.diff(edges)) - np.arange(n) - 1
    ends = np.cumsum(counts)
    done = 0
    while done < n:
        base = ends[done] - counts[done]
        upto = max(int(np.searchsorted(ends, base + LOOKED_AT, side="right")), done + 1)
        some = counts[done:upto]
        i = np.repeat(np.arange(done, upto), some)
        j = i + 1 + np.arange(len(i)) - np.repeat(ends[done:upto] - some - base, some)
        done = upto

        def kept(stay: np.ndarray) -> None:
            nonlocal i, j
            i, j = i[stay], j[stay]

        kept(rows["component"][i] != rows["component"][j])
        kept((rows["first"][i] == rows["second"][i]) | (rows["block"][i] != rows["block"][j]))
        kept(np.bitwise_count(rows["simhash"][i].view(np.uint64) ^ rows["simhash"][j].view(np.uint64)) <= WIDE)
        x, y = rows["length"][i].astype(np.int64), rows["length"][j].astype(np.int64)
        # Of two lines one near to their leader and the other far from it are not close: they are as
        # far apart as their distances from it at least.
        apart = np.maximum(rows["low"][i] - rows["high"][j], rows["low"][j] - rows["high"][i])
        kept(100 * np.maximum(np.abs(x - y), apart) <= (100 - percent) * np.maximum(x, y))
        same = buckets[i] == buckets[j]
        kept((buckets[i, same.argmax(1)] == rows["bucket"][i]) | ~same.any(1))
        yield i, j


def _across(batches, masks: list[int], percent: int, bits: int = PART_BITS):
    """Groups that a link between two of their lines joins. Rows of a tile come next to each other."""

    def tiles():
        """Rows of whole tiles, those of many at once."""
        rest = None
        for table in _gathered(batches):
            table = table if rest is None else pa.concat_tables([rest, table])
            own = np.stack([table.column(c).to_numpy() for c in ("bucket", "first", "second")], 1)
            last = len(own) - int(np.argmax(np.append((own[::-1] != own[-1]).any(1), True)))
            if last:
                yield table.slice(0, last)
            rest = table.slice(last)
        if rest is not None:
            yield rest

    for table in tiles():
        rows = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("least", "norm")}
        least = table.column("least").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SEEDS)
        buckets = (_buckets(rows["simhash"].view(np.uint64), least, masks) >> np.uint64(32 - bits)).astype(np.int64)
        norms, groups = table.column("norm").to_pylist(), rows["component"]
        for i, j in _near_pairs(rows, buckets, percent):
            for at in range(0, len(i), MEASURED):
                x, y = i[at : at + MEASURED], j[at : at + MEASURED]
                *_, close = edit_bounds([norms[k] for k in x], [norms[k] for k in y], percent, 1)
                found = np.unique(np.stack([groups[x[close]], groups[y[close]]], 1), axis=0)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _normalised(batches):
    for batch in batches:
        norm = [normalise(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(norm, pa.string())], ["id", "norm"])


def duplicate_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(_id, _version, pos) of the lines that go, with the documents' keys."""
    small_batches(docs.sparkSession)
    own = identified(docs).select("_id", "_version", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, version long, pos int, line binary, simhash long, length int, least array<long>"
    found = written(own.mapInArrow(_lines, schema), "lines")
    place = F.struct("doc_id", "version", "pos")
    # The rows of a line have the same hashes.
    made = F.struct(place.alias("place"), "simhash", "length", "least")
    lines = found.groupBy("line").agg(F.min(made).alias("made"), F.count("*").alias("rows")).select("line", "rows", "made.*")
    # Numbered once for all, in storage.
    lines = written(lines.withColumn("id", F.monotonically_increasing_id()), "distinct-lines")
    masks = tables_for(MASK_LINES)
    bits = min(max((lines.count() // PART_LINES).bit_length(), 1), PART_BITS)
    entries = lines.select("id", "simhash", "least").mapInArrow(
        lambda batches: _entries(batches, masks, bits), "part int, upper long, data binary"
    )
    members = entries.repartition("part").sortWithinPartitions("part").mapInArrow(
        _members, "bucket long, id long, n long, leader long"
    )
    members = written(members, "members")
    some = broadcast_if_few(members.select("id").distinct())
    hashes = written(lines.join(some, "id").drop("line", "rows"), "hashes")
    # Their texts are taken from the documents that have them first. Rows that repeat a document
    # give the same line again.
    where = hashes.groupBy(F.col("place.doc_id").alias("_id"), F.col("place.version").alias("_version")).agg(
        F.collect_list(F.struct("id", "place.pos")).alias("places")
    )
    # Each text is taken apart once, however many of its lines are asked for.
    texts = own.join(broadcast_if_few(where), ["_id", "_version"]).select(F.split("text", "\n", -1).alias("lines"), "places")
    texts = texts.select("lines", F.explode("places").alias("of")).select("of.id", F.element_at("lines", F.col("of.pos") + 1).alias("raw"))
    norms = written(texts.mapInArrow(_normalised, "id long, norm string").dropDuplicates(["id"]), "norms")

    def near(a: str, b: str, x: str, y: str) -> Column:
        """Whether two lines may be linked, by SimHash and by length."""
        apart = F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= WIDE
        return apart & (100 * F.abs(F.col(x) - F.col(y)) <= (100 - percent) * F.greatest(x, y))

    few_hashes = broadcast_if_few(hashes.select("id", "simhash", "length"))

    def with_hashes(rows: DataFrame, name: str, suffix: str) -> DataFrame:
        return rows.join(few_hashes.toDF(name, f"simhash{suffix}", f"length{suffix}"), name)

    stars = members.filter("leader <> id").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    stars = with_hashes(with_hashes(stars, "a", "a"), "b", "b")
    stars = stars.filter(near("simhasha", "simhashb", "lengtha", "lengthb")).select("a", "b")
    for side in ("a", "b"):
        stars = stars.join(norms.toDF(side, f"norm_{side}"), side)
    stars = stars.select("a", "b", "norm_a", "norm_b").mapInArrow(lambda batches: _compared(batches, percent, BEYOND), COMPARED)
    stars = written(stars, "pairs")
    groups = components(stars.filter("close").select("a", "b"))
    # Pairs of a bucket in different groups still: any may be the only link. Those of the leader
    # are compared.
    labelled = members.filter("n > 2 AND id <> leader").join(broadcast_if_few(groups), "id", "left").select(
        "bucket", "id", "leader", F.coalesce("component", "id").alias("component")
    )
    labelled = with_hashes(labelled, "id", "")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_LINES), F.ceil(F.sum("length") / BLOCK_CHARS)).cast("int")
    spans = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), blocks.alias("blocks"))
    mixed = labelled.join(spans.filter("x < y").select("bucket", "blocks"), "bucket")
    bounds = stars.select(F.col("a").alias("leader"), F.col("b").alias("id"), F.col("low").cast("long"), F.col("high").cast("long"))
    mixed = mixed.join(broadcast_if_few(bounds), ["leader", "id"], "left").fillna({"low": 0, "high": 1 << 30})
    mixed = written(mixed.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).drop("leader"), "mixed")
    # Each block of a bucket meets each other, and itself.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = mixed.withColumn("other", other).withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    dealt = dealt.join(hashes.select("id", "least").join(norms, "id"), "id").select(
        "bucket", "first", "second", "block", "id", "component", "simhash", "length", "low", "high", "least", "norm"
    )
    tile = ("bucket", "first", "second")
    more = dealt.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(
        lambda batches: _across(batches, masks, percent, bits), "a long, b long"
    )
    more = written(more.distinct(), "confirmed")
    if not more.isEmpty():
        # Groups are joined by links between them; a line without one is a group.
        joined = components(more)
        old = groups.union(joined.select("id", F.col("id").alias("component"))).distinct()
        whole = joined.select(F.col("id").alias("component"), F.col("component").alias("whole"))
        groups = old.join(whole, "component", "left").select("id", F.coalesce("whole", "component").alias("component"))

    named = written(lines.select("id", "line", "place").join(broadcast_if_few(groups), "id"), "groups")
    heads = named.groupBy("component").agg(F.min("place").alias("first"))
    linked = named.join(broadcast_if_few(heads), "component").select("line", "first")
    # Lines without a link may have copies.
    copied = lines.filter("rows > 1").join(broadcast_if_few(named.select("line")), "line", "left_anti")
    first = written(linked.union(copied.select("line", F.col("place").alias("first"))), "firsts")
    extra = found.join(broadcast_if_few(first), "line").filter(place != F.col("first"))
    return extra.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "pos").distinct()


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` with the lines taken out that are near-copies of an earlier one; n_lines
    and n_removed are added (columns with these names are replaced, all others kept).

    Two lines are linked if at least `percent` of the longer one is unedited, after
    normalising, and they are candidates: see above. Of each connected
    group of lines the first stays, by doc_id (null first), then by a hash of the text,
    then by place in the text. Lines without a word stay and link nothing. Null and
    empty texts stay as they are, with 0 lines removed. Rows that repeat both doc_id and
    text are one document: they get the same result. No rows give no rows.
    """
    docs = docs.drop("n_lines", "n_removed")
    drops = written(duplicate_lines(docs, percent), "drops")
    keys = free_names(docs, "_id", "_version", "_drop")
    per_doc = drops.groupBy("_id", "_version").agg(F.collect_list("pos").alias("_drop")).toDF(*keys)
    if drops.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES:
        per_doc = F.broadcast(per_doc)
    rows = docs.withColumns(dict(zip(keys[:2], document_keys()))).join(per_doc, keys[:2], "left")
    lines, drop = F.split("text", "\n", -1), F.col(keys[2])
    stays = F.filter(lines, lambda _, i: ~F.array_contains(drop, i))
    cleaned = F.when(drop.isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return rows.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.when(drop.isNull(), 0).otherwise(F.size(drop)).cast("long"),
        "text": cleaned,
    }).select(*docs.columns, "n_lines", "n_removed")
