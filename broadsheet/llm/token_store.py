"""Token ids of documents as raw binary shards with a minimal perfect hash index.

Layout of a store, in one folder:

- `shard-NNNNN.bin`: a 16-byte header (magic, bytes per id, shard number), then the
  ids of the shard's documents back to back, little-endian. Shards, and documents in
  a shard, ascend by doc_id.
- `index-NNNNN.mph`: a minimal perfect hash over the keys whose hash falls into this
  bucket, and by slot: fingerprint, shard, first id in the shard, number of ids.
- `manifest.json`: the number of buckets, and by shard its ids and records.
- `keys/`: the keys that were stored, as a table.

A lookup hashes the key to its bucket and slot, compares the fingerprint, and reads
one range of one shard: the same few steps however large the store.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import (
    WORD_HASHES,
    filesystem,
    mix,
    open_file,
    published,
    shared_folder,
    small_batches,
    tasks_for,
)

MAGIC = b"TOKIDS01"
HEADER = struct.Struct("<8sII")
INDEX_MAGIC = b"MPHIDX01"
END_ID = 2
# Keys in one bucket of the index: a task holds one bucket, about 60 bytes a key.
BUCKET_KEYS = 1 << 20
KEY_SCHEMA = "doc_id long, occurrence long"


class ChunkEncoder:
    """Ids of whole texts by a byte-level BPE of the tokenizers library.

    The pre-tokenizer always splits before a single space, and around a single line
    break, between two characters that are not white space. So the stretches between
    such places can be encoded apart, and each once for as long as it is remembered.
    Stretches are kept without the space before them; one that is to be encoded as it
    stands is marked by HEAD.
    """

    LIMIT = 500_000
    HEAD = "\r"
    # White space that is not a single space or line break between other characters.
    ODD = re.compile(r"\s\s|[^\S \n]")
    SPACE = re.compile(r"\s")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.line_break = self._ids("\n")
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def stretches(self, text: str) -> list[str]:
        if text and not (self.ODD.search(text) or text[0].isspace() or text[-1].isspace()):
            parts = text.replace("\n", " \n").split(" ")
            parts[0] = self.HEAD + parts[0]
            return parts
        first, *parts = text.split(" ")
        out = [self.HEAD + first]
        for part in parts:
            last = out[-1]
            if part and last != self.HEAD and not part[0].isspace() and not last[-1].isspace():
                out.append(part)
            elif last[0] == self.HEAD:
                out[-1] = last + " " + part
            else:
                out[-1] = f"{self.HEAD} {last} {part}"
        return [x if x[0] == self.HEAD or not self.SPACE.search(x) else f"{self.HEAD} {x}" for x in out]

    def _encode_new(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of stretches not known yet. Full stops and commas behind a letter are
        tokens apart, so words are encoded without them; and words stand one after the
        other in one text, a line break between them, whose id marks where each ends."""
        stems, got = {}, {}
        for x in stretches:
            stem = x.rstrip(".,")
            stems[x] = stem if len(stem) < len(x) and stem[-1:].isalpha() else x
        words = list({w for w in stems.values() if w not in self.known})
        plain = [w for w in words if len(w) > 1 and not self.SPACE.search(w, 1)]
        alone = {w for w in words} - set(plain) if len(self.line_break) == 1 else set(words)
        bare = lambda w: w[1:] if w[0] in (self.HEAD, "\n") else " " + w
        if len(self.line_break) == 1:
            parts = [plain[i : i + 250] for i in range(0, len(plain), 250)]
            joined = ["\n".join(map(bare, part)) for part in parts]
            line, width = self.line_break.tobytes(), self.dtype.itemsize
            for part, e in zip(parts, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(e.ids, self.dtype)
                ends = np.flatnonzero(ids == self.line_break[0])
                if len(ends) != len(part) - 1:
                    alone.update(part)
                    continue
                data = ids.tobytes()
                starts, ends = np.append(0, ends + 1) * width, np.append(ends, len(ids)) * width
                for w, a, b in zip(part, starts.tolist(), ends.tolist()):
                    got[w] = line + data[a:b] if w[0] == "\n" else data[a:b]
        for w in alone:
            whole = w[1:] if w[:1] == self.HEAD else w if w[:1] == "\n" else " " + w
            got[w] = self._ids(whole).tobytes()
        for x, stem in stems.items():
            if stem != x:
                tail = x[len(stem) :]
                if (marks := self.known.get(self.HEAD + tail)) is None:
                    marks = self.known[self.HEAD + tail] = self._ids(tail).tobytes()
                got[x] = (got.get(stem) or self.known[stem]) + marks
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        split, known = [self.stretches(t) for t in texts], self.known
        new = set()
        for parts in split:
            new.update(set(parts).difference(known))
        got = self._encode_new(list(new))
        room = max(0, self.LIMIT - len(known))
        known.update(got)
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for x in list(got)[room:]:
            del known[x]
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    # The worker may have hashed words for another operator.
    WORD_HASHES.clear()
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _slices(batch: pa.RecordBatch, chars: int = 4_000_000):
    """Rows of a batch in runs of about so many characters."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield ids[start : i + 1], texts[start : i + 1]
            start, size = i + 1, 0


META = pa.schema(
    [("doc_id", pa.int64()), ("occurrence", pa.int64()), ("shard", pa.int32()),
     ("first", pa.int64()), ("n_tokens", pa.int64())]
)


def _shard_writer(batches, folder: str, tokenizer: str, end_id: int):
    shard, coder = TaskContext.get().partitionId(), encoder(tokenizer)
    end = np.array([end_id], coder.dtype).tobytes()
    width, at, last, seen = coder.dtype.itemsize, 0, object(), 0
    with published(folder, f"shard-{shard:05d}.bin") as out:
        out.write(HEADER.pack(MAGIC, width, shard))
        for batch in batches:
            for ids, texts in _slices(batch):
                rows = []
                for doc_id, payload in zip(ids, coder.encode(texts)):
                    out.write(payload)
                    out.write(end)
                    n = len(payload) // width + 1
                    seen = seen + 1 if doc_id == last else 0
                    last = doc_id
                    rows.append((doc_id, seen, shard, at, n))
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), META)], schema=META
                )


def key_hashes(doc_id: pd.Series, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of (doc_id, occurrence); null is a key of its own."""
    null = doc_id.isna().to_numpy()
    key = doc_id.fillna(0).to_numpy(np.int64).view(np.uint64)
    occurrence = np.asarray(occurrence, np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        a = mix(mix(key ^ np.uint64(0x51ED270B)) + occurrence * np.uint64(0x9E3779B97F4A7C15))
        b = mix(mix(key ^ np.uint64(0xA3C59AC3)) ^ mix(occurrence + np.uint64(0xD6E8FEB8)))
        a, b = np.where(null, mix(~a), a), np.where(null, mix(~b), b)
    return a, b


class PerfectHash:
    """Minimal perfect hash by levels of bits. At each level the keys left over claim a
    position; those alone on theirs are settled, the others go on to the next level.
    The slot of a key is the number of settled positions before its own."""

    GAMMA = 1.5

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.sizes = [len(x) for x in levels]
        self.ranks = []
        base = 0
        for bits in levels:
            before = np.cumsum(bits, dtype=np.int64) - bits
            self.ranks.append(before + base)
            base += int(bits.sum())
        self.n = base

    @staticmethod
    def _position(a, b, level, size):
        with np.errstate(over="ignore"):
            return (mix(a + b * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        levels = []
        while len(a):
            if len(levels) > 200:
                raise ValueError("two keys with the same hashes: the keys repeat")
            size = max(1, int(len(a) * cls.GAMMA))
            at = cls._position(a, b, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = ~alone[at]
            a, b = a[rest], b[rest]
        return cls(levels)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has a place for it."""
        out, todo = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, bits in enumerate(self.levels):
            at = self._position(a[todo], b[todo], level, len(bits))
            here = bits[at]
            out[todo[here]] = self.ranks[level][at[here]]
            todo = todo[~here]
        return out

    def dump(self) -> bytes:
        head = struct.pack("<I", len(self.levels)) + struct.pack(f"<{len(self.levels)}Q", *self.sizes)
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes, at: int) -> tuple[PerfectHash, int]:
        (n,) = struct.unpack_from("<I", data, at)
        sizes = struct.unpack_from(f"<{n}Q", data, at + 4)
        at += 4 + 8 * n
        levels = []
        for size in sizes:
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels), at


# Fixed fields of a slot.
SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("n", "<u8")])


def fingerprints(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a ^ (b << np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def _index_writer(frames, folder: str):
    bucket = TaskContext.get().partitionId()
    parts = [f for f in frames if len(f)]
    if not parts:
        return
    pdf = pd.concat(parts, ignore_index=True)
    a, b = key_hashes(pdf.doc_id, pdf.occurrence.to_numpy())
    mph = PerfectHash.build(a, b)
    slots, table = mph.slots(a, b), np.zeros(len(pdf), SLOT)
    table["print"][slots] = fingerprints(a, b)
    table["shard"][slots] = pdf["shard"]
    table["first"][slots] = pdf["first"]
    table["n"][slots] = pdf["n_tokens"]
    with published(folder, f"index-{bucket:05d}.mph") as out:
        out.write(INDEX_MAGIC + mph.dump() + table.tobytes())
    yield pd.DataFrame({"bucket": [bucket], "n_keys": [len(pdf)]})


def _bucket(n: int):
    return F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(n)).cast("int")


def write_store(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int = END_ID,
    shards: int | None = None,
) -> str:
    """Encode `docs` (doc_id, text; other columns are not read) into a new store and
    return its folder.

    A null text is the empty text and has the end id only. A null doc_id is a key of
    its own and comes first. Rows with the same doc_id are told apart by an occurrence
    number from 0, in the order of their texts' hashes; a row that repeats is stored
    again. No rows give a store without records.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_folder(spark, "token-store")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(shards or tasks_for(docs), *order).sortWithinPartitions(*order)
    schema = "doc_id long, occurrence long, shard int, first long, n_tokens long"
    dealt.mapInArrow(lambda rows: _shard_writer(rows, folder, tokenizer, end_id), schema).write.parquet(f"{folder}/records")
    records = spark.read.schema(schema).parquet(f"{folder}/records")

    # One row a shard comes to the driver.
    at = F.struct("first", "occurrence")
    shard_rows = (
        records.groupBy("shard")
        .agg(
            F.count("*").alias("n"),
            F.sum("n_tokens").alias("tokens"),
            F.min_by("doc_id", at).alias("first_key"),
            F.max_by("doc_id", at).alias("last_key"),
            F.max_by("occurrence", at).alias("last_occurrence"),
        )
        .orderBy("shard")
        .collect()
    )
    start, manifest, before = 0, [], None
    for r in shard_rows:
        # A key may go on from the shard before.
        carried = before["next"] if before and before["last_key"] == r.first_key else 0
        following = r.last_occurrence + 1 + (carried if r.first_key == r.last_key else 0)
        manifest.append(
            {"shard": r.shard, "start": start, "tokens": r.tokens, "records": r.n, "carried": carried,
             "first_key": r.first_key}
        )
        before = {"last_key": r.last_key, "next": following}
        start += r.tokens
    records_total = sum(m["records"] for m in manifest)
    buckets = max(1, -(-records_total // BUCKET_KEYS))

    carried = [(m["shard"], m["first_key"], m["carried"]) for m in manifest if m["carried"]]
    if carried:
        more = spark.createDataFrame(carried, "shard int, doc_id long, carried long")
        same = (records["shard"] == more["shard"]) & records["doc_id"].eqNullSafe(more["doc_id"])
        records = records.join(F.broadcast(more), same, "left").select(
            records["doc_id"], (F.col("occurrence") + F.coalesce("carried", F.lit(0))).alias("occurrence"),
            records["shard"], "first", "n_tokens",
        )
    built = records.repartitionById(buckets, _bucket(buckets)).mapInPandas(
        lambda rows: _index_writer(rows, folder), "bucket int, n_keys long"
    )
    built.write.parquet(f"{folder}/buckets")
    records.select("doc_id", "occurrence").write.parquet(f"{folder}/keys")
    with published(folder, "manifest.json") as out:
        info = {"buckets": buckets, "tokenizer": os.path.basename(tokenizer), "end_id": end_id}
        out.write(json.dumps(info | {"shards": manifest}).encode())
    return folder


def read_manifest(folder: str) -> dict:
    with open_file(folder, "manifest.json") as f:
        return json.loads(f.read())


def _locator(frames, folder: str):
    held, index = None, None
    for pdf in frames:
        out = []
        for bucket, part in pdf.groupby("bucket", sort=False):
            if bucket != held:
                held, index = bucket, _read_index(folder, bucket)
            a, b = key_hashes(part.doc_id, part.occurrence.to_numpy())
            if index is None:
                continue
            mph, table = index
            slots = mph.slots(a, b)
            hit = (slots >= 0) & (table["print"][slots] == fingerprints(a, b))
            got = table[slots[hit]]
            out.append(
                part.loc[hit, ["doc_id", "occurrence"]].assign(
                    shard=got["shard"].astype(np.int32), first=got["first"].astype(np.int64),
                    n_tokens=got["n"].astype(np.int64),
                )
            )
        if out:
            yield pd.concat(out)


def _read_index(folder: str, bucket: int):
    store, root = filesystem(folder)
    path = f"{root}/index-{bucket:05d}.mph"
    if store.get_file_info(path).size is None:
        return None
    with store.open_input_file(path) as f:
        data = f.read()
    mph, at = PerfectHash.load(data, len(INDEX_MAGIC))
    return mph, np.frombuffer(data, SLOT, mph.n, at)


def locate(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Where each of `keys` (doc_id, occurrence) lies: shard, first, n_tokens. Keys that
    are not in the store have no row. Only the files of the index are read."""
    n = read_manifest(folder)["buckets"]
    parts = min(n, tasks_for(keys)) if n > 1 else 1
    keys = keys.select(F.col("doc_id").cast("long"), F.col("occurrence").cast("long"))
    bucketed = keys.withColumn("bucket", _bucket(n))
    if n > 1:
        bucketed = bucketed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    schema = f"{KEY_SCHEMA}, shard int, first long, n_tokens long"
    return bucketed.mapInPandas(lambda rows: _locator(rows, folder), schema)


def _reader(frames, folder: str, digest: bool):
    held, f, width = None, None, 0
    for pdf in frames:
        out = []
        for doc_id, occ, shard, first, n in zip(*(pdf[c] for c in pdf.columns)):
            if shard != held:
                f, held = open_file(folder, f"shard-{shard:05d}.bin"), shard
                magic, width, number = HEADER.unpack(f.read(HEADER.size))
                if magic != MAGIC or number != shard:
                    raise ValueError(f"shard {shard} is not one of this format")
            f.seek(HEADER.size + width * first)
            ids = np.frombuffer(f.read(width * n), f"<u{width}").astype("<u4")
            if len(ids) != n:
                raise ValueError(f"shard {shard} is cut short")
            out.append(zlib.crc32(ids.tobytes()) if digest else ids.astype(np.int64))
        rest = pdf.assign(value=out)
        yield rest.rename(columns={"value": "ids_crc32" if digest else "ids"})


def fetch(spark: SparkSession, folder: str, keys: DataFrame, digest: bool = False) -> DataFrame:
    """The stored ids of `keys`, read from the shards at the places the index names:
    doc_id, occurrence, start (ids of all documents before it), n_tokens and ids, or
    their crc32 with `digest`."""
    manifest = read_manifest(folder)["shards"]
    starts = spark.createDataFrame(
        [(m["shard"], m["start"]) for m in manifest], "shard int, shard_start long"
    )
    found = locate(spark, folder, keys).repartition(max(1, len(manifest)), "shard")
    found = found.sortWithinPartitions("shard", "first")
    value = "ids_crc32 long" if digest else "ids array<long>"
    schema = f"{KEY_SCHEMA}, shard int, first long, n_tokens long, {value}"
    rows = found.mapInPandas(lambda rows: _reader(rows, folder, digest), schema)
    return rows.join(F.broadcast(starts), "shard").select(
        "doc_id", "occurrence", (F.col("shard_start") + F.col("first")).alias("start"),
        "n_tokens", value.split()[0],
    )


def stored_keys(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(KEY_SCHEMA).parquet(f"{folder}/keys")
