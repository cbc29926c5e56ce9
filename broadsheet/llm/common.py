"""Shared pieces of the training-text operators: words, hashing, files in the shared
folder, and tables written there to cut lineage."""

from __future__ import annotations

import contextlib
import posixpath
import re
import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_PATTERN)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())

MASK = (1 << 64) - 1


def lower_words(text: str | None) -> list[bytes]:
    """The words with A-Z as a-z, in UTF-8: bytes.split() parts at \\x20 and
    \\x09-\\x0D and nowhere else."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split() if text else []


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text) if text else []


# Rows that go to a Python worker at a time: whole texts may be long.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small, whatever the session had before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one all executors share: `spark.checkpoint.dir` where the
    session names it, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = posixpath.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")
    return posixpath.join(root, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: computed once, and safe when
    executors go."""
    path = posixpath.join(shared_folder(df.sparkSession, name), "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, on the driver or on an executor."""
    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


@contextlib.contextmanager
def published(folder: str, name: str) -> Iterator:
    """A file that appears under its name only when it is complete. A task that runs
    again, or twice at once, writes the same bytes beside it and replaces it."""
    store, root = filesystem(folder)
    store.create_dir(root, recursive=True)
    part = f"{root}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        yield out
    store.move(part, f"{root}/{name}")


def open_file(folder: str, name: str):
    store, root = filesystem(folder)
    return store.open_input_file(f"{root}/{name}")


def tasks_for(df: DataFrame, bytes_each: int = 64 << 20) -> int:
    """Partitions for the rows of `df`: by the bytes the optimiser knows of, and no
    fewer than the session asks for."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = size if size < 1 << 60 else 0
    return max(asked, -(-known // bytes_each))


def crc_bucket(column: str | Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null counts as remainder null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def document_keys() -> tuple[Column, Column]:
    """A document is its doc_id and its text: both, since either may repeat. Two numbers,
    never null, that tell documents apart."""
    text = F.coalesce("text", F.lit(""))
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.xxhash64(F.col("doc_id").isNull(), text)


def identified(docs: DataFrame) -> DataFrame:
    """`docs` with the keys of its documents as _id and _version."""
    return docs.withColumns(dict(zip(("_id", "_version"), document_keys())))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of `df` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    LIMIT = 150_000

    def __missing__(self, word: str | bytes) -> int:
        data = word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass")
        h = xxhash.xxh3_64_intdigest(data)
        if len(self) < self.LIMIT:
            self[word] = h
        return h


WORD_HASHES = WordHashes()


def hashed(words: list[str] | list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of n values: a polynomial in an odd base, modulo 2**64,
    built from the windows of half the length."""
    if len(h) < n:
        return h[:0]
    base = 0x9E3779B97F4A7C15
    out, done = h.copy(), 1
    with np.errstate(over="ignore"):
        for bit in bin(n)[3:]:
            step = np.uint64(pow(base, done, 1 << 64))
            out = out[: len(out) - done] * step + out[done:]
            done *= 2
            if bit == "1":
                out = out[: len(out) - 1] * np.uint64(base) + h[done : done + len(out) - 1]
                done += 1
    return mix(out)
