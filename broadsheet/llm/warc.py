"""Web archives with a Zstandard dictionary, one compressed frame for each record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import open_file, published, shared_folder, small_batches, written
from broadsheet.operators.joins import skew_join

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME_HEAD = struct.Struct("<II")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SAFE = "%/:?#[]@!$&'()*+,;=~-._"

DICTIONARY_BYTES = 32 * 1024
# Records at the head of a file that its dictionary is made from; they wait in memory.
SAMPLE_BYTES = 2 * 1024 * 1024
MIN_PAYLOAD = 0
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
# With so many repeated payloads or fewer (about 100 bytes each), their first pages go
# to every task; beyond that, pages and first pages meet by a join that splits hot keys.
BROADCAST_PAYLOADS = 200_000


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """A response with the payload, or a revisit of the page `refers_to` without it."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    headers = [("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url:
        headers.append(("WARC-Target-URI", quote(url, safe=SAFE, errors="replace")))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"))
    headers.append(("Content-Type", "application/http;msgtype=response"))
    if refers_to is None:
        return _record("response", headers, http + payload)
    headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return _record("revisit", headers, http)


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on the records; where they are too few for that, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to a stream: dictionary first, then a frame a record."""

    def __init__(self, out):
        self.out, self.waiting, self.size, self.compressor = out, [], 0, None
        self.add(_record("warcinfo", [("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                         b"format: WARC/1.1\r\n"))

    def add(self, record: bytes) -> None:
        if self.compressor:
            self.out.write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.size += len(record)
        if self.size >= SAMPLE_BYTES:
            self.start()

    def start(self) -> None:
        dictionary = build_dictionary(self.waiting)
        data = dictionary.as_bytes()
        self.out.write(FRAME_HEAD.pack(DICTIONARY_FRAME, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        waiting, self.waiting = self.waiting, []
        for record in waiting:
            self.out.write(self.compressor.compress(record))

    def close(self) -> None:
        if not self.compressor:
            self.start()


def records_in(stream, chunk: int = 1 << 17) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case, the kind as 'warc-type') and block of each record."""
    magic, size = FRAME_HEAD.unpack(stream.read(FRAME_HEAD.size))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    dictionary = zstandard.ZstdCompressionDict(stream.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = b""
    while rest := rest or stream.read(chunk):
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            rest = stream.read(chunk)
            if not rest:
                raise ValueError("the archive is cut short")
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        yield headers, body[: int(headers["content-length"])]


WRITTEN = pa.schema([("file", pa.string()), ("n_records", pa.int64())])


def _writer(batches, folder: str):
    name, archive, n = f"part-{TaskContext.get().partitionId():05d}.warc.zst", None, 0
    batches = (b for b in batches if b.num_rows)
    first = next(batches, None)
    if first is None:
        return
    with published(folder, name) as out:
        archive = ArchiveWriter(out)
        for batch in (b for bs in ([first], batches) for b in bs):
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                archive.add(page_record(page_id, url, html.encode(errors="surrogatepass"), refers_to))
            n += batch.num_rows
        archive.close()
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], schema=WRITTEN)


def write_archives(pages: DataFrame, folder: str | None = None, min_payload: int = MIN_PAYLOAD) -> str:
    """Archive `pages` (page_id, url, html; other columns are not read) as files
    `part-NNNNN.warc.zst` in a new folder, which is returned; a file for each partition
    that has rows.

    The payload is html in UTF-8; null is the empty payload. Of pages with equal
    payloads of at least `min_payload` bytes, those with the smallest page_id are
    responses and the others revisit it; rows that repeat page_id and payload are one
    page archived twice, both times as the same kind. A null page_id counts as larger
    than any; where all are null, all are responses. A null url leaves out its header.
    No rows give an empty list of files.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or shared_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha1(F.encode("html", "UTF-8"))
    large = F.octet_length("html") >= min_payload
    firsts = (
        rows.filter(large).groupBy(digest.alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    firsts = written(firsts, "payloads")
    keyed = rows.withColumn("_digest", F.when(large, digest))
    short = firsts.select("_digest", "_first")
    if firsts.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS:
        joined = keyed.join(F.broadcast(short), "_digest", "left")
    else:
        joined = skew_join(keyed, short, "_digest", "page_id", "left", firsts.select("_digest", "n"))
    revisits = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    typed = joined.select("page_id", "url", "html", F.when(revisits, F.col("_first")).alias("refers_to"))
    files = typed.mapInArrow(lambda rows: _writer(rows, folder), "file string, n_records long")
    files.write.parquet(f"{folder}/files")
    return folder


ID = re.compile(r"<urn:page:(-?\d*)>")
ROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())]
)


def _page_row(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    number = lambda name: int(m[1]) if (m := ID.match(headers.get(name, ""))) and m[1] else None
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (digest_of(payload) != digest or len(payload) != size):
        raise ValueError(f"the payload of {headers['warc-record-id']} is not the one archived")
    text = payload.decode(errors="surrogatepass") if payloads and kind == "response" else None
    return number("warc-record-id"), headers.get("warc-target-uri"), size, digest, kind, number("warc-refers-to"), text


def _reader(batches, folder: str, payloads: bool):
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows, size = [], 0
            with open_file(folder, name) as stream:
                for headers, block in records_in(stream):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    rows.append(_page_row(headers, block, payloads))
                    size += len(rows[-1][-1] or "") + 200
                    if size > 4_000_000:
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ROW)], schema=ROW)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The page records of the archives in `folder`, a task for each file: page_id, url,
    payload_bytes and payload_digest of the full payload, record_type, refers_to, and
    with `payloads` the html of responses. Payloads are checked against their digest."""
    files = spark.read.schema("file string, n_records long").parquet(f"{folder}/files").select("file")
    n = max(1, files.count())
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, payload string")  # fmt: skip
    rows = files.repartition(n).mapInArrow(lambda rows: _reader(rows, folder, payloads), schema)
    return rows if payloads else rows.drop("payload")
