"""WARC archives in Zstandard with an embedded dictionary, written and read in tasks.

An archive starts with a skippable frame that holds a dictionary built from the
archive's first records; each record is a frame of its own, compressed with it,
so a reader can start at any record.  Of records with equal payloads one is a
response and the others are revisits without a body.  A task names its archives
uniquely and reports them as rows; only the rows of tasks that Spark commits
reach the manifest, so a lost executor leaves at worst files that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm._shared import written
from tidewatch.session import scratch_path

DICTIONARY_FRAME = 0x184D2A5D  # skippable frame that carries the dictionary
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20         # records held back to build the dictionary from
SLICE_BYTES = 64 << 10         # pieces of them that it is trained on
ARCHIVE_BYTES = 1 << 30        # uncompressed bytes after which a task starts another archive
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: object) -> bytes:
    return f"{name}: {str(value).replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n".encode("utf-8", "replace")


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries the HTTP headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", len(payload)) + b"\r\n"
    block = http + payload if kind == "response" else http
    sha = digest(payload)
    head = [b"WARC/1.1\r\n", _line("WARC-Type", kind),
            _line("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}')}>"),
            _line("WARC-Date", DATE), _line("WARC-Target-URI", url or ""),
            _line("WARC-Payload-Digest", f"sha1:{sha}"), _line("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        head.append(_line("X-Page-Id", page_id))
    if kind == "revisit":
        head += [_line("WARC-Profile", REVISIT_PROFILE),
                 _line("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{refers_to}')}>")]
        if refers_to is not None:
            head.append(_line("X-Refers-To-Page-Id", refers_to))
    head.append(_line("Content-Length", len(block)))
    return b"".join(head) + b"\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstd.ZstdCompressionDict | None:
    """A dictionary trained on slices of the records.  Where these are too few or too plain to
    train on, the beginnings of the records, a quarter of their bytes at most, are the
    dictionary; none without records."""
    samples = [r[i:i + SLICE_BYTES] for r in records for i in range(0, len(r), SLICE_BYTES)]
    try:
        if len(samples) >= 8:
            return zstd.train_dictionary(DICTIONARY_BYTES, samples)
    except zstd.ZstdError:  # not enough to learn from
        pass
    share = min(DICTIONARY_BYTES, sum(map(len, records)) // 4)
    each = max(64, share // max(1, len(records)))
    raw = b"".join(r[:each] for r in records)[:share]
    return zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None


class Archive:
    """One archive being written: holds back the first records, then streams."""

    def __init__(self, out: BinaryIO):
        self.out, self.held, self.held_bytes, self.packer = out, [], 0, None
        self.records = self.plain = self.stored = 0

    def add(self, rec: bytes) -> None:
        self.records += 1
        self.plain += len(rec)
        if self.packer is None:
            self.held.append(rec)
            self.held_bytes += len(rec)
            if self.held_bytes >= SAMPLE_BYTES:
                self._begin()
        else:
            self._put(self.packer.compress(rec))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.stored += len(data)

    def _begin(self) -> None:
        trained = dictionary(self.held)
        if trained:
            raw = trained.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
        self.packer = zstd.ZstdCompressor(level=LEVEL, dict_data=trained)
        for rec in self.held:
            self._put(self.packer.compress(rec))
        self.held = []

    def close(self) -> None:
        if self.packer is None:
            self._begin()
        self.out.close()


def read_archive(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    head = source.read(8)
    trained, rest = None, head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        trained = zstd.ZstdCompressionDict(source.read(struct.unpack("<I", head[4:])[0]))
        rest = b""
    unpacker, buffer = zstd.ZstdDecompressor(dict_data=trained), bytearray()
    frame, begun = unpacker.decompressobj(), False
    while True:
        chunk = rest or source.read(1 << 20)
        rest = b""
        if not chunk:
            break
        while chunk:
            buffer += frame.decompress(chunk)
            chunk = frame.unused_data if frame.eof else b""
            begun = not frame.eof
            if frame.eof:  # one frame is one record
                yield _parse(bytes(buffer))
                buffer.clear()
                frame = unpacker.decompressobj()
    if begun:
        raise ValueError("the archive ends inside a record")


def _parse(rec: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = rec.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if ": " in line)}
    block = rest[:int(headers["content-length"])]
    if first != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, block


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, archive, done = "", None, []

        def finish() -> None:
            archive.close()
            done.append((name, archive.records, archive.plain, archive.stored))

        for batch in batches:
            for page_id, url, html, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    archive = Archive(store.open_output_stream(f"{base}/{name}"))
                archive.add(record(page_id, url, (html or "").encode(), kind, refers_to))
                if archive.plain >= ARCHIVE_BYTES:
                    finish()
                    archive = None
        if archive is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done]) for i in range(4)],
                                             names=["name", "records", "plain_bytes", "stored_bytes"])
    return run


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{name}") as source:
                    for headers, block in read_archive(source):
                        rows.append(_row(headers, block))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                yield _rows(rows)
    return run


def _row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    sha = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response" and (len(payload) != size or digest(payload) != sha):
        raise ValueError(f"damaged payload in record {headers['warc-record-id']}")
    number = lambda key: int(headers[key]) if key in headers else None
    return number("x-page-id"), headers["warc-target-uri"], size, sha, headers["warc-type"], number("x-refers-to-page-id")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                      names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per page; returns the manifest (name, records, plain_bytes, stored_bytes).

    Of pages with equal payloads of ``min_bytes`` or more, the one with the largest
    id is a response and the others revisit it.  A null html is an empty payload.
    A null id is less than any other and keeps its record; rows that share the
    largest id are all responses.  Other columns are ignored; no pages, no archives.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    twins = (rows.where(F.octet_length("html") >= min_bytes).groupBy("sha")
             .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("sha", "last"))
    marked = rows.join(twins, "sha", "left")
    first = F.col("last").isNull() | (F.coalesce(F.col("page_id"), F.lit(-2**63)) == F.col("last"))
    marked = marked.select("page_id", "url", "html", F.when(first, "response").otherwise("revisit").alias("kind"),
                           F.when(first, F.lit(None).cast("long")).otherwise(F.col("last")).alias("refers_to"))
    return written(marked.mapInArrow(_write(folder), "name string, records long, plain_bytes long, stored_bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of all
    records, the payload of every response held against its digest."""
    archives = max(1, manifest.count())
    one_each = manifest.select("name", (F.row_number().over(Window.orderBy("name")) - 1).alias("task"))  # a row per archive
    return one_each.repartitionById(archives, "task").select("name").mapInArrow(
        _read(folder), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Archive the pages (under the shared folder by default) and read the archives back."""
    folder = folder or scratch_path(pages.sparkSession, "llm-warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = f"file://{folder[len('file:'):]}"
    return read_archives(write_archives(pages, folder, min_bytes), folder)
