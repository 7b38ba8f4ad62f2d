"""WARC archives compressed record by record with a dictionary that each archive carries.

    archive := skippable frame (0x184D2A5D) with the dictionary, then one zstandard frame per record

``write`` trains each archive's dictionary on its first records (``SAMPLE`` bytes at most, a documented bound), so an archive
needs nothing beside it and a task needs no other task. Of pages with equal payloads of ``least`` bytes or more the one with the
smallest id is written as a response, the others as revisits that refer to it and carry no payload. ``read`` gives a row per record.

Pages stay where they were read; only (id, digest) pairs are grouped, and pages that a small bit table lets through are joined
with the list of revisits. An archive is written by one task under a name of its own, and the list of archives that counts is the
staged result of the tasks that ended well.

Defined results: a null payload is empty; pages without an id are responses and no page refers to them; rows with equal ids and
payloads are all responses if their id is the smallest; an empty table makes no archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import shared
from ledgerloom.llm.sieve import sieve
from ledgerloom.session import fresh_dir, stage

MAGIC = 0x184D2A5D
DICTIONARY = 64 * 1024
SAMPLE = 2 * 1024 * 1024
ARCHIVE = 64 * 1024 * 1024  # bytes of records, before compression, after which the next archive begins
CHUNK = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("5b0f8d5e-9a3b-4c53-8a86-1f0f4b6f5a11")


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, digest if page is None else str(page))}>"


def record(page: int | None, url: str | None, date: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head of the full payload and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {''.join(c if c > ' ' else f'%{ord(c):02X}' for c in url or '')}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page is not None:
        lines.append(f"WARC-Page-ID: {page}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, bytes of the full payload and the payload held of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, length, payload


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on ``records``; where these are too few or too small to train on, their end is the dictionary."""
    samples, size = [], 0
    for x in records:
        samples.append(x[: SAMPLE - size])
        size += len(samples[-1])
        if size >= SAMPLE:
            break
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, size // 8)), samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    def __init__(self, sink, level: int):
        self._sink, self._level, self._pack = sink, level, None
        self._held: list[bytes] = []
        self._held_size = self.size = self.records = 0

    def add(self, data: bytes) -> None:
        self.size += len(data)
        self.records += 1
        if self._pack:
            self._sink.write(self._pack.compress(data))
            return
        self._held.append(data)
        self._held_size += len(data)
        if self._held_size >= SAMPLE:
            self._begin()

    def _begin(self) -> None:
        own = dictionary(self._held)
        content = own.as_bytes()
        self._sink.write(struct.pack("<II", MAGIC, len(content)) + content)
        self._pack = zstandard.ZstdCompressor(level=self._level, dict_data=own, write_checksum=True, write_content_size=True)
        for x in self._held:
            self._sink.write(self._pack.compress(x))
        self._held = []

    def close(self) -> None:
        if self._pack is None:
            self._begin()


def records(source) -> Iterator[bytes]:
    """The records of one archive, one frame after the other."""
    magic, length = struct.unpack("<II", source.read(8))
    if magic != MAGIC:
        raise ValueError("the archive does not begin with its dictionary")
    own = zstandard.ZstdCompressionDict(source.read(length))
    reader = zstandard.ZstdDecompressor(dict_data=own)
    data = source.read(CHUNK)
    while data:
        frame, out = reader.decompressobj(), []
        while True:
            out.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data or source.read(CHUNK)
                break
            data = source.read(CHUNK)
            if not data:
                raise ValueError("the archive ends inside a record")
        yield b"".join(out)


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100,
    date: str = "2024-01-01T00:00:00Z", level: int = 3, folder: str | None = None,
) -> DataFrame:
    """Write archives to the shared folder; returns the staged list of archives (path, records, bytes)."""
    spark = pages.sparkSession
    shared.ship(spark)
    folder = folder or fresh_dir(spark, "warc")
    shared.make_folder(folder)
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    keyed = rows.filter((F.octet_length("body") >= least) & F.col("id").isNotNull()).select("id", "digest")
    keyed = stage(keyed, "warc-digests")
    firsts = keyed.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("digest", "first")
    again = stage(keyed.join(firsts, "digest").filter("id != first").distinct(), "warc-revisits")
    marked = sieve(rows, "id", again, "id")
    plain = marked.filter(~F.col("_maybe")).withColumn("first", F.lit(None).cast("long"))
    checked = marked.filter("_maybe").join(again, ["id", "digest"], "left")
    names = ["id", "url", "body", "digest", "first"]

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = shared.place(folder)
        writer = sink = name = None

        def done() -> pa.RecordBatch:
            writer.close()
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [writer.records], "bytes": [writer.size]}, MANIFEST)

        for batch in batches:
            for page, link, content, digest, first in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                if writer is None:
                    name = shared.new_name("pages", ".warc.zst")
                    sink = system.open_output_stream(f"{path}/{name}", compression=None)
                    writer = ArchiveWriter(sink, level)
                writer.add(record(page, link, date, content, digest, first))
                if writer.size >= ARCHIVE:
                    yield done()
                    writer = None
        if writer:
            yield done()

    both = plain.select(names).unionByName(checked.select(names))
    return stage(both.mapInArrow(save, "path string, records long, bytes long"), "warc-archives")


ROWS = pa.schema([("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def read(archives: DataFrame, id: str = "page_id", with_payload: bool = True) -> DataFrame:
    """One row per record of the archives; payloads held are checked against their digests."""
    count = max(1, archives.count())

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                system, path = shared.place(uri)
                out, size = [], 0
                with system.open_input_stream(path, compression=None) as source:
                    for data in records(source):
                        out.append(_row(*parse(data), with_payload))
                        size += len(data) if with_payload else 500
                        if size > 8_000_000:
                            yield pa.RecordBatch.from_pylist(out, ROWS)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, ROWS)

    schema = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    rows = archives.select("path").repartition(count, "path").mapInArrow(load, schema).withColumnRenamed("id", id)
    return rows if with_payload else rows.drop("payload")


def _row(fields: dict[str, str], length: int, payload: bytes, with_payload: bool) -> dict:
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    page, first = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
    return {
        "id": None if page is None else int(page), "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": None if first is None else int(first), "url": fields["WARC-Target-URI"], "payload": payload if with_payload and kind == "response" else None,
    }
