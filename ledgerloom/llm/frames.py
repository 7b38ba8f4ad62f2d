"""Token files: independent zstandard frames with a trailing seek table and a checksum for each frame.

    file  := frame+ index seek-table
    frame := the ids (little-endian unsigned 32-bit) of whole documents, about ``FRAME_IDS`` of them; a longer
             document is cut into frames of its own
    index := a frame with one entry per document: document id and its presence, ids before it in the file, ids

The seek table is the public seekable format: a skippable frame with compressed size, decompressed size and
checksum (low 32 bits of XXH64 of the content) of every frame, and a footer. Plain zstandard readers see one
stream of ids; ``TokenFile.document`` decompresses the frames of one document only.

``write`` deals documents into files by ranges of their id, so files hold ascending ids; ``read`` gives a row
per document. Defined results: a null text is an empty document (the end id alone); a null id comes first;
rows with equal ids stand side by side, ordered by text; an empty table makes no file; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import shared, tokens
from ledgerloom.session import fresh_dir, stage

FRAME_IDS = 32_768
MAX_FRAME_IDS = 1 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY = struct.Struct("<qBQQ")
FILE_BYTES = 32 << 20
START = 64  # characters of a text that ranges look at


class TokenFileWriter:
    def __init__(self, sink, level: int = 3):
        self._sink, self._pack = sink, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self._held: list[bytes] = []
        self._size = self.ids = self.documents = 0
        self._frames: list[tuple[int, int, int]] = []
        self._index: list[bytes] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        count = len(ids) // 4
        if self._size and self._size + len(ids) > FRAME_IDS * 4:
            self._flush()
        self._index.append(ENTRY.pack(doc_id or 0, doc_id is not None, self.ids, count))
        self.ids += count
        self.documents += 1
        self._held.append(ids)
        self._size += len(ids)
        if self._size >= FRAME_IDS * 4:
            self._flush()

    def _flush(self) -> None:
        content = b"".join(self._held)
        for at in range(0, len(content), MAX_FRAME_IDS * 4):
            self._frame(content[at : at + MAX_FRAME_IDS * 4])
        self._held, self._size = [], 0

    def _frame(self, content: bytes) -> None:
        packed = self._pack.compress(content)
        self._sink.write(packed)
        self._frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        self._flush()
        self._frame(b"".join(self._index))
        table = b"".join(struct.pack("<III", *x) for x in self._frames)
        footer = struct.pack("<IBI", len(self._frames), CHECKSUMS, SEEKABLE)
        self._sink.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


class TokenFile:
    """Random access to one file through its seek table."""

    def __init__(self, source, size: int):
        self._source, self._unpack = source, zstandard.ZstdDecompressor()
        count, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table = np.frombuffer(self._bytes(size - 9 - 12 * count, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        self._at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self._from = np.concatenate([[0], np.cumsum(table[:, 1])])
        self._sums = table[:, 2]
        index = self._frame(count - 1)
        self.entries = [(key if known else None, start, n) for key, known, start, n in ENTRY.iter_unpack(index)]
        self._last: tuple[int, bytes] = (-1, b"")

    def _bytes(self, at: int, length: int) -> bytes:
        self._source.seek(at)
        return self._source.read(length)

    def _frame(self, k: int) -> bytes:
        content = self._unpack.decompress(self._bytes(int(self._at[k]), int(self._at[k + 1] - self._at[k])))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self._sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def document(self, entry: int) -> bytes:
        """The ids of one document, from its own frames."""
        _, start, count = self.entries[entry]
        at, end, out = start * 4, (start + count) * 4, []
        k = int(np.searchsorted(self._from, at, "right")) - 1
        while at < end:
            if self._last[0] != k:
                self._last = (k, self._frame(k))
            low = int(self._from[k])
            out.append(self._last[1][at - low : end - low])
            k += 1
            at = int(self._from[k])
        return b"".join(out)


def write(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", end_id: int = 1, file_bytes: int = FILE_BYTES, folder: str | None = None, special_as_text: bool = True) -> DataFrame:
    """Write token files to the shared folder; returns the staged list of files, in order of ids.

    Documents are dealt by ranges of (id, start of the text), as many as texts of ``file_bytes`` bytes make; a range is one task and one
    file, so rows with one id may fill several. ``special_as_text`` is explained in ``tokens``.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    folder = folder or fresh_dir(spark, "tokens")
    shared.make_folder(folder)
    base = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    ranged = base.withColumn("start", F.substring("text", 1, START)).repartitionByRange(files, "id", "start")
    dealt = ranged.sortWithinPartitions("id", "text").withColumn("file", F.spark_partition_id())

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = shared.place(folder)
        writer = sink = name = current = None

        def done() -> pa.RecordBatch:
            writer.close()
            sink.close()
            row = {"file": [current], "path": [f"{folder}/{name}"], "documents": [writer.documents], "ids": [writer.ids]}
            return pa.RecordBatch.from_pydict(row, FILES)

        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            coded = tokens.encoder(vocabulary, special_as_text).encode(batch.column("text").to_pylist())
            for file, doc, ids in zip(batch.column("file").to_pylist(), batch.column("id").to_pylist(), coded, strict=True):
                if file != current:
                    if writer:
                        yield done()
                    current, name = file, shared.new_name(f"tokens-{file:06d}", ".zst")
                    sink = system.open_output_stream(f"{path}/{name}", compression=None)
                    writer = TokenFileWriter(sink)
                writer.add(doc, ids + end)
        if writer:
            yield done()

    return stage(dealt.select("file", "id", "text").mapInArrow(save, "file int, path string, documents long, ids long"), "token-files")


FILES = pa.schema([("file", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])
READ = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read(files: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row per document of the files: ids before it in all files, its number of ids and their CRC-32.

    The running total is over the list of files, one row each.
    """
    before = F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    listed = stage(files.select("path", F.coalesce(before, F.lit(0)).alias("base")), "token-bases")
    count = max(1, listed.count())

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                system, path = shared.place(uri)
                with system.open_input_file(path) as source:
                    file = TokenFile(source, source.size())
                    sums = [zlib.crc32(file.document(k)) for k in range(len(file.entries))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": [x[0] for x in file.entries],
                        "start": [base + x[1] for x in file.entries],
                        "n_tokens": [x[2] for x in file.entries],
                        "ids_crc32": sums,
                    },
                    READ,
                )

    rows = listed.repartition(count, "path").mapInArrow(load, "id long, start long, n_tokens long, ids_crc32 long")
    return rows.withColumnRenamed("id", id)
