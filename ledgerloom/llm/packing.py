"""Cost-balanced packing of documents into sequences of at most ``capacity`` tokens.

A piece of n tokens costs ``linear * n + quadratic * n * n``. A task packs a block of documents at a time: full
sequences are cut off long documents, and what is left is taken in descending length, each piece going to the
sequence of the lowest cost that has room for it. A piece that fits nowhere is cut to fill the cheapest
sequence with any room. As many sequences are opened as the block's tokens fill exactly; the rest waits for the
next block. At the end of a task the last tokens (fewer than ``capacity``) go into sequences whose lengths are
powers of two, which need no padding. Nothing is shuffled, and a task holds one block.

Defined results: a null text is the end id alone; a text of any length is cut; repeated rows and equal or null
ids are packed row by row; an empty table has no sequences; other columns are ignored. Sequence numbers are the
partition's number and a count in it, so a task that is run again gives the same ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import shared, tokens

SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
ARROW = pa.schema([(n, pa.int64()) for n in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())])

Piece = tuple  # (length, number of the document in the block, start)


class Packer:
    """Packs the documents of one partition; ``place`` takes pieces (length, document, start) and sequences' numbers."""

    def __init__(self, capacity: int, linear: float, quadratic: float, first: int):
        self.capacity, self.linear, self.quadratic, self.next = capacity, linear, quadratic, first

    def _cost(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n

    def fill(self, pieces: list[Piece]) -> tuple[list[tuple], list[Piece]]:
        """Fill as many sequences as the pieces fill exactly: (piece, sequence, offset) of those placed, and the pieces left."""
        placed, waiting = [], []
        for length, doc, start in pieces:
            while length >= self.capacity:
                placed.append(((self.capacity, doc, start), self.next, 0))
                self.next += 1
                start, length = start + self.capacity, length - self.capacity
            if length:
                waiting.append((length, doc, start))
        bins = sum(x[0] for x in waiting) // self.capacity
        if not bins:
            return placed, waiting
        room, cost = np.full(bins, self.capacity), np.zeros(bins)
        left: list[Piece] = []
        todo = sorted(waiting, key=lambda x: (-x[0], x[1], x[2]))[::-1]
        while todo:
            length, doc, start = todo.pop()
            fits = np.flatnonzero(room >= length)
            if not len(fits):
                fits = np.flatnonzero(room)
                if not len(fits):
                    left.append((length, doc, start))
                    continue
            k = fits[np.argmin(cost[fits])]
            n = int(min(length, room[k]))
            placed.append(((n, doc, start), self.next + int(k), int(self.capacity - room[k])))
            room[k] -= n
            cost[k] += self._cost(n)
            if n < length:
                todo.append((length - n, doc, start + n))
        self.next += bins
        return placed, left

    def finish(self, pieces: list[Piece]) -> list[tuple]:
        """The last pieces, fewer tokens than a sequence holds, in sequences of lengths that are powers of two."""
        placed, todo, total = [], list(pieces)[::-1], sum(x[0] for x in pieces)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            offset = 0
            while offset < size:
                length, doc, start = todo.pop()
                n = min(length, size - offset)
                placed.append(((n, doc, start), self.next, offset))
                offset += n
                if n < length:
                    todo.append((length - n, doc, start + n))
            self.next += 1
        return placed


def pack(
    docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", end_id: int = 2, capacity: int = 4096,
    linear: float = 4096.0, quadratic: float = 1.0, block: int = 1 << 20, with_ids: bool = True,
    special_as_text: bool = True,
) -> DataFrame:
    """One row per piece: its document, place in it, place in a sequence, checksum and (``with_ids``) its ids; ``special_as_text`` as in ``tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, linear, quadratic, TaskContext.get().partitionId() << 40)
        end = np.asarray([end_id], "<u4").tobytes()
        held: list[tuple] = []  # (id, ids, first id that is still here, ids of the whole document)
        waiting: list[Piece] = []
        size = 0

        def rows(placed: list[tuple]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(placed), 20_000):
                out: dict[str, list] = {n: [] for n in ARROW.names}
                for (n, doc, start), sequence, offset in placed[at : at + 20_000]:
                    key, ids, gone, whole = held[doc]
                    part = ids[(start - gone) * 4 : (start - gone + n) * 4]
                    for name, value in zip(ARROW.names, (key, start, n, zlib.crc32(part), whole, sequence, offset, part if with_ids else None), strict=True):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, ARROW)

        for batch in batches:
            coded = tokens.encoder(vocabulary, special_as_text).encode(batch.column("text").to_pylist())
            for key, ids in zip(batch.column("id").to_pylist(), coded, strict=True):
                ids += end
                n = len(ids) // 4
                held.append((key, ids, 0, n))
                waiting.append((n, len(held) - 1, 0))
                size += n
                if size >= block:
                    placed, left = packer.fill(waiting)
                    yield from rows(placed)
                    kept = [(held[d][0], held[d][1][(s - held[d][2]) * 4 : (s - held[d][2] + n) * 4], s, held[d][3]) for n, d, s in left]
                    waiting = [(n, k, s) for k, (n, _, s) in enumerate(left)]
                    held, size = kept, sum(x[0] for x in left)
        placed, left = packer.fill(waiting)
        yield from rows(placed)
        yield from rows(packer.finish(left))

    shared.ship(docs.sparkSession)
    base = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    pieces = base.mapInArrow(run, SCHEMA).withColumnRenamed("id", id)
    return pieces if with_ids else pieces.drop("ids")
