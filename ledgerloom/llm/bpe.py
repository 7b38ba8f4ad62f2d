"""Byte-level BPE in column expressions: ranked merges folded over the bytes of words, with the ranks as a literal.

A word is folded as an array of pieces, at first one a byte. What two neighbours join to is one place of a literal array, at the second
piece's id beyond an offset of the first one's (``_displaced``); a step joins the leftmost pair of the least rank.

The distinct words of the corpus are counted; those that most documents hold (``FREQUENT`` at most, a documented bound) are folded once
and sent to all tasks, together with the words that are pieces themselves. Tasks cut texts into words in Arrow batches and look these
words up; all others are folded after that, each where it stands, so every word is encoded by the same merges. Decoding looks the pieces
up by id and joins them.

Defined results: a null text is empty and has no ids; a text of any length is encoded whole, though a single word of n bytes takes
about n^2 steps' work; repeated rows are encoded row by row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import contextlib
import json
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import new_name, ship
from ledgerloom.session import small_batches, stage

FREQUENT = 1 << 19
CUT = 2_000_000  # characters of texts cut together
RANK_BITS, PLACE_BITS = 18, 26  # of a rank, and of a place in a word
# the pattern's \s is Unicode white space, Java's is not
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def java_pattern(pattern: str) -> str:
    """The same pattern for Java: white space written out, inside classes and outside."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        two = pattern[at : at + 2]
        if two[0] == "\\":
            if two == r"\s":
                out.append(SPACE if inside else f"[{SPACE}]")
            elif two == r"\S":
                if inside:
                    raise ValueError("\\S inside a class")
                out.append(f"[^{SPACE}]")
            else:
                out.append(two)
            at += 2
            continue
        inside = (inside or two[0] == "[") and two[0] != "]"
        out.append(two[0])
        at += 1
    return "".join(out)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def latin(text: Column) -> Column:
    """The UTF-8 bytes of ``text`` as code points 0 to 255."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


def _with(value: Column, body) -> Column:
    """``body`` over a variable that holds ``value``, so that a large literal stands in the plan once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def python_pattern(pattern: str) -> str:
    """The same pattern for the regex library, whose white space is wider: written out as for Java."""
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", java_pattern(pattern))


_KNOWN: dict[str, tuple[dict[str, int], np.ndarray, np.ndarray]] = {}  # of one encoder, as long as the worker lasts


def _known(name: str, table: bytes) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """A number for each word that is known, where its ids start, and all ids."""
    if name not in _KNOWN:
        _KNOWN.clear()
        rows = pa.ipc.open_stream(table).read_all().combine_chunks()
        words, ids = rows.column("word").combine_chunks(), rows.column("ids").combine_chunks()
        starts = np.asarray(ids.offsets).astype(np.int64)
        _KNOWN[name] = dict(zip(words.to_pylist(), range(len(words)), strict=True)), starts - starts[0], np.asarray(ids.flatten())
    return _KNOWN[name]


KNOWN = pa.schema([("word", pa.string()), ("ids", pa.list_(pa.int32()))])
PARTS = "array<struct<ids:array<int>,word:string>>"


def _cutter(pattern: str, name: str, sent):
    """Texts as parts: the ids of known words, then a word that is not known, or null at the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(pattern).findall
        known, starts, ids = _known(name, sent.value)

        def parts(texts: list[str | None]) -> pa.Array:
            codes, ends, words = [], [], []
            for text in texts:
                found = cut(text or "")
                codes.append(np.fromiter(map(known.get, found, repeat(-1)), np.int64, len(found)))
                words += [found[k] for k in np.flatnonzero(codes[-1] < 0).tolist()]
                words.append(None)
                codes.append(np.asarray([-1]))
                ends.append(len(words))
            code = np.concatenate(codes)
            sizes = np.where(code < 0, 0, starts[code + 1] - starts[np.maximum(code, 0)])
            upto = np.cumsum(sizes)
            flat = np.repeat(starts[np.maximum(code, 0)] - (upto - sizes), sizes) + np.arange(upto[-1])
            runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto[code < 0]]).astype(np.int32)), pa.array(ids[flat].astype(np.int32)))
            pairs = pa.StructArray.from_arrays([runs, pa.array(words, pa.string())], ["ids", "word"])
            return pa.ListArray.from_arrays(pa.array(np.asarray([0, *ends], np.int32)), pairs)

        for batch in batches:
            texts, at, size = batch.column("_text").to_pylist(), 0, 0
            for k, text in enumerate(texts):
                size += len(text or "")
                if size >= CUT or k + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays([batch.column("_id").slice(at, k + 1 - at), parts(texts[at : k + 1])], ["_id", "_parts"])
                    at, size = k + 1, 0

    return run


def _displaced(pairs: dict[int, dict[int, int]], size: int) -> tuple[list[int], list[int]]:
    """Rows of a sparse table laid into one array: the offset of each row, and the array, which holds ``row << RANK_BITS | value``.

    Long rows are laid first, each at the first offset from a running one where all its places are free. Free places name a row that is none.
    """
    none = (1 << 2 * RANK_BITS) - 1
    offsets, slots, at = [0] * size, [none] * (4 * sum(map(len, pairs.values())) + size), 0
    for row in sorted(pairs, key=lambda r: (-len(pairs[r]), r)):
        spots = list(pairs[row])
        low, room = min(spots), len(slots) - max(spots)
        at = max(at, -low)
        tries = 0
        while any(slots[at + b] != none for b in spots):
            at, tries = at + 1 if at + 1 < room else -low, tries + 1
            if tries > len(slots):
                slots += [none] * len(slots)
                room = len(slots) - max(spots)
        offsets[row] = at
        for b, value in pairs[row].items():
            slots[at + b] = row << RANK_BITS | value
        at = at + 1 if at + 1 < room else 0
    return offsets, slots


class ByteBPE:
    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.pattern, self.python = java_pattern(pattern), python_pattern(pattern)
        size = max(ranks.values()) + 1
        pieces = [""] * size
        for k, v in ranks.items():
            pieces[v] = base64.b64encode(k).decode()
        # bytes as strings that need not be UTF-8: strings can be joined
        raw = lambda x: F.from_json(F.lit(json.dumps(x)), "array<binary>").cast("array<string>")
        self.pieces = raw(pieces)
        self.codes = raw([base64.b64encode(i.to_bytes(4, "little")).decode() for i in range(size)])
        if size >= 1 << RANK_BITS:
            raise ValueError("too many pieces")
        pairs: dict[int, dict[int, int]] = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                one, two = ranks.get(piece[:k]), ranks.get(piece[k:])
                if one is not None and two is not None:
                    pairs.setdefault(one, {})[two] = rank
        offsets, slots = _displaced(pairs, size)
        numbers = lambda x, kind: F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), f"array<{kind}>")
        self._merges = F.struct(numbers([ranks[bytes([i])] for i in range(256)], "int").alias("bytes"), numbers(offsets, "int").alias("offsets"), numbers(slots, "bigint").alias("slots"))
        self._whole = {}  # a word is text
        for piece, rank in ranks.items():
            with contextlib.suppress(UnicodeDecodeError):
                self._whole[piece.decode()] = rank

    def _fold(self, tables: Column, word: Column) -> Column:
        """The ids of a word that is no piece itself: of two bytes or more."""
        joins = 1 << (RANK_BITS + PLACE_BITS)

        def least(x: Column) -> Column:
            """The least rank of neighbours and the leftmost place that has it, as one number; ``joins`` or more if none join."""

            def at(i: Column) -> Column:
                one = F.get(x, i)
                held = F.get(tables["slots"], F.get(tables["offsets"], one) + F.get(x, i + 1))
                return F.shiftleft(held.bitwiseXOR(F.shiftleft(one.cast("long"), RANK_BITS)), PLACE_BITS) + i

            return F.when(F.size(x) > 1, F.array_min(F.transform(F.sequence(F.lit(0), F.size(x) - 2), at)))

        def state(now: Column) -> Column:
            return _with(now, lambda x: F.struct(x.alias("parts"), least(x).alias("least")))

        def step(acc: Column, _: Column) -> Column:
            parts, best = acc["parts"], acc["least"]
            at = best.bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
            made = F.array(F.shiftright(best, PLACE_BITS).cast("int"))
            joined = F.concat(F.slice(parts, F.lit(1), at), made, F.slice(parts, at + 3, F.size(parts)))
            return F.when(best < joins, state(joined)).otherwise(acc)

        first = F.transform(F.filter(F.split(latin(word), ""), lambda x: x != ""), lambda x: F.get(tables["bytes"], F.ascii(x)))
        return F.aggregate(F.sequence(F.lit(2), F.octet_length(word)), state(first), step, lambda acc: acc["parts"])

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), 0)

    def frequent(self, texts: Column | str, docs: DataFrame) -> pa.Table:
        """The words that most documents hold, ``FREQUENT`` at most, and their ids: all words held by ``least`` documents or more."""
        spoken = docs.select(F.explode(F.array_distinct(self.words(F.col(texts)))).alias("word"))
        counts = stage(spoken.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1"), "bpe-words")
        least, total = None, 0
        for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.col("n").desc()).toLocalIterator():
            total += row["words"]
            if total > FREQUENT:
                break
            least = row["n"]
        if least is None:
            return KNOWN.empty_table()
        often = counts.filter((F.col("n") >= least) & (F.octet_length("word") > 1)).select("word")
        ids = _with(self._merges, lambda merges: self._fold(merges, F.col("word")))
        return often.select("word", ids.alias("ids")).toArrow().cast(KNOWN)

    def encode(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per row of ``docs``: its id and ``ids``."""
        spark = docs.sparkSession
        ship(spark)
        small_batches(spark)
        base = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
        # pieces last: of a word with two entries the last one counts
        whole = pa.Table.from_arrays([pa.array(self._whole, pa.string()), pa.array([[x] for x in self._whole.values()], pa.list_(pa.int32()))], schema=KNOWN)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, KNOWN) as stream:
            for table in (self.frequent("_text", base), whole):
                stream.write_table(table)
        sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
        kind = base.schema["_id"].dataType.simpleString()
        cut = base.mapInArrow(_cutter(self.python, new_name("bpe", ""), sent), f"_id {kind}, _parts {PARTS}")
        ids = lambda merges: F.flatten(F.transform("_parts", lambda p: F.when(p["word"].isNull(), p["ids"]).otherwise(F.concat(p["ids"], self._fold(merges, p["word"])))))
        return cut.select(F.col("_id").alias(id), _with(self._merges, ids).alias("ids"))

    def as_bytes(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers."""
        return _with(self.codes, lambda codes: F.array_join(F.transform(ids, lambda i: F.get(codes, i)), "")).cast("binary")

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for."""
        return _with(self.pieces, lambda pieces: F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")).cast("binary")
