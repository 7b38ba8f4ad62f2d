"""Repeated passages by a suffix index that is built column by column over many strings at once.

A byte goes when a string of ``window`` bytes that covers it also starts earlier: in a document with a smaller id,
or in the same document further left. Judged on the input; overlaps count.

1. **Cut.** Every window has an anchor: of its ``k``-byte strings the one with the least hash, the leftmost of equals.
   Neighbouring windows with one anchor make one string, at most ``2 * window - k`` bytes. Equal windows have equal anchors,
   at the same place, so all copies of a window lie in strings with the same anchor, aligned at it. Strings are dealt out by
   the hash of the anchor; an anchor that occurs once in the corpus cannot carry a repeat and ends here. Equal strings of an
   anchor collapse into the first of them, by hashes of anchor and string together (128 bits).
2. **Index.** The strings left are laid out in columns, aligned at their anchors. From the last column to the first, one symbol
   of every string is inserted: the suffixes sorted so far, with the common prefixes of neighbours, give the order with that
   symbol in front (the symbols in suffix order are the Burrows-Wheeler transform), and the common prefix of two neighbours is one
   more than the least one between their former places. Because the strings are aligned, only suffixes of one column have to be
   ranked against each other, so a round reads the segment the last round wrote and writes its own, in files read and
   written from front to end. Neighbours that share ``window`` bytes are copies; all but the earliest go.
3. **Remove.** Ranges are gathered per document and cut out. Documents without any are never shuffled: a bit table of fixed
   size over the ids, joined as a small table, holds back most of them, and the join behind it is exact.

Defined results: a null text is empty; a text shorter than the window loses nothing; a null id comes before all others; rows
with equal ids count as ordered by a hash of their text, and rows equal in both are one document that is listed twice and
loses the same bytes in each row; an empty table gives an empty table; other columns are carried, whatever their names.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import ship
from ledgerloom.llm.sieve import sieve
from ledgerloom.session import small_batches, stage

PART = 500_000  # bytes of text cut together in a task, which takes some 100 times as many of memory
RECORDS = 400_000  # strings gathered before they are dealt out
PLACE = np.uint64((1 << 22) - 1)
BASE = 0x9E3779B97F4A7C15 | 1

_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the rolling hash's base and of its inverse, modulo 2^64."""
    if not _POWERS:
        inverse = pow(BASE, -1, 1 << 64)
        for base in (BASE, inverse):
            row = np.full(PART + 4096, base, np.uint64)
            row[0] = 1
            _POWERS.append(np.cumprod(row))
    return _POWERS


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cut(data: np.ndarray, ends: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Strings of texts laid end to end: (anchor hash, string hash, start, length, place of the anchor in it).

    ``ends`` has the end of the own text for every byte.
    """
    size = len(data)
    if size < window:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    power, inverse = _powers()
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:size], out=sums[1:])
    hashes = _mixed((sums[k:] - sums[:-k]) * inverse[: size - k + 1])
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span, wide = window - k + 1, 1
    while wide * 2 <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if span > wide:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    starts = np.flatnonzero(ends[: len(least)] - np.arange(len(least)) >= window)
    anchors = (least[starts] & PLACE).astype(np.int64)
    if not len(starts):
        return cut(data[:0], ends, window, k)
    first = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    begin, end, anchor = starts[first], starts[last] + window, anchors[first]
    content = (sums[end] - sums[begin]) * inverse[begin]
    content = _mixed(content ^ _mixed(((end - begin) * 1024 + (anchor - begin)).astype(np.uint64)))
    return hashes[anchor], content, begin, end - begin, anchor - begin


FIELDS = (("anchor", np.uint64), ("content", np.uint64), ("id", np.int64), ("tag", np.int64), ("start", np.int64), ("length", np.int16), ("place", np.int16))


def _packed(columns: dict[str, np.ndarray]) -> bytes:
    """Columns of a set of strings as one value; hashes as they are, the rest compressed."""
    rest = b"".join(np.ascontiguousarray(columns[n].astype(t)).tobytes() for n, t in FIELDS[2:])
    return columns["anchor"].tobytes() + columns["content"].tobytes() + zstandard.compress(rest, 1)


def _unpacked(blob: bytes, count: int) -> dict[str, np.ndarray]:
    out = {n: np.frombuffer(blob, t, count, at) for (n, t), at in zip(FIELDS[:2], (0, 8 * count), strict=True)}
    rest, at = zstandard.decompress(blob[16 * count :]), 0
    for n, t in FIELDS[2:]:
        out[n] = np.frombuffer(rest, t, count, at)
        at += count * np.dtype(t).itemsize
    return out


def _text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column laid end to end, and the bounds of its values."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


def _cutter(window: int, k: int, buckets: int):
    def strings_of(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        data, bounds = _text_buffer(batch.column("text"))
        ids = np.asarray(batch.column("id"))
        tags = np.asarray(batch.column("tag"))
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PART, "right")) - 1)
            low, high = int(bounds[at]), int(bounds[end])
            for seg in range(low, max(high, low + 1), PART):  # more than one part only for a single long text
                stop = min(high, seg + PART + window - 1)
                inner = np.clip(bounds[at : end + 1], seg, stop) - seg
                lengths = np.diff(inner)
                row = np.repeat(np.arange(at, end), lengths)
                own_end = np.repeat(inner[1:], lengths)
                anchor, content, start, length, place = cut(data[seg:stop], own_end, window, k)
                if len(start):
                    rows = row[start]
                    yield {"anchor": anchor, "content": content, "id": ids[rows], "tag": tags[rows],
                           "start": start + seg - bounds[rows], "length": length, "place": place}
            at = end

    def dealt(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        whole = {n: np.concatenate([p[n] for p in parts]) for n, _ in FIELDS}
        bucket = (whole["anchor"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        whole = {n: v[order] for n, v in whole.items()}
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(edges))
        blobs = [_packed({n: v[edges[b] : edges[b + 1]] for n, v in whole.items()}) for b in full]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(np.diff(edges)[full], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "n", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in strings_of(batch):
                held.append(part)
                size += len(part["start"])
                if size >= RECORDS:
                    yield dealt(held)
                    held, size = [], 0
        if held:
            yield dealt(held)

    return run


FOUND = pa.schema([("first", pa.bool_()), ("bucket", pa.int32()), ("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("place", pa.int32()), ("anchor", pa.int64())])


def _collapsed(whole: dict[str, np.ndarray], bucket: int) -> pa.RecordBatch:
    """Of the strings whose anchor repeats: the first of equal strings (``first``), and the others, which go."""
    order = np.lexsort((whole["start"], whole["tag"], whole["id"], whole["content"], whole["anchor"]))
    a, c, i, t, s = (whole[n][order] for n in ("anchor", "content", "id", "tag", "start"))
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new_string = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    again = ~new_string & np.concatenate([[False], (i[1:] == i[:-1]) & (t[1:] == t[:-1]) & (s[1:] == s[:-1])])
    group = np.cumsum(new_anchor) - 1
    keep = ~again & (np.bincount(group, ~again) > 1)[group]
    order, first = order[keep], new_string[keep]
    n = len(order)
    columns = [pa.array(first), pa.array(np.full(n, bucket, np.int32))]
    columns += [pa.array(whole[x][order].astype(y)) for x, y in (("id", np.int64), ("tag", np.int64), ("start", np.int64), ("length", np.int32), ("place", np.int32))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(whole["anchor"][order].view(np.int64))], schema=FOUND)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of sorted batches, a bucket at a time."""
    current, held = None, []
    for batch in batches:
        column = np.asarray(batch.column("bucket"))
        edges = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), len(column)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if high > low:
                if held and column[low] != current:
                    yield current, held
                    held = []
                current = int(column[low])
                held.append(batch.slice(low, high - low))
    if held:
        yield current, held


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, parts in _by_bucket(batches):
        sets = [_unpacked(blob, n) for p in parts for n, blob in zip(p.column("n").to_pylist(), p.column("blob").to_pylist(), strict=True)]
        yield _collapsed({n: np.concatenate([x[n] for x in sets]) for n, _ in FIELDS}, bucket)


class ColumnIndex:
    """Suffix order and common prefixes of aligned strings, one column after the other.

    ``columns`` go to a file, last column first; every round reads its column and the segment of the round before, and
    writes a segment, all from front to end.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, place: np.ndarray, before: int, width: int):
        self.n, self.width = len(place), width
        self.left = before - place  # the column of each string's first symbol
        self.right = self.left + np.diff(bounds)
        self._columns = tempfile.TemporaryFile()
        for low in range(width, 0, -16):
            cols = np.arange(low - 1, max(low - 17, -1), -1)[:, None]
            there = (cols >= self.left) & (cols < self.right)
            at = np.where(there, bounds[:-1] + cols - self.left, 0)
            np.where(there, data[at].astype(np.int16), np.int16(256)).tofile(self._columns)
        self._columns.seek(0)

    def rounds(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(column, strings in the order of their suffixes from it, common prefix with the one before, at most 255)."""
        n = self.n
        with tempfile.TemporaryFile() as old, tempfile.TemporaryFile() as new:
            np.arange(n, dtype=np.int32).tofile(old)
            np.zeros(n, np.uint8).tofile(old)
            for column in range(self.width - 1, -1, -1):
                symbols = np.fromfile(self._columns, np.int16, n)
                old.seek(0)
                order, common = np.fromfile(old, np.int32, n), np.fromfile(old, np.uint8, n)
                bwt = symbols[order]
                moved = np.argsort(bwt, kind="stable")
                sorted_symbols = bwt[moved]
                prefix = np.zeros(n, np.uint8)
                same = np.flatnonzero((sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] != 256)) + 1
                between = _least(common, moved[same - 1] + 1, moved[same])
                prefix[same] = np.minimum(between, 254) + 1
                order = order[moved]
                new.seek(0)
                order.tofile(new)
                prefix.tofile(new)
                old, new = new, old
                yield column, order, prefix

    def close(self) -> None:
        self._columns.close()


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value of every range low..high, both included."""
    if not len(low):
        return np.zeros(0, np.uint8)
    levels = [values]
    longest = int((high - low).max()) + 1
    while (2 << (len(levels) - 1)) <= longest:
        step = 1 << (len(levels) - 1)
        row = levels[-1].copy()
        np.minimum(row[:-step], levels[-1][step:], out=row[:-step])
        levels.append(row)
    table = np.stack(levels)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    return np.minimum(table[level, low], table[level, high - (1 << level) + 1])


def repeated_starts(data: np.ndarray, bounds: np.ndarray, place: np.ndarray, rank: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, place in it) of the windows that an earlier string (smaller ``rank``) also holds."""
    before = window - k
    index = ColumnIndex(data, bounds, place, before, 2 * window - k)
    strings, places = [], []
    for column, order, prefix in index.rounds():
        if column > before:
            continue
        edges = np.flatnonzero(prefix < window)
        if len(edges) == len(order):
            continue
        ranks = rank[order]
        least = np.repeat(np.minimum.reduceat(ranks, edges), np.diff(np.concatenate([edges, [len(order)]])))
        gone = order[least < ranks]
        strings.append(gone)
        places.append(column - index.left[gone])
    index.close()
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *strings]), np.concatenate([none, *places])


RANGES = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("length", pa.int32())])


def _indexer(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _by_bucket(batches):
            table = pa.Table.from_batches(parts).combine_chunks()
            data, bounds = _text_buffer(table.column("string").chunk(0))
            own = {n: table.column(n).to_numpy() for n in ("id", "tag", "start", "place")}
            rank = np.empty(len(table), np.int64)
            rank[np.lexsort((own["start"] + own["place"], own["tag"], own["id"]))] = np.arange(len(table))
            strings, places = repeated_starts(data, bounds, own["place"], rank, window, k)
            if not len(strings):
                continue
            order = np.lexsort((places, strings))
            strings, places = strings[order], places[order]
            first = np.flatnonzero(np.concatenate([[True], (strings[1:] != strings[:-1]) | (places[1:] != places[:-1] + 1)]))
            last = np.concatenate([first[1:], [len(strings)]]) - 1
            s = strings[first]
            length = places[last] - places[first] + window
            yield pa.RecordBatch.from_arrays([pa.array(own["id"][s]), pa.array(own["tag"][s]), pa.array(own["start"][s] + places[first]), pa.array(length.astype(np.int32))], schema=RANGES)

    return run


STRINGS = pa.schema([("bucket", pa.int32()), ("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("place", pa.int32()), ("string", pa.binary())])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted strings, from the texts they lie in."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in STRINGS.names}
        size = 0
        columns = [batch.column(n).to_pylist() for n in ("id", "tag", "bytes")]
        for id_, tag, text, wanted in zip(*columns, batch.column("wanted"), strict=True):
            w = wanted.values
            starts, lengths = w.field("start").to_numpy(), w.field("length").to_numpy()
            out["bucket"] += w.field("bucket").to_pylist()
            out["place"] += w.field("place").to_pylist()
            out["start"] += starts.tolist()
            out["id"] += [id_] * len(w)
            out["tag"] += [tag] * len(w)
            out["string"] += [text[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
            size += len(w)
            if size > 50_000:
                yield pa.RecordBatch.from_pydict(out, STRINGS)
                out, size = {n: [] for n in STRINGS.names}, 0
        if size:
            yield pa.RecordBatch.from_pydict(out, STRINGS)


def _without(text: pd.Series, ranges: pd.Series) -> pd.DataFrame:
    kept, spans, texts = [], [], []
    for value, cuts in zip(text, ranges, strict=True):
        out, at, count = [], 0, 0
        for start, end in sorted((x["start"], x["start"] + x["length"]) for x in cuts):
            if count == 0 or start > at:
                out.append(value[at:start])
                count += 1
            at = max(at, end)
        kept.append(b"".join([*out, value[at:]]))
        spans.append(count)
        texts.append(kept[-1].decode(errors="ignore"))
    return pd.DataFrame({"kept": kept, "spans": spans, "text": texts})


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 100, k: int = 32) -> DataFrame:
    """Ranges of bytes to remove: id, tag (hash of the text), start, length; they may overlap."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _keyed(docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")), "_id", "_text")
    base = texts.select(F.col("_key").alias("id"), F.col("_tag").alias("tag"), F.col("_whole").alias("text"))
    dealt = base.mapInArrow(_cutter(window, k, buckets), "bucket int, n int, blob binary")
    dealt = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = stage(dealt.mapInArrow(_collapse, "first boolean, bucket int, id long, tag long, start long, length int, place int, anchor long"), "repeats-found")
    firsts = found.filter("first")
    wanted = firsts.groupBy("id", "tag").agg(F.collect_list(F.struct("bucket", "start", "length", "place")).alias("wanted"))
    some = sieve(texts, "_key", firsts, "id").filter("_maybe").select("_key", "_tag", F.encode("_whole", "UTF-8").alias("bytes"))
    # a document listed twice gives its strings once; map tasks collapse its rows, and the join needs no other shuffle
    some = some.dropDuplicates(["_key", "_tag"]).join(wanted, (F.col("_key") == F.col("id")) & (F.col("_tag") == F.col("tag")))
    strings = some.select("id", "tag", "bytes", "wanted").mapInArrow(_fetch, "bucket int, id long, tag long, start long, place int, string binary")
    strings = strings.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    more = strings.mapInArrow(_indexer(window, k), "id long, tag long, start long, length int")
    return found.filter(~F.col("first")).select("id", "tag", "start", "length").unionByName(more)


def _keyed(rows: DataFrame, id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    key = F.coalesce(F.col(id).cast("long"), F.lit(-(1 << 63)))
    return rows.withColumns({"_key": key, "_tag": F.xxhash64(whole), "_whole": whole})


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 100, k: int = 32) -> DataFrame:
    """One row per row of ``docs``: ``row`` (its columns), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes) and ``text``.

    The text is what is kept without characters that a removed range cuts into; null stays null.
    """
    ranges = stage(find(docs, id, text, window, k), "repeats-ranges")
    rows = _keyed(docs.select(F.struct("*").alias("_row"), F.col(id).alias("_id"), F.col(text).alias("_text")), "_id", "_text")
    rows = sieve(rows, "_key", ranges, "id").select("_row", "_key", "_tag", "_text", F.encode("_whole", "UTF-8").alias("_bytes"), "_maybe")
    cuts = ranges.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "length")).alias("_cuts"))
    touched = rows.filter("_maybe").join(cuts, (F.col("_key") == F.col("id")) & (F.col("_tag") == F.col("tag")), "left")
    none = F.array().cast("array<struct<start:bigint,length:int>>")
    without = F.pandas_udf(_without, "struct<kept binary, spans long, text string>")
    touched = touched.withColumn("_left", without("_bytes", F.coalesce("_cuts", none)))
    fields = [F.col("_row").alias("row"), F.octet_length("_bytes").cast("long").alias("n_bytes")]
    one = touched.select(*fields, F.col("_left.spans").alias("n_spans"), F.col("_left.kept").alias("kept"), F.when(F.col("_text").isNotNull(), F.col("_left.text")).alias("text"))
    two = rows.filter(~F.col("_maybe")).select(*fields, F.lit(0).cast("long").alias("n_spans"), F.col("_bytes").alias("kept"), F.col("_text").alias("text"))
    both = one.unionByName(two)
    return both.select("row", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans", "kept", "text")


def clean(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 100, k: int = 32) -> DataFrame:
    """``docs`` with repeated passages cut out of the text; no row goes."""
    cut_out = remove(docs, id, text, window, k)
    return cut_out.select(*[(F.col("text") if x == text else F.col("row")[x]).alias(x) for x in docs.columns])
