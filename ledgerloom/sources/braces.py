"""Landed JSON of any layout as one text per object, whole files never in one task.

Objects may follow each other with or without line breaks, span lines and splits of a file, or be the elements of one array:
outside objects only brackets, commas and blanks are expected and left out. Splits are scanned side by side. A first pass sums
each split's braces (those outside strings; a string ends with its line at the latest); the few sums of a file's splits give
the depth each split starts at and the lowest depths before and after it; a second pass cuts.

An object ends where the depth comes back to the lowest depth so far, or to the lowest one that is still to come. In a sound file
both are zero. After a brace too many the first one has sunk, after a missing one the second one has risen, so that damage costs
the object it is in and not the rest of the file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.session import stage

_TOKEN = re.compile(r'"(?:[^"\\\n]|\\.)*(?:"|$)|[{}]', re.M)
_SUMS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("sum", pa.int64()), ("low", pa.int64())])
_PIECES = pa.schema([("file", pa.string()), ("landed", pa.int64()), ("block", pa.int64()), ("place", pa.int64()), ("open", pa.bool_()), ("close", pa.bool_()), ("text", pa.string())])


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str]]:
    """(file, landed, block, text) of each split of a task; a split is held as a whole."""
    current, lines = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "landed", "block", "value")]
        for file, landed, block, value in zip(*columns, strict=True):
            if (file, landed, block) != current:
                if current:
                    yield *current, "\n".join(lines)
                current, lines = (file, landed, block), []
            lines.append(value)
    if current:
        yield *current, "\n".join(lines)


def _braces(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places behind the braces outside strings, and +1 or -1 for each."""
    found = [(m.end(), 1 if m.group() == "{" else -1) for m in _TOKEN.finditer(text) if m.group()[0] != '"']
    out = np.array(found, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, _, block, text in _splits(batches):
        depth = np.cumsum(_braces(text)[1])
        row = {"file": [file], "block": [block], "sum": [int(depth[-1]) if len(depth) else 0], "low": [int(depth.min()) if len(depth) else 0]}
        yield pa.RecordBatch.from_pydict(row, _SUMS)


def _cutter(known):
    """Pieces of splits: whole objects, and the ends of those that cross a split's border (``open`` or ``close`` false)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, landed, block, text in _splits(batches):
            start, low, later = known.value[file, block]
            at, step = _braces(text)
            depth = start + np.cumsum(step)
            sunk = np.minimum(np.minimum.accumulate(depth), low)
            # the lowest depth behind each brace, in this split or a later one
            behind = np.minimum.accumulate(np.append(depth[1:], later)[::-1])[::-1] if len(depth) else depth
            ends = at[(step < 0) & ((depth <= sunk) | (depth <= behind))].tolist()
            edges = [0, *ends, len(text)]
            pieces = [text[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            n = len(pieces)
            # the first piece goes on from the split before, the last one goes on in the next
            for k in range(0, n, 10_000):
                part = range(k, min(n, k + 10_000))
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": [file] * len(part), "landed": [landed] * len(part), "block": [block] * len(part), "place": list(part),
                        "open": [p > 0 for p in part], "close": [p < n - 1 for p in part], "text": [pieces[p] for p in part],
                    },
                    _PIECES,
                )

    return run


def scan_objects(spark: SparkSession, path: str) -> DataFrame:
    """(seq, value): one row per object, in the order (time landed, file, split, place) of ``seq``.

    What stands between objects without being one (a number, a text, the rest of a broken object) is a row too. Null values,
    empty files and an empty folder give no rows. One row a split comes to the driver between the passes.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.unix_millis(F.col("_metadata.file_modification_time")).alias("landed"),
        F.col("_metadata.file_block_start").alias("block"), "value",
    )
    sums: dict[str, list] = {}
    for row in lines.mapInArrow(_sums, "file string, block long, sum long, low long").toLocalIterator():
        sums.setdefault(row["file"], []).append((row["block"], row["sum"], row["low"]))
    known = {}
    for file, splits in sums.items():
        splits.sort()
        start = lowest = 0
        for block, total, low in splits:
            known[file, block] = [start, lowest]
            lowest = min(lowest, start + low)
            start += total
        later = start
        for block, total, low in reversed(splits):
            known[file, block].append(later)
            later = min(later, known[file, block][0] + low)
    pieces = lines.mapInArrow(_cutter(spark.sparkContext.broadcast(known)), "file string, landed long, block long, place long, open boolean, close boolean, text string")
    pieces = stage(pieces, "pieces")  # read twice below
    whole = pieces.filter("open AND close").select("file", "landed", "block", "place", F.col("text").alias("value"))
    # two pieces a split at most: those of one object get the number of the last one that opened before them
    order = Window.partitionBy("file").orderBy("block", "place")
    ends = pieces.filter("NOT (open AND close)").withColumn("_object", F.sum(F.col("open").cast("long")).over(order))
    first = F.min(F.struct("block", "place"))
    joined = ends.groupBy("file", "landed", "_object").agg(first.alias("_at"), F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("_texts"))
    crossing = joined.select("file", "landed", "_at.block", "_at.place", F.array_join(F.transform("_texts", lambda t: t["text"]), "\n").alias("value"))
    rows = whole.unionByName(crossing).withColumn("value", F.regexp_replace("value", r"^[\s,\[\]]+|[\s,\[\]]+$", ""))
    return rows.filter("value != ''").select(F.struct("landed", "file", "block", "place").alias("seq"), "value")


def parse_objects(values: DataFrame, schema: T.StructType) -> DataFrame:
    """(seq, record, reason, value): one row per object of ``scan_objects``, or per part of one that cannot be parsed.

    What cannot be parsed is cut before lines that start with a brace, and before its first brace, and each part is tried again: an
    object that was never closed costs only itself. ``reason`` is null for a good record; a record with a value of the wrong type
    keeps its other fields and has a reason too; what stays unreadable has a reason and no record.
    """
    names = schema.fieldNames()
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])

    def parsed(rows: DataFrame) -> DataFrame:
        read = F.from_json("value", marked, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
        some = reduce(lambda x, y: x | y, [F.col("_read")[n].isNotNull() for n in names])
        rows = rows.withColumn("_read", read)
        broken = F.col("_read").isNull() | F.col("_read")["_corrupt"].isNotNull() | ~F.startswith("value", F.lit("{"))
        return rows.withColumn("_state", F.when(~broken, 0).when(some & F.startswith("value", F.lit("{")), 1).otherwise(2))

    # read twice below; filters on the state would each parse every object again, once for every field they ask for
    first = stage(parsed(values), "objects")
    cut = F.regexp_replace(F.regexp_replace("value", r"\n(?=\[*\{)", "\u001e"), r"^([^{\u001e]+)(?=\{)", "$1\u001e")
    again = first.filter("_state = 2").select("seq", F.posexplode(F.split(cut, "\u001e", -1)).alias("_part", "value"))
    again = again.withColumn("value", F.regexp_replace("value", r"^[\s,\[\]]+|[\s,\[\]]+$", "")).filter("value != ''")
    rest = stage(parsed(again), "object-parts")
    rows = first.filter("_state < 2").withColumn("_part", F.lit(0)).unionByName(rest)
    record = F.struct(*[F.col("_read")[n].alias(n) for n in names])
    reason = F.when(F.col("_state") == 1, "a value of the wrong type").when(F.col("_state") == 2, "not a record")
    seq = F.struct("seq.*", F.col("_part").alias("part"))
    return rows.select(seq.alias("seq"), F.when(F.col("_state") < 2, record).alias("record"), reason.alias("reason"), "value")
