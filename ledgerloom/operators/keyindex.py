"""Stored keys in buckets with a Bloom filter each, so that a small batch opens few of them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MOST_BUCKETS = 1024
BUCKET_ROWS = 50_000
PROBES = 5
KEYS_PER_WORD = 5  # a filter has a 64-bit word for every so many keys, some 13 bits a key
FULL = 1000  # keys of a batch for each bucket from which nearly every bucket is opened, so that no filter is asked
_FILTERS = "folder string, bucket int, words int, bits array<long>"


def bucket_count(rows: int) -> int:
    return max(1, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))


def _bucket(keys: list[str], buckets: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), buckets).cast("int")


def _cells(keys: list[str], words: Column) -> list[Column]:
    """The bits of a key in a filter of so many words."""
    return [F.pmod(F.xxhash64(*keys, F.lit(k)), words * 64) for k in range(1, PROBES + 1)]


def _bits(keys: list[str], words: Column) -> list[tuple[Column, Column]]:
    """(word, bit) of every probe of a key in a filter of so many words."""
    return [((c / 64).cast("int"), c.bitwiseAND(63).cast("int")) for c in _cells(keys, words)]


def _filters(words: int):
    """(bucket, bits): the filter of what a task holds of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cells = np.stack([c.to_numpy() for c in batch.columns[1:]], 1)
            for b in np.unique(bucket):
                mine = cells[bucket == b].ravel()
                bits = held.setdefault(int(b), np.zeros(words, np.uint64))
                np.bitwise_or.at(bits, mine >> 6, np.uint64(1) << (mine & 63).astype(np.uint64))
        for b, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([bits.view(np.int64)], pa.list_(pa.int64()))], names=["bucket", "bits"])

    return run


def part_of_index(folder: str, of: list[str], rows: int) -> dict:
    """The entry of a part of an index: the keys of the table's data folders ``of``. Its files may be written later."""
    return {"folder": folder, "of": of, "buckets": bucket_count(rows), "rows": rows}


def write_index(spark: SparkSession, keys: list[str], schema: T.StructType, path: str, entry: dict) -> str:
    """Write a part's rows (unique ``keys`` and what goes with them) and the filters of their buckets; returns the folder.

    Every writer has a folder of its own, so two that write the same part at once do not meet; it counts once its filters, which
    come last, are whole.
    """
    buckets, target = entry["buckets"], f"{path}/index/{entry['folder']}/{uuid.uuid4().hex}"
    placed = read_keys(spark, schema, path, [entry]).withColumn("bucket", _bucket(keys, F.lit(buckets)))
    placed.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{target}/rows")
    # a hash fills buckets evenly, so one filter size does for all; a fuller bucket only says "maybe" more often
    words = -(-entry["rows"] // (buckets * KEYS_PER_WORD)) + 1
    # the filters are made of what was written, where a bucket is a file, so a bucket has one part, or a few
    fields = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    written = spark.read.schema(fields).parquet(f"{target}/rows")
    cells = [c.alias(f"_cell{k}") for k, c in enumerate(_cells(keys, F.lit(words).cast("long")))]
    parts = written.select("bucket", *cells).mapInArrow(_filters(words), "bucket int, bits array<long>")
    either = F.aggregate("all", F.get("all", F.lit(0)), lambda x, y: F.zip_with(x, y, lambda a, b: a.bitwiseOR(b)))
    dense = parts.groupBy("bucket").agg(F.collect_list("bits").alias("all")).withColumn("bits", F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(either))
    filters = dense.select(F.lit(entry["folder"]).alias("folder"), "bucket", F.lit(words).alias("words"), "bits")
    filters.coalesce(1).write.parquet(f"{target}/filters")
    return target


def _written(spark: SparkSession, root: str, entry: dict) -> str | None:
    """The folder of a part that is written whole; None before."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{entry['folder']}")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in files.listStatus(top)) if files.exists(top) else []
    done = (n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(top, f"{n}/filters/_SUCCESS")))
    return next((f"{root}/{entry['folder']}/{n}" for n in done), None)


def read_keys(spark: SparkSession, schema: T.StructType, path: str, entries: list[dict]) -> DataFrame:
    """All keys (and what goes with them) of the parts, from the table's own columns."""
    return spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for e in entries for f in e["of"]])


def opened(batch: DataFrame, keys: list[str], root: str, entries: list[dict]) -> list[str]:
    """The bucket folders that may hold one of ``batch``'s keys, by the filters alone."""
    spark = batch.sparkSession
    at = {e["folder"]: _written(spark, root, e) for e in entries}
    filters = spark.read.schema(_FILTERS).parquet(*[f"{folder}/filters" for folder in at.values()])
    listed = F.array(*[F.struct(F.lit(e["folder"]).alias("folder"), F.lit(e["buckets"]).alias("buckets")) for e in entries])
    placed = batch.select(*keys, F.explode(listed).alias("e")).select(*keys, "e.folder", _bucket(keys, F.col("e.buckets")).alias("bucket"))
    maybe = reduce(lambda x, y: x & y, [_bit(F.get("bits", w), b) for w, b in _bits(keys, F.col("words"))])
    found = placed.join(filters, ["folder", "bucket"]).filter(maybe).select("folder", "bucket").distinct().collect()
    return [f"{at[r['folder']]}/rows/bucket={r['bucket']}" for r in sorted(found)]


def _bit(word: Column, bit: Column) -> Column:
    return F.call_function("shiftrightunsigned", word, bit).bitwiseAND(1) == 1


def candidates(batch: DataFrame, keys: list[str], schema: T.StructType, path: str, entries: list[dict]) -> DataFrame | None:
    """Stored rows that may have ``batch``'s keys, None for none (or for an empty batch).

    A batch that fills nearly every bucket reads the table's key columns, and needs no index. A smaller one reads the buckets whose
    filter may hold one of its keys; parts of the index that no batch has asked for yet are written now.
    """
    spark = batch.sparkSession
    many = batch.count() if entries else 0
    if not many:
        return None
    if many >= FULL * sum(e["buckets"] for e in entries):
        return read_keys(spark, schema, path, entries)
    for entry in entries:
        if _written(spark, f"{path}/index", entry) is None:
            write_index(spark, keys, schema, path, entry)
    folders = opened(batch, keys, f"{path}/index", entries)
    return spark.read.schema(schema).parquet(*folders) if folders else None


def lookup(batch: DataFrame, keys: list[str], schema: T.StructType, path: str, entries: list[dict]) -> DataFrame:
    """Stored rows of ``batch``'s keys; a small batch reads only buckets whose filter may hold one."""
    found = candidates(batch, keys, schema, path, entries)
    if found is None:
        return batch.sparkSession.createDataFrame([], schema)
    return found.join(batch.select(*keys), keys, "left_semi")
