"""A stored full-text index: segments of posting blocks in Parquet, opened by the terms that are asked for."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.functions.stem import with_stem
from ledgerloom.functions.text import STOPWORDS, word_tokens
from ledgerloom.operators.commits import CommitLog
from ledgerloom.operators.search import inverted_index

SPAN = 1 << 16  # ids of a block
DOCS_PER_BUCKET = 20_000
MOST_BUCKETS = 1024
_ROWS = "term string, block long, offsets array<int>, tfs array<long>"


class TextIndex:
    """Postings of documents by term, for documents with whole-number ids.

    A batch of documents becomes a segment: a folder of buckets (a hash of the term), each sorted by term and block. A block
    holds the postings of a term in a range of ``SPAN`` ids, as offsets from the range's start, so the commonest term fills
    many short rows. Segments are listed by a commit log: readers see whole segments, a repeated batch adds nothing, and
    ``merge`` puts one segment in the place of all.

    With ``stem``, terms are stems; they are made once per (term, block), not for every word of every text.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "doc_id", stopwords: list[str] | None = STOPWORDS, stem: bool = False):
        self.spark, self.path, self.key, self.stopwords, self.stem = spark, path, key, stopwords, stem
        self._log = CommitLog(spark, f"{path}/_commits")

    def _segments(self) -> list[dict]:
        return self._log.read()[1].get("segments", [])

    def _write(self, blocks: DataFrame, docs: int, batches: list[str]) -> dict:
        folder, buckets = uuid.uuid4().hex, max(1, min(MOST_BUCKETS, -(-docs // DOCS_PER_BUCKET)))
        placed = blocks.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
        ranged = placed.repartitionByRange("bucket", "term", "block").sortWithinPartitions("bucket", "term", "block")
        ranged.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        return {"folder": folder, "buckets": buckets, "docs": docs, "batches": batches}

    @staticmethod
    def _packed(items: DataFrame) -> DataFrame:
        """(term, block, items) as rows of the index."""
        rows = items.withColumn("items", F.array_sort("items"))
        offsets = F.transform("items", lambda x: x["offset"])
        return rows.select("term", "block", offsets.alias("offsets"), F.transform("items", lambda x: x["tf"]).alias("tfs"))

    def add(self, docs: DataFrame, text: Column, batch_id: str) -> bool:
        """Index documents that the index does not hold; false if the batch is there already."""
        if any(batch_id in s["batches"] for s in self._segments()):
            return False
        postings = inverted_index(docs, text, self.key, self.stopwords)
        id = F.col(self.key).cast("long")
        item = F.struct(F.pmod(id, F.lit(SPAN)).cast("int").alias("offset"), F.col("tf").cast("long").alias("tf"))
        rows = postings.select("term", F.floor(id / SPAN).alias("block"), item.alias("item"))
        rows = rows.groupBy("term", "block").agg(F.collect_list("item").alias("items"))
        if self.stem:
            rows = with_stem(rows, "term", "term").groupBy("term", "block").agg(F.flatten(F.collect_list("items")).alias("items"))
        entry = self._write(self._packed(rows), docs.count(), [batch_id])
        while True:
            version, state = self._log.read()
            segments = state.get("segments", [])
            if any(batch_id in s["batches"] for s in segments):
                return False
            if self._log.commit(version + 1, {"segments": [*segments, entry]}):
                return True

    def merge(self) -> None:
        """One segment instead of all; documents added meanwhile stay in segments of their own."""
        old = self._segments()
        if len(old) < 2:
            return
        rows = self.spark.read.option("recursiveFileLookup", True).schema(_ROWS).parquet(*[f"{self.path}/{s['folder']}" for s in old])
        items = rows.select("term", "block", F.arrays_zip(F.col("offsets").alias("offset"), F.col("tfs").alias("tf")).alias("items"))
        merged = items.groupBy("term", "block").agg(F.flatten(F.collect_list("items")).alias("items"))
        entry = self._write(self._packed(merged), sum(s["docs"] for s in old), [b for s in old for b in s["batches"]])
        gone = {s["folder"] for s in old}
        while True:
            version, state = self._log.read()
            segments = state.get("segments", [])
            if not gone <= {s["folder"] for s in segments}:
                return  # another merge was first
            if self._log.commit(version + 1, {"segments": [entry, *[s for s in segments if s["folder"] not in gone]]}):
                return

    def terms(self, words: list[str]) -> list[str]:
        """The words of a query as the index holds them; stop words and marks ask for nothing."""
        asked = self.spark.range(1).select(F.explode(word_tokens(F.lit(" ".join(words)), self.stopwords)).alias("term"))
        rows = with_stem(asked, "term", "term") if self.stem else asked
        return sorted({r["term"] for r in rows.collect()})

    def opened(self, wanted: list[str]) -> list[str]:
        """The bucket folders that may hold the terms."""
        hashes = [r["h"] for r in self.spark.createDataFrame([(w,) for w in wanted], "w string").select(F.xxhash64("w").alias("h")).collect()] if wanted else []
        return sorted({f"{self.path}/{s['folder']}/bucket={h % s['buckets']}" for s in self._segments() for h in hashes})

    def postings(self, wanted: list[str]) -> DataFrame:
        """Rows of the index for some terms. Only their buckets are listed, and inside them only row groups whose range holds a term."""
        schema = self.spark.createDataFrame([], _ROWS).schema
        system = self.spark._jsc.hadoopConfiguration()
        paths = [self.spark._jvm.org.apache.hadoop.fs.Path(f) for f in self.opened(wanted)]
        there = [str(p) for p in paths if p.getFileSystem(system).exists(p)]  # a bucket without a term has no folder
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*there).filter(F.col("term").isin(wanted))

    def search(self, words: list[str]) -> DataFrame:
        """Documents holding every term, with how often they hold them.

        Blocks where a term is missing are left out by their names alone, before any offset is read from the others.
        """
        wanted = self.terms(words)
        rows = self.postings(wanted)
        # terms of several segments share no document, so a block's terms may come from any of them
        full = rows.groupBy("block").agg(F.count_distinct("term").alias("n")).filter(F.col("n") == len(wanted)).select("block")
        pairs = rows.join(full, "block", "left_semi").select("term", "block", F.explode(F.arrays_zip("offsets", "tfs")).alias("x"))
        id = F.col("block") * SPAN + F.col("x.offsets")
        found = pairs.groupBy(id.alias(self.key)).agg(F.count_distinct("term").alias("n"), F.sum("x.tfs").alias("hits"))
        return found.filter(F.col("n") == len(wanted)).select(self.key, "hits")
