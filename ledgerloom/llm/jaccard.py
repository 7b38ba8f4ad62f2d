"""Near duplicates by the Jaccard similarity of word shingles: a grouped prefix join, and the components of its links.

A document is the set of its distinct shingles (64-bit hashes). Sets are ordered by how common a shingle is, rarest first;
two sets that are similar enough share a shingle of their prefixes. How common a shingle is comes from a table of counters over
the whole corpus, of fixed size; any order all sets share gives the same links.

1. Documents with equal sets collapse into one node, and nodes with equal prefix and size into one group. Groups are listed under
   each shingle of their prefix; shingles with one group in all are dropped, and lists of the same groups become one.
2. Pairs of groups are filtered by size and place, then expanded to members and verified. In each of ``ROUNDS`` rounds a list pairs
   one of its groups with its others, and one member of each group stands for it: a large group of copies costs a few pairs a
   member and round. Components are joined after each round; a list whose documents are in one component is done.
3. What is left is compared block by block: pairs of groups again, filtered, expanded, and members of one component left out. A
   pair of blocks with few pairs of members that pass emits them to be verified; one with more than it has members is named and
   gets the whole bitmaps of its members (a sixteenth of their sets at most). One that has more even so gets the sets, verifies in
   place and returns a spanning forest. So no output grows with the square of a group.
4. A group of named lists meets all others of its largest one, its home, first, whatever their places; in the other lists only groups
   of unlike homes are compared, so many lists of the same groups do not send them again and again.

Filters (all exact): sizes, places of a shared shingle in both orders, and upper bounds on the intersection by parity bitmaps.
Pairs that pass are verified on the whole sets, recomputed from the texts.

Defined results: a text without words, empty or null has an empty set and links with nothing; with fewer words than a shingle the
whole sequence is one shingle; rows with equal ids are one document as far as links go, and each gets its own row; a null id is a
document whose number is null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import ship
from ledgerloom.llm.sieve import sieve
from ledgerloom.llm.vectors import attach
from ledgerloom.session import small_batches, stage

ROUNDS = 2
CELLS = 22  # 2^CELLS counters
BLOCK = 1 << 14  # counters merged together
LIST_BLOCK = 512  # members of a block
MASS = 1 << 18  # shingles of a piece of a block whose members are verified where they meet
LANES = 16
NONE = -(1 << 63)  # the number of documents without one


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()  # bytes: lower() maps A-Z alone, split() knows the six blanks alone
    n = len(words)
    known = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)  # faster than looking known words up
    factors = _mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    if n < width:
        whole = (known * factors[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
        return _mixed(whole) if n else known
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total += known[k : n - width + 1 + k] * factors[k]
    return np.unique(_mixed(total))


def _counter(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size = np.zeros(1 << CELLS, np.uint32), [], 0
        shift = np.uint64(64 - CELLS)

        def add() -> None:
            cells, n = np.unique(np.concatenate(held) >> shift, return_counts=True)
            counts[cells.astype(np.int64)] += n.astype(np.uint32)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(shingles(text, width))
                size += len(held[-1])
                if size > 1_000_000:
                    add()
                    held, size = [], 0
        if held:
            add()
        if counts.any():
            parts = [zstandard.compress(x.tobytes(), 1) for x in counts.reshape(-1, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(parts, pa.binary())], ["block", "counts"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the counters of each block; rows come sorted by block."""
    current, total = None, None
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            part = np.frombuffer(zstandard.decompress(counts), np.uint32).astype(np.uint64)
            if block != current and current is not None:
                yield _counted(current, total)
                total = None
            current, total = block, part if total is None or block != current else total + part
    if current is not None:
        yield _counted(current, total)


def _counted(block: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())], ["block", "counts"])


def levels(texts: DataFrame, width: int) -> bytes:
    """For each cell of hashes how common its shingles are: 0 up to twice the mean (and 8), then in powers of two.

    2^CELLS bytes, whatever the input.
    """
    parts = texts.select("text").mapInArrow(_counter(width), "block int, counts binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, "block int, counts binary")
    counts = np.zeros((1 << CELLS) // BLOCK * BLOCK, np.uint64).reshape(-1, BLOCK)
    for row in merged.toLocalIterator():
        counts[row["block"]] = np.frombuffer(zstandard.decompress(row["counts"]), np.uint64)
    common = 2 * counts.mean() + 8
    return np.where(counts < common, 0, 1 + np.log2(np.maximum(counts / common, 1))).astype(np.uint8).tobytes()


def prefix_length(n: int, percent: int) -> int:
    """Shingles of which a set of ``n`` shares one with any set that is similar enough."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _bitmap(hashes: np.ndarray, bits: int | None = None) -> bytes:
    """Whether an odd number of shingles falls on each bit; by default with two bits or more for a shingle."""
    bits = bits or (max(256, 1 << int(2 * len(hashes) - 1).bit_length()) if len(hashes) else 256)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


SMALL = 512  # bits of the bitmap that lists carry
SIGNED = "id long, n long, set_key binary, prefix_key binary, prefix array<long>, bitmap binary, small binary"


def _signer(width: int, percent: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(common.value, np.uint8)
        shift = np.uint64(64 - CELLS)
        for batch in batches:
            out: list[tuple] = []
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes = shingles(text, width)
                n = len(hashes)
                rank = level[(hashes >> shift).astype(np.int64)]
                prefix = hashes[np.argsort(rank, kind="stable")[: prefix_length(n, percent)]]
                head = prefix.tobytes()
                key = xxhash.xxh3_128_digest(head + n.to_bytes(8, "little"))
                out.append((id_, n, xxhash.xxh3_128_digest(hashes.tobytes()), key, prefix.view(np.int64), _bitmap(hashes), _bitmap(hashes, SMALL)))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary()),
                     pa.array(columns[4], pa.list_(pa.int64())), pa.array(columns[5], pa.binary()), pa.array(columns[6], pa.binary())],
                    ["id", "n", "set_key", "prefix_key", "prefix", "bitmap", "small"],
                )

    return run


def _overlap_bound(one: np.ndarray, two: np.ndarray, n1: int, n2: int) -> int:
    """At most so many shingles are shared, by the bits in which two bitmaps differ."""
    small, large = (one, two) if len(one) <= len(two) else (two, one)
    while len(large) > len(small):
        large = large[: len(large) // 2] ^ large[len(large) // 2 :]
    return (n1 + n2 - int(np.bitwise_count(small ^ large).sum())) // 2


def _enough(n1, n2, percent: int):
    """Shared shingles that two sets of these sizes need: ceil(percent / (100 + percent) * (n1 + n2))."""
    return -(-percent * (n1 + n2) // (100 + percent))


def _dealer(buckets: int):
    """Postings of sets (token, group, size, place) as packed columns, by bucket of their token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            sizes = np.diff(np.asarray(prefix.offsets))
            token = np.asarray(prefix.flatten()).view(np.uint64)
            row = np.repeat(np.arange(len(batch)), sizes)
            place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            columns = [token[order], np.asarray(batch.column("id"))[row][order], np.asarray(batch.column("n"))[row][order], place[order]]
            blobs = []
            for b in full:
                part = [x[edges[b] : edges[b + 1]] for x in columns]
                blobs.append(part[0].tobytes() + zstandard.compress(b"".join(x.astype(np.int64).tobytes() for x in part[1:]), 1))
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(np.diff(edges)[full], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "count", "blob"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of tokens that more than one document has: that is, of two groups or more."""
    current, held = None, []

    def done() -> pa.RecordBatch:
        token = np.concatenate([x[0] for x in held])
        order = np.argsort(token, kind="stable")
        token = token[order]
        new = np.concatenate([[True], token[1:] != token[:-1]])
        many = (np.bincount(np.cumsum(new) - 1) > 1)[np.cumsum(new) - 1]
        columns = [np.concatenate([x[k] for x in held])[order][many] for k in (1, 2, 3)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (token[many].view(np.int64), *columns)], ["token", "group", "n", "place"])

    for batch in batches:
        for bucket, count, blob in zip(*[batch.column(n).to_pylist() for n in ("bucket", "count", "blob")], strict=True):
            if held and bucket != current:
                yield done()
                held = []
            current = bucket
            rest = np.frombuffer(zstandard.decompress(blob[8 * count :]), np.int64).reshape(3, count)
            held.append((np.frombuffer(blob, np.uint64, count), *rest))
    if held:
        yield done()


def _plausible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = zip(batch.column("n1").to_pylist(), batch.column("n2").to_pylist(), strict=True)
            maps = zip(batch.column("map1").to_pylist(), batch.column("map2").to_pylist(), strict=True)
            keep = [_overlap_bound(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), n1, n2) >= _enough(n1, n2, percent) for (n1, n2), (x, y) in zip(n, maps, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verify(width: int, percent: int):
    """Pairs that are similar enough; rows come sorted by (a, lane), the text of a first, then those of its partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, firsts = None, []
        for batch in batches:
            a, b = [], []
            for one, lane, two, text in zip(*[batch.column(n).to_pylist() for n in ("a", "lane", "b", "text")], strict=True):
                if (one, lane) != current:
                    current, firsts = (one, lane), []
                hashes = shingles(text, width)
                if two is None:
                    firsts.append(hashes)
                    continue
                for first in firsts:  # more than one only if documents share an id
                    both = len(np.intersect1d(first, hashes, assume_unique=True))
                    if both and 100 * both >= percent * (len(first) + len(hashes) - both):
                        a.append(one)
                        b.append(two)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached over ``edges`` (a, b), for ids that reach a smaller one.

    Large and small stars in turn until every id points at one that points nowhere; each step is written, and no node's
    edges meet in one place but as a minimum.
    """
    now = stage(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        size = now.agg(F.count("*").alias("n"), F.count_distinct("u").alias("ids")).first()
        if size["n"] == size["ids"] and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = stage(small.filter("u != v").distinct(), "edges")


class _Join:
    def __init__(self, texts: DataFrame, width: int, percent: int):
        self.texts, self.width, self.percent = texts, width, percent
        spark = texts.sparkSession
        ship(spark)
        small_batches(spark)
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        common = spark.sparkContext.broadcast(levels(texts, width))
        signed = texts.mapInArrow(_signer(width, percent, common), SIGNED)
        self.signed = stage(signed, "jaccard-signed")

    def _sized(self, n1: str, n2: str):
        return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * self.percent)

    def _placed(self, n1: str, p1: str, n2: str, p2: str):
        need = F.ceil((F.col(n1) + F.col(n2)) * self.percent / (100 + self.percent) - 1e-9)
        return (F.col(n1) - F.col(p1) >= need) & (F.col(n2) - F.col(p2) >= need)

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that are similar enough, verified on the whole sets."""
        ends = stage(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "jaccard-ends")
        maps = sieve(self.signed.select("id", "n", "bitmap"), "id", ends, "id").filter("_maybe")
        one = maps.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("bitmap").alias("map1"))
        two = maps.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("bitmap").alias("map2"))
        hopeful = stage(pairs.join(one, "a").join(two, "b").mapInArrow(_plausible(self.percent), "a long, b long").distinct(), "jaccard-pairs")
        ids = hopeful.select(F.col("a").alias("id")).unionByName(hopeful.select(F.col("b").alias("id"))).distinct()
        some = sieve(self.texts, "id", ids, "id").filter("_maybe").select("id", "text").join(ids, "id", "left_semi")
        texts = stage(some, "jaccard-texts")
        lane = F.pmod(F.xxhash64("b"), F.lit(LANES)).cast("int")  # the partners of one document spread over lanes
        laned = hopeful.withColumn("lane", lane)
        heads = laned.select("a", "lane").distinct().join(texts, F.col("a") == F.col("id")).select("a", "lane", F.lit(None).cast("long").alias("b"), "text")
        others = laned.join(texts, F.col("b") == F.col("id")).select("a", "lane", "b", "text")
        rows = heads.unionByName(others).repartition(self.parts, "a", "lane").sortWithinPartitions("a", "lane", F.col("b").asc_nulls_first())
        return rows.mapInArrow(_verify(self.width, self.percent), "a long, b long").distinct()

    def run(self) -> DataFrame:
        """(id, component) for every document that is linked to one with a smaller id, or has such a twin."""
        small = self.signed.filter("n > 0").select("id", "n", "set_key", "prefix_key")
        nodes = small.groupBy("set_key").agg(F.min("id").alias("node"), F.first("prefix_key").alias("prefix_key"), F.count("*").alias("copies"))
        nodes = stage(nodes, "jaccard-nodes")
        several = nodes.filter("copies > 1").select("set_key", "node", "copies")
        twins = attach(small.select("id", "set_key"), several, ["set_key"], "copies").filter("id != node").select(F.col("id").alias("a"), F.col("node").alias("b"))
        self.labels = components(twins)  # an id with several texts may have several twins
        groups = stage(nodes.groupBy("prefix_key").agg(F.min("node").alias("group"), F.count("*").alias("members")), "jaccard-prefixes")
        self.groups = stage(attach(nodes.select("node", "prefix_key"), groups, ["prefix_key"], "members").select("node", "group", "members"), "jaccard-groups")
        self.lists = stage(self._merged(self._listed(small)), "jaccard-lists")
        tried = None
        for turn in range(ROUNDS):
            now = self._open()
            first = now.groupBy("token").agg(F.min(F.struct(F.xxhash64("low", F.lit(turn)).alias("h"), "group", "n", "place", "low", "high")).alias("first"))
            named = first.select("token", *[F.col(f"first.{x}").alias(f"{x}0") for x in ("group", "n", "place", "low", "high")])
            apart = (F.col("low") != F.col("low0")) | (F.col("low") != F.col("high")) | (F.col("low0") != F.col("high0"))
            pairs = now.join(named, "token").filter(apart).filter(self._sized("n", "n0")).filter(self._placed("n", "place", "n0", "place0"))
            pairs = pairs.select(F.col("group0").alias("g"), F.col("group").alias("h")).distinct()
            if tried is not None:
                pairs = pairs.join(tried, ["g", "h"], "left_anti")
            pairs = stage(pairs, "jaccard-group-pairs")
            if pairs.isEmpty():
                break
            tried = pairs if tried is None else tried.unionByName(pairs)
            self._link(self.links(stage(self._expanded(pairs, turn), "jaccard-expanded")))
        now = self._open()
        pairs, dense, blocks = self._blocks(now)
        # many lists may hold one dense group: the largest one of each of its members goes first and whole, and mostly leaves nothing to the others
        several = dense.select("token").distinct()
        largest = now.join(several, "token").groupBy("group").agg(F.max(F.struct("size", "token")).alias("list"))
        homes = stage(largest.select("group", F.col("list.token").alias("home")), "jaccard-homes")
        chosen = stage(homes.select(F.col("home").alias("token")).distinct(), "jaccard-chosen")
        held = blocks.select("token", "block").join(chosen, "token", "left_semi")
        whole = held.withColumnRenamed("block", "x").join(held.withColumnRenamed("block", "y"), "token").filter("x <= y")
        more, links = self._dense(whole, blocks)
        self._link(self.links(pairs.unionByName(more)).unionByName(links))
        rest = stage(several.join(chosen, "token", "left_anti"), "jaccard-others")
        if not rest.isEmpty():
            pairs, dense, blocks = self._blocks(self._open().join(rest, "token", "left_semi"), homes)
            more, links = self._dense(dense, blocks)
            self._link(self.links(pairs.unionByName(more)).unionByName(links))
        return self.labels

    def _listed(self, small: DataFrame) -> DataFrame:
        """Groups (token, group, n, place) under the shingles of their prefix that another group has too, and large groups under their own number."""
        # all but the heads of groups: few, so that most sets are never shuffled
        rest = stage(small.select("id").join(self.groups.filter("node = group").select(F.col("node").alias("id")), "id", "left_anti"), "jaccard-rest")
        listed = sieve(self.signed.filter("n > 0").select("id", "n", "prefix"), "id", rest, "id")
        heads = listed.filter(~F.col("_maybe")).unionByName(listed.filter("_maybe").join(rest, "id", "left_anti").select(listed.columns))
        dealt = heads.select("id", "n", "prefix").mapInArrow(_dealer(self.parts), "bucket int, count int, blob binary")
        dealt = dealt.repartition(self.parts, "bucket").sortWithinPartitions("bucket")
        lists = dealt.mapInArrow(_shared, "token long, group long, n long, place long")
        many = self.groups.filter("members > 1").select("group").distinct()
        sizes = sieve(self.signed.select("id", "n"), "id", many, "group").filter("_maybe").select(F.col("id").alias("group"), "n").distinct()
        inside = many.join(sizes, "group").select(F.xxhash64(F.lit("group"), "group").alias("token"), "group", "n", F.lit(0).cast("long").alias("place"))
        return stage(lists.unionByName(inside), "jaccard-shared")

    def _merged(self, lists: DataFrame) -> DataFrame:
        """Lists of the same groups as one; a group's place is its first one, so the filter by places lets no fewer pairs pass."""
        marks = [F.bit_xor(F.xxhash64("group", F.lit(k))).alias(f"mark{k}") for k in (0, 1)]
        same = lists.groupBy("token").agg(F.count("*").alias("size"), *marks)
        leaders = same.groupBy("size", "mark0", "mark1").agg(F.min("token").alias("leader"), F.count("*").alias("lists"))
        leaders = stage(same.join(leaders.filter("lists > 1"), ["size", "mark0", "mark1"]).select("token", "leader"), "jaccard-leaders")
        token = F.coalesce("leader", "token").alias("token")
        return lists.join(leaders, "token", "left").groupBy(token, "group", "n").agg(F.min("place").alias("place"))

    def _open(self) -> DataFrame:
        """Lists whose documents are in several components; each group with the least and the greatest component of its members."""
        labels = self.labels.select(F.col("id").alias("node"), F.col("component").alias("_c"))
        own = self.groups.join(labels, "node", "left").withColumn("_c", F.coalesce("_c", "node"))
        state = stage(own.groupBy("group").agg(F.min("_c").alias("low"), F.max("_c").alias("high"), F.count("*").alias("members")), "jaccard-state")
        now = stage(self.lists.join(state, "group"), "jaccard-active")
        open_ = now.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.sum("members").alias("size")).filter("least != most")
        return stage(now.join(open_.select("token", "size"), "token"), "jaccard-open")

    def _expanded(self, pairs: DataFrame, turn: int) -> DataFrame:
        """Pairs of groups (g, h) as pairs of members: one member of each with all of the other."""
        members = self.groups.select("group", "node")
        one = self.groups.groupBy("group").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("one"))
        out = []
        for g, h in (("g", "h"), ("h", "g")):
            named = pairs.join(one.withColumnRenamed("group", g), g).join(members.withColumnRenamed("group", h), h)
            out.append(named.filter("one != node").select(F.least("one", "node").alias("a"), F.greatest("one", "node").alias("b")))
        return out[0].unionByName(out[1]).distinct()

    def _link(self, links: DataFrame) -> None:
        """Join the components that ``links`` connect."""
        one = self.labels.select(F.col("id").alias("a"), F.col("component").alias("la"))
        two = self.labels.select(F.col("id").alias("b"), F.col("component").alias("lb"))
        between = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        joined = components(between)
        moved = joined.select(F.col("id").alias("component"), F.col("component").alias("least"))
        old = self.labels.join(moved, "component", "left").select("id", F.coalesce("least", "component").alias("component"))
        self.labels = stage(old.unionByName(joined), "jaccard-labels")

    def _blocks(self, now: DataFrame, homes: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """What is left, block against block: pairs of members that pass the filters; pairs of blocks (token, x, y) with more of them than members; the blocks.

        Groups that share one of ``homes`` (group, home) have met there and are not compared.
        """
        now = now.withColumn("home", F.lit(None).cast("long")) if homes is None else now.join(homes, "group", "left")
        labels = self.labels.select(F.col("id").alias("node"), F.col("component").alias("_c"))
        wanted = self.groups.join(now.select("group").distinct(), "group", "left_semi")
        maps = self.signed.select(F.col("id").alias("node"), "small")  # of an id with several texts all
        own = wanted.join(labels, "node", "left").join(maps, "node").withColumn("component", F.coalesce("_c", "node"))
        part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / LIST_BLOCK)).cast("int")
        parts = own.groupBy("group", part.alias("part")).agg(F.collect_list(F.struct("node", "component", "small")).alias("members"))
        entries = now.select("token", "group", "n", "place", "size", "home").join(stage(parts, "jaccard-parts"), "group")
        spot = F.pmod(F.xxhash64("group", "part"), F.ceil(F.col("size") / LIST_BLOCK)).cast("int")
        entry = F.struct("n", "place", "home", "members")
        blocks = stage(entries.groupBy("token", spot.alias("block")).agg(F.collect_list(entry).alias("entries")), "jaccard-blocks")
        one = blocks.select("token", F.col("block").alias("x"), F.col("entries").alias("left"))
        two = blocks.select("token", F.col("block").alias("y"), F.col("entries").alias("right"))
        both = one.join(two, "token").filter("x <= y")
        found = stage(both.mapInArrow(_block_pairs(self.percent), "a long, b long, token long, x int, y int"), "jaccard-found")
        return stage(found.filter("a is not null").select("a", "b").distinct(), "jaccard-left"), found.filter("a is null").select("token", "x", "y"), blocks

    def _dense(self, dense: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Inside pairs of blocks (token, x, y), whatever the places: pairs of members whose whole bitmaps allow them, to be verified, and links.

        Where there are more such pairs than members, they are verified on whole sets where the blocks meet; the links are a spanning forest.
        """
        dense = stage(dense, "jaccard-dense")
        nothing = self.texts.sparkSession.createDataFrame([], "a long, b long")
        if dense.isEmpty():
            return nothing, nothing
        ends = dense.select("token", F.col("x").alias("block")).unionByName(dense.select("token", F.col("y").alias("block"))).distinct()
        entries = blocks.join(ends, ["token", "block"]).select("token", "block", F.explode("entries").alias("e"))
        members = entries.select("token", "block", "e.n", "e.home", F.explode("e.members").alias("m"))
        members = stage(members.select("token", "block", "n", F.lit(0).cast("long").alias("place"), "home", "m.node", "m.component"), "jaccard-members")
        nodes = members.select("node").distinct()
        maps = sieve(self.signed.select("id", F.col("n").alias("own_n"), "bitmap"), "id", nodes, "node").filter("_maybe").select(F.col("id").alias("node"), "own_n", "bitmap")
        found = self._meet(dense, members, maps, ["own_n", "home", "bitmap"], 16 * MASS, _map_pairs(self.percent), "a long, b long, token long, x int, y int", "jaccard-hopeful")
        pairs = stage(found.filter("a is not null").select("a", "b").distinct(), "jaccard-close")
        left = stage(found.filter("a is null").select("token", "x", "y").distinct(), "jaccard-crowded")
        if left.isEmpty():
            return pairs, nothing
        ends = left.select("token", F.col("x").alias("block")).unionByName(left.select("token", F.col("y").alias("block"))).distinct()
        members = stage(members.join(ends, ["token", "block"], "left_semi"), "jaccard-crowd")
        nodes = members.select("node").distinct()
        some = sieve(self.texts, "id", nodes, "node").filter("_maybe").select("id", "text").join(nodes, F.col("id") == F.col("node"), "left_semi")
        sets = stage(some.mapInArrow(_sets(self.width), "node long, shingles binary"), "jaccard-sets")
        return pairs, self._meet(left, members, sets, ["n", "place", "shingles"], MASS, _dense_links(self.percent), "a long, b long", "jaccard-dense-links")

    def _meet(self, dense: DataFrame, members: DataFrame, contents: DataFrame, carried: list[str], mass: int, function, schema: str, name: str) -> DataFrame:
        """What ``function`` finds in pairs of blocks: their members with ``contents``, in pieces of ``mass`` shingles each."""
        masses = members.groupBy("token", "block").agg(F.sum("n").alias("mass")).withColumn("pieces", F.ceil(F.col("mass") / mass).cast("int"))
        own = F.col("x") == F.col("y")
        kinds = dense.select("token", F.explode(F.array("x", "y")).alias("block"), own.alias("own")).groupBy("token", "block").agg(F.max("own").alias("own"), F.max(~F.col("own")).alias("paired"))
        sizes = stage(masses.join(kinds, ["token", "block"]), "jaccard-masses")
        placed = members.join(sizes, ["token", "block"]).withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
        member = F.struct("node", "component", *carried)

        def tasks(total: int | None) -> int:
            """So many that one gets some pieces of full mass, or many small ones."""
            return max(self.parts, -(-(total or 0) // (2 * mass)))

        def pieces(rows: DataFrame, total: int | None) -> DataFrame:
            key = ("token", "block", "piece")
            return rows.join(contents, "node").repartition(tasks(total), *key).groupBy(*key).agg(F.collect_list(member).alias("members"))

        # a piece meets itself where it is gathered; only others are sent again
        alone = pieces(placed.filter("own"), sizes.filter("own").agg(F.sum("mass")).first()[0])
        nobody = F.lit(None).cast(alone.schema["members"].dataType)
        inside = alone.select("token", F.col("block").alias("x"), F.col("block").alias("y"), F.col("members").alias("left"), nobody.alias("right"))
        found = stage(inside.mapInArrow(function, schema), name)
        more = sizes.filter("paired OR (own AND pieces > 1)")
        if more.isEmpty():
            return found
        gathered = stage(pieces(placed.join(more.select("token", "block"), ["token", "block"], "left_semi"), more.agg(F.sum("mass")).first()[0]), "jaccard-pieces")
        one = gathered.select("token", F.col("block").alias("x"), F.col("piece").alias("p"), F.col("members").alias("left"))
        two = gathered.select("token", F.col("block").alias("y"), F.col("piece").alias("q"), F.col("members").alias("right"))
        both = dense.join(one, ["token", "x"]).join(two, ["token", "y"]).filter("x < y OR p < q").select("token", "x", "y", "left", "right")
        m1, m2 = (sizes.select("token", F.col("block").alias(b), F.col("mass").alias(f"m{b}"), F.col("pieces").alias(f"p{b}")) for b in ("x", "y"))
        sent = dense.join(m1, ["token", "x"]).join(m2, ["token", "y"]).agg(F.sum(F.col("mx") * F.col("py") + F.col("my") * F.col("px"))).first()[0]
        return found.unionByName(stage(both.repartition(tasks(sent)).mapInArrow(function, schema), name))


def _apart(one: pa.Array, two: pa.Array) -> np.ndarray:
    """Which pairs have no home in common; groups without one have met nowhere."""
    known1, known2 = (np.asarray(x.is_valid()) for x in (one, two))
    home1, home2 = (x.fill_null(0).to_numpy(zero_copy_only=False) for x in (one, two))
    return (home1[:, None] != home2[None, :]) | ~known1[:, None] | ~known2[None, :]


def _passing(n1, p1, c1, map1, n2, p2, c2, map2, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that sizes, places of the shared shingle, components and bitmaps allow."""
    need = _enough(n1[:, None], n2[None, :], percent)
    good = (c1[:, None] != c2[None, :]) & (np.minimum(n1[:, None], n2) * 100 >= np.maximum(n1[:, None], n2) * percent)
    good &= (n1 - p1)[:, None] >= need
    good &= (n2 - p2)[None, :] >= need
    i, j = np.nonzero(good)
    apart = np.bitwise_count(map1[i] ^ map2[j]).sum(1)
    keep = (n1[i] + n2[j] - apart) // 2 >= need[i, j]
    return i[keep], j[keep]


def _block_pairs(percent: int):
    """Groups of one block against those of another: filtered as groups by size and place, then expanded to members and filtered by bitmaps."""

    def side(entries) -> tuple:
        n, place = entries.field("n").to_numpy(), entries.field("place").to_numpy()
        members = entries.field("members")
        sizes = np.diff(np.asarray(members.offsets))
        v = members.flatten()
        words = np.frombuffer(b"".join(v.field("small").to_pylist()), np.uint64).reshape(len(v), SMALL // 64)
        starts = np.cumsum(sizes) - sizes
        return n, place, entries.field("home"), sizes, starts, v.field("node").to_numpy(), v.field("component").to_numpy(), words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                token, x, y = (batch.column(c)[k].as_py() for c in ("token", "x", "y"))
                n1, p1, home1, s1, at1, node1, c1, map1 = side(batch.column("left")[k].values)
                n2, p2, home2, s2, at2, node2, c2, map2 = side(batch.column("right")[k].values)
                need = _enough(n1[:, None], n2[None, :], percent)
                good = np.minimum(n1[:, None], n2) * 100 >= np.maximum(n1[:, None], n2) * percent
                good &= ((n1 - p1)[:, None] >= need) & ((n2 - p2)[None, :] >= need) & _apart(home1, home2)
                if x == y:
                    good = np.triu(good)
                found: list[tuple[np.ndarray, np.ndarray]] = []
                g, h = np.nonzero(good)
                single = (s1[g] == 1) & (s2[h] == 1)
                if single.any():  # most groups have one member
                    i, j = at1[g[single]], at2[h[single]]
                    apart = np.bitwise_count(map1[i] ^ map2[j]).sum(1)
                    keep = (c1[i] != c2[j]) & ((n1[g[single]] + n2[h[single]] - apart) // 2 >= need[g[single], h[single]])
                    found.append((i[keep], j[keep]))
                for u, w in zip(g[~single].tolist(), h[~single].tolist(), strict=True):
                    a, b = slice(at1[u], at1[u] + s1[u]), slice(at2[w], at2[w] + s2[w])
                    ones, twos = np.full(s1[u], n1[u]), np.full(s2[w], n2[w])
                    i, j = _passing(ones, np.zeros_like(ones), c1[a], map1[a], twos, np.zeros_like(twos), c2[b], map2[b], percent)
                    found.append((i + at1[u], j + at2[w]))
                i, j = (np.concatenate([f[e] for f in found]) if found else np.zeros(0, np.int64) for e in (0, 1))
                a, b = np.minimum(node1[i], node2[j]), np.maximum(node1[i], node2[j])
                yield _pairs_or_name(a, b, len(node1) + len(node2), token, x, y)

    return run


def _pairs_or_name(a: np.ndarray, b: np.ndarray, members: int, token: int, x: int, y: int) -> pa.RecordBatch:
    """Pairs found in two blocks, or the name of the two if there are more pairs than a block has members."""
    if len(a) > members // 2:
        columns = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([token], pa.int64()), pa.array([x], pa.int32()), pa.array([y], pa.int32())]
    else:
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int32())]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "token", "x", "y"])


def _folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps, folded to ``words`` 64-bit words."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def _map_pairs(percent: int):
    """Members of two blocks, or of one (``right`` is null): pairs that sizes, components, homes and whole bitmaps allow, or the blocks' name."""

    def side(v) -> tuple:
        maps = v.field("bitmap").to_pylist()
        length = np.array([len(x) // 8 for x in maps], np.int64)
        rows = {int(w): np.flatnonzero(length == w) for w in np.unique(length)}
        words = {w: np.frombuffer(b"".join(maps[k] for k in at.tolist()), np.uint64).reshape(len(at), w) for w, at in rows.items()}
        return v.field("own_n").to_numpy(), v.field("component").to_numpy(), v.field("home"), v.field("node").to_numpy(), rows, words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                token, x, y = (batch.column(c)[k].as_py() for c in ("token", "x", "y"))
                alone = not batch.column("right")[k].is_valid
                n1, c1, home1, node1, rows1, words1 = side(batch.column("left")[k].values)
                n2, c2, home2, node2, rows2, words2 = (n1, c1, home1, node1, rows1, words1) if alone else side(batch.column("right")[k].values)
                need = _enough(n1[:, None], n2[None, :], percent)
                good = (c1[:, None] != c2[None, :]) & (np.minimum(n1[:, None], n2) * 100 >= np.maximum(n1[:, None], n2) * percent) & _apart(home1, home2)
                if alone:
                    good = np.triu(good, 1)
                i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for w1, at1 in rows1.items():
                    for w2, at2 in rows2.items():
                        some = good[np.ix_(at1, at2)]
                        if not some.any():
                            continue
                        one, two = _folded(words1[w1], min(w1, w2)), _folded(words2[w2], min(w1, w2))
                        for u in np.flatnonzero(some.any(1)).tolist():
                            h = np.flatnonzero(some[u])
                            a, b = at1[u], at2[h]
                            b = b[(n1[a] + n2[b] - np.bitwise_count(two[h] ^ one[u]).sum(1, dtype=np.int64)) // 2 >= need[a, b]]
                            i.append(np.full(len(b), a))
                            j.append(b)
                a, b = node1[np.concatenate(i)], node2[np.concatenate(j)]
                yield _pairs_or_name(np.minimum(a, b), np.maximum(a, b), len(node1) + len(node2), token, x, y)

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["node", "shingles"])

    return run


def _dense_links(percent: int):
    """Members of two blocks, or of one (``right`` is null), with their sets: the links that join components not joined before, in the order they are found."""

    def side(v) -> tuple:
        sets = [np.frombuffer(x, np.uint64) for x in v.field("shingles").to_pylist()]
        maps = np.frombuffer(b"".join(_bitmap(x, 4 * SMALL) for x in sets), np.uint64).reshape(len(sets), SMALL // 16)
        n = np.array([len(x) for x in sets], np.int64)  # of an id with several texts each has its own
        return n, *[v.field(c).to_numpy() for c in ("place", "component")], maps, v.field("node").to_numpy(), sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                one = side(batch.column("left")[k].values)
                alone = not batch.column("right")[k].is_valid
                two = one if alone else side(batch.column("right")[k].values)
                i, j = _passing(*one[:4], *two[:4], percent)
                if alone:
                    i, j = i[i < j], j[i < j]
                parent: dict[int, int] = {}

                def top(x: int) -> int:
                    while (up := parent.setdefault(x, x)) != x:
                        parent[x] = x = parent[up]
                    return x

                a, b = [], []
                for u, w in zip(i.tolist(), j.tolist(), strict=True):
                    x, y = top(int(one[2][u])), top(int(two[2][w]))
                    if x == y:
                        continue
                    first, second = one[5][u], two[5][w]
                    both = len(np.intersect1d(first, second, assume_unique=True))
                    if 100 * both >= percent * (len(first) + len(second) - both):
                        parent[x] = y
                        a.append(int(one[4][u]))
                        b.append(int(two[4][w]))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def join(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``n_shingles`` and ``component_id``."""
    number = F.coalesce(F.col(id).cast("long"), F.lit(NONE))
    work = _Join(docs.select(number.alias("id"), F.col(text).alias("text")), width, percent)
    found = work.run()
    rows = work.signed.select("id", "n").join(found, "id", "left")
    label = F.coalesce("component", "id")
    known = lambda c: F.when(c != NONE, c)
    return rows.select(known(F.col("id")).alias(id), F.col("n").alias("n_shingles"), known(label).alias("component_id"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Of ``rows`` equal in key and tag one, with a number (``_number``) in the order of both."""
    places = rows.select("_key", "_tag").distinct().orderBy("_key", "_tag").withColumn("_number", F.monotonically_increasing_id())
    one = rows.dropDuplicates(["_key", "_tag"])
    return stage(one.join(stage(places, "jaccard-numbers"), ["_key", "_tag"]), "jaccard-numbered")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that have a near duplicate with a smaller id in their component.

    Where rows share an id, one row of those equal in text too stays, and unlike texts are documents of their own, ordered by a
    hash of the text.
    """
    key = F.coalesce(F.col(id).cast("long"), F.lit(NONE))
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"), F.xxhash64(text).alias("_tag"))
    if rows.groupBy("_key").count().filter("count > 1").isEmpty():
        rows = rows.withColumn("_number", F.col("_key"))
    else:
        rows = _numbered(rows)
    work = _Join(rows.select(F.col("_number").alias("id"), F.col("_row")[text].alias("text")), width, percent)
    gone = stage(work.run().filter("id != component").select("id"), "jaccard-gone")
    rows = sieve(rows, "_number", gone, "id")
    kept = rows.filter(~F.col("_maybe")).unionByName(rows.filter("_maybe").join(gone, F.col("_number") == F.col("id"), "left_anti"))
    return kept.select(*[F.col("_row")[x].alias(x) for x in docs.columns])
