"""Exact top-k by inner product with a pivot-distance index.

Vectors are made whole numbers, floor(scale * x). A last component, sqrt(M - |x|^2) for rows and 0 for queries with M the greatest
|x|^2, turns the largest product into the least distance: d^2 = M + |q|^2 - 2 x.q.

* **Index.** Pivots are chosen far from each other in a bounded sample (``SAMPLE`` rows with the least hashes of their ids; it
  moves work only, never results). Every row is keyed by its nearest pivot and its distance to it; rows are sorted by that key and cut
  into rings of at most ``RING`` rows. Rings know their least and greatest distance.
* **Search.** Queries with the same nearest pivot go in blocks. A block first meets the ring next to it, for a first
  bound on its k-th scores. For any other ring the triangle inequality gives the least possible distance; pairs of a block and a ring that
  cannot reach the bound are dropped on their numbers alone. The rest are visited in order of that distance, the annulus around
  the queries growing, each a product of two small matrices, until the best distance left cannot reach the k-th score.

Scores are exact: products are summed in doubles only while they stay below 2^53, else as Python integers. Ties go to the smaller id.

Defined results: vectors that are null or hold a null or non-finite component take no part; a shorter vector is filled with zeros;
scores beyond a long are cut to its range; rows with one id are candidates each, but one query (the least vector) and never their own
answer; fewer than k candidates are all returned; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import ship
from ledgerloom.session import stage

SAMPLE = 2048
PIVOTS = 32
RING = 2048
BLOCK = 256
EXACT = 2.0**53
SLACK = 1e-6  # relative room for rounding in distances; scores themselves are exact
LONG = (1 << 63) - 1


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    lengths = np.asarray(pc.list_value_length(column))
    values = np.asarray(column.flatten())
    if len(values):
        rows = np.repeat(np.arange(len(column)), lengths)
        spots = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[rows, spots] = values
    return out


def _kind(square: float) -> type:
    """How components of rows whose squares sum to at most ``square`` are stored: two bytes, or doubles."""
    return np.int16 if square < 2.0**30 else np.float64


def _pivots(sample: np.ndarray, square: float, count: int) -> np.ndarray:
    """Rows of ``sample`` with their last component, each the farthest from those chosen before."""
    rows = np.hstack([sample, np.sqrt(np.maximum(0, square - (sample**2).sum(1)))[:, None]])
    chosen = [0]
    away = ((rows - rows[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(rows)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((rows - rows[chosen[-1]]) ** 2).sum(1))
    return rows[chosen]


KEYED = "id long, vector array<double>, pivot int, distance double, distances array<double>"


def _keyer(width: int, square: float, pivots: np.ndarray, query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            norm = (x**2).sum(1)
            last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, square - norm))
            full = np.hstack([x, last[:, None]])
            far = (full**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * full @ pivots.T
            far = np.sqrt(np.maximum(0, far))
            near = far.argmin(1)
            rows = pa.array(list(far)) if query else pa.nulls(len(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(x), pa.list_(pa.float64())), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(x)), near]), rows.cast(pa.list_(pa.float64()))],
                ["id", "vector", "pivot", "distance", "distances"],
            )

    return run


def _rings(width: int, most: int, query: bool, square: float):
    """Runs of rows of one pivot, at most ``most``, as one row each; rows come sorted by pivot, distance and id."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def made(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal number
            pivot = table.column("pivot").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(pivot)) + 1, [len(pivot)]])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for at in range(low, high, most):
                    part = table.slice(at, min(most, high - at)).combine_chunks()
                    x = _matrix(part.column("vector").chunk(0), width)
                    far = part.column("distance").to_numpy()
                    all_far = _matrix(part.column("distances").chunk(0), len(part.column("distances")[0])) if query else np.zeros((1, 0))
                    number += 1
                    yield pa.RecordBatch.from_pydict(
                        {
                            "number": [number], "pivot": [int(pivot[at])], "n": [len(part)], "low": [far.min()], "high": [far.max()],
                            "ids": [part.column("id").to_numpy().astype("<i8").tobytes()], "vectors": [x.astype(_kind(square)).tobytes()],
                            "nearest": [all_far.min(0).tolist()], "farthest": [all_far.max(0).tolist()], "norm": [float((x**2).sum(1).max())],
                        },
                        RINGS,
                    )

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= 8 * most:
                yield from made(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield from made(pa.Table.from_batches(held))

    return run


RINGS = pa.schema([
    ("number", pa.int64()), ("pivot", pa.int32()), ("n", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.binary()),
    ("vectors", pa.binary()), ("nearest", pa.list_(pa.float64())), ("farthest", pa.list_(pa.float64())), ("norm", pa.float64()),
])
RING_TYPES = "number long, pivot int, n int, low double, high double, ids binary, vectors binary, nearest array<double>, farthest array<double>, norm double"


def _scores(q: np.ndarray, x: np.ndarray, square: float) -> np.ndarray:
    if square * 2 < EXACT:
        return (q @ x.T).astype(np.int64)
    exact = np.array([[int(v) for v in row] for row in q.tolist()], object) @ np.array([[int(v) for v in row] for row in x.tolist()], object).T
    return np.array([[max(-LONG - 1, min(LONG, int(v))) for v in row] for row in exact.tolist()], np.int64).reshape(len(q), len(x))


class _Best:
    """The k best (score, smaller id first) of each query of one block."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score = [np.zeros(0, np.int64) for _ in ids]
        self.found = [np.zeros(0, np.int64) for _ in ids]
        self.floor = np.full(len(ids), -np.inf)  # the k-th score so far

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        for k, row in enumerate(rows.tolist()):
            s = scores[k]
            good = np.flatnonzero((s >= self.floor[row]) & (ids != self.ids[row]))
            if len(good) > 4 * self.k:
                least = np.partition(s[good], len(good) - self.k)[len(good) - self.k]
                good = good[s[good] >= least]
            if not len(good):
                continue
            s, found = np.concatenate([self.score[row], s[good]]), np.concatenate([self.found[row], ids[good]])
            order = np.lexsort((found, -s))[: self.k]
            self.score[row], self.found[row] = s[order], found[order]
            if len(order) == self.k:
                self.floor[row] = s[order[-1]]


FOUND = "block long, query_id long, vec_id long, score long, floor double"
FOUND_ARROW = pa.schema([("block", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("floor", pa.float64())])


def _searcher(width: int, square: float, k: int, floors_only: bool):
    """Visit the rings of each block, nearest first; rows come sorted by block and distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, q, far = None, None, None, None
        kind = _kind(square)

        def done() -> pa.RecordBatch:
            if floors_only:
                n = len(best.ids)
                return pa.RecordBatch.from_arrays([pa.array(np.full(n, current)), pa.array(best.ids), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(best.floor)], schema=FOUND_ARROW)
            ids = np.repeat(best.ids, [len(x) for x in best.found])
            n = len(ids)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, current)), pa.array(ids), pa.array(np.concatenate(best.found)), pa.array(np.concatenate(best.score)), pa.nulls(n, pa.float64())], schema=FOUND_ARROW)

        for batch in batches:
            for k_row in range(len(batch)):
                row = {n: batch.column(n)[k_row] for n in batch.schema.names}
                if row["block"].as_py() != current:
                    if best is not None:
                        yield done()
                    current = row["block"].as_py()
                    q = np.frombuffer(row["query_vectors"].as_buffer(), kind).reshape(-1, width).astype(np.float64)
                    best = _Best(np.frombuffer(row["query_ids"].as_buffer(), "<i8"), k)
                    known = row["floors"].as_py() if "floors" in row else None
                    if known:
                        by = {x["query_id"]: x["floor"] for x in known}
                        best.floor = np.array([by.get(int(i), -np.inf) for i in best.ids])
                    far = (q**2).sum(1)
                # the greatest score the distance allows; none of the block may still need this ring
                bound = (square + far - row["least"].as_py() ** 2) / 2
                open_ = np.flatnonzero(bound * (1 + np.sign(bound) * SLACK) + SLACK * (square + 1) >= best.floor)
                if len(open_):
                    ids = np.frombuffer(row["ids"].as_buffer(), "<i8")
                    x = np.frombuffer(row["vectors"].as_buffer(), kind).reshape(-1, width).astype(np.float64)
                    best.add(open_, ids, _scores(q[open_], x, square))
        if best is not None:
            yield done()

    return run


def _least(low: Column, high: Column, nearest: Column, farthest: Column) -> Column:
    """The least distance between a query at nearest..farthest from a pivot and a row at low..high from it."""
    return F.greatest(F.lit(0.0), low - farthest, nearest - high)


def top_k(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, scale: float = 64.0, pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` best rows for every query (row whose id is divisible by ``every``): query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    ship(spark)
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.transform(F.col(vector), lambda x: _floor(x.cast("double") * scale))
    base = rows.filter(F.col(id).isNotNull() & F.col(vector).isNotNull() & F.forall(F.col(vector), sound))
    base = stage(base.select(F.col(id).cast("long").alias("id"), whole.alias("vector")), "pivot-rows")
    norm = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x)
    facts = base.agg(F.max(F.size("vector")).alias("width"), F.max(norm).alias("square"), F.count("*").alias("n")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, square = max(1, facts["width"]), facts["square"]
    sample = [r["vector"] for r in base.orderBy(F.xxhash64("id"), "id", "vector").limit(SAMPLE).collect()]
    points = _pivots(np.array([v + [0.0] * (width - len(v)) for v in sample]), square, pivots)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sorted_rings(source: DataFrame, most: int, query: bool, name: str) -> DataFrame:
        keyed = stage(source.mapInArrow(_keyer(width, square, points, query), KEYED), f"{name}-keys")
        spread = keyed.repartitionByRange(parts, "pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id")
        return stage(spread.mapInArrow(_rings(width, most, query, square), RING_TYPES), name)

    rings = sorted_rings(base, RING, False, "pivot-rings")
    queries = base.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = sorted_rings(queries, BLOCK, True, "pivot-blocks")
    plain = blocks.select(F.col("number").alias("block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    places = rings.select("number", "pivot", "low", "high")

    near = blocks.select(F.col("number").alias("block"), "pivot", F.col("low").alias("nearest"), F.col("high").alias("farthest"))
    near = near.join(places, "pivot").withColumn("least", _least(F.col("low"), F.col("high"), F.col("nearest"), F.col("farthest")))
    near = near.groupBy("block").agg(F.min(F.struct("least", "number")).alias("ring")).select("block", "ring.least", "ring.number")
    content = rings.select("number", "ids", "vectors")
    first = near.join(content, "number").join(plain, "block").select("block", "least", "ids", "vectors", "query_ids", "query_vectors")
    floors = stage(first.repartition(parts, "block").sortWithinPartitions("block", "least").mapInArrow(_searcher(width, square, k, True), FOUND), "pivot-floors")
    known = floors.groupBy("block").agg(F.collect_list(F.struct("query_id", "floor")).alias("floors"), F.min("floor").alias("floor"))
    known = stage(known, "pivot-known")  # a block has at most BLOCK queries

    each = blocks.select(F.col("number").alias("block"), "norm", F.posexplode(F.arrays_zip("nearest", "farthest")).alias("pivot", "far"))
    each = each.join(known.select("block", "floor"), "block", "left").join(places, "pivot")
    each = each.withColumn("least", _least(F.col("low"), F.col("high"), F.col("far.nearest"), F.col("far.farthest")))
    bound = (F.lit(square) + F.col("norm") - F.col("least") * F.col("least")) / 2
    open_ = each.filter(F.col("floor").isNull() | (bound + F.abs(bound) * SLACK + SLACK * (square + 1) >= F.col("floor")))
    pairs = stage(open_.select("block", "number", "least"), "pivot-pairs")
    todo = pairs.join(content, "number").join(plain, "block").join(known.select("block", "floors"), "block", "left")
    lanes = F.pmod(F.xxhash64("number"), F.lit(max(1, -(-facts["n"] // (RING * 256)))))
    todo = todo.withColumn("lane", lanes).repartition(parts, "block", "lane").sortWithinPartitions("block", "lane", "least")
    found = todo.drop("lane", "number").mapInArrow(_searcher(width, square, k, False), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.select("query_id", "vec_id", "score", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floor(x: Column) -> Column:
    """floor as a double: floor() itself would give a long, which large values leave."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
