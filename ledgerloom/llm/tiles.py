"""Near duplicates among vectors: pairs of one label whose cosine reaches a threshold, found tile against tile.

1. Vectors equal in label and components collapse into one class, which keeps how many rows it stands for.
2. All vectors are turned by the principal axes of their second moments (one small matrix, summed over all rows), which keeps every
   product. Classes are sorted by label and first coordinate and packed into stripes.
3. Vectors of length one whose cosine is at least t lie within sqrt(2 - 2t) of each other, and so do their first coordinates: stripes
   further apart are never compared. Of two stripes that are, the left one is sent once for every ``LANE`` right ones.
4. Inside a task stripes are split into tiles by the medians of their leading coordinates; tiles whose boxes are too far apart are
   skipped. Two tiles accumulate products over leading coordinates first, some at a time; a pair ends as soon as its product so far
   plus the product of what is left of both lengths cannot reach the threshold. What lasts is decided by the cosine of the vectors
   themselves in double precision.
5. A task returns how many rows each class is linked with, and of its links a spanning forest, never all pairs of a group.
   Components come from the forests.

All pairs of tiles of one label may have to be looked at if no coordinate tells vectors apart: that is the operator, and bounds only
make it less. The stripes a task receives are bounded.

Defined results: a vector that is null, zero or holds null or non-finite components, and one without a label, links with nothing and is
its own component; a shorter vector counts as if zeros followed; rows equal in label and vector are linked with each other, also if
they share an id; a component's id is the smallest id of its rows, null if none has one, and a row is kept if its id equals that;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.jaccard import components
from ledgerloom.llm.shared import ship
from ledgerloom.llm.vectors import attach, usable
from ledgerloom.session import stage

STRIPE = 1 << 18  # numbers of a stripe
LANE = 8  # right stripes a left one meets in one task
TILE = 256
LEADING = 8  # coordinates of a tile's box
STEPS = (8, 8, 16, 32)  # coordinates added at a time; the last number repeats
DENSE = 16  # matrix products go on while more than 1/DENSE of the pairs are open
SLACK = 1e-9  # for bounds; far above the rounding of products of vectors of length one


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(1, keepdims=True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as the rows of a matrix, zeros after shorter ones."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            unit = _units(_matrix(batch.column("vector"), width))
            total += (unit * batch.column("rows").to_numpy()[:, None]).T @ unit
        i, j = np.nonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "x"])

    return run


def axes(classes: DataFrame, width: int) -> np.ndarray:
    """Principal axes as columns, the one with the largest second moment first; at most ``width`` squared numbers come here."""
    sent = classes.mapInArrow(_moments(width), "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    moment = np.zeros((width, width))
    for i, j, x in sent.toLocalIterator():
        moment[i, j] = moment[j, i] = x
    return np.linalg.eigh(moment)[1][:, ::-1].copy()


def _first(turn, width: int):
    """Classes with their first coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = _units(_matrix(batch.column("vector"), width)) @ turn.value[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], [*batch.schema.names, "first"])

    return run


def _stripe_rows(width: int) -> int:
    return max(TILE, STRIPE // width)


def _pack(width: int):
    """Sorted classes as stripes of one label: the range of first coordinates, nodes, numbers of rows and vectors."""

    most = _stripe_rows(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, current = 0, None

        def stripe() -> pa.RecordBatch:
            firsts = np.concatenate([x[0] for x in held])
            blobs = [np.concatenate([x[k] for x in held]).tobytes() for k in (1, 2, 3)]
            return pa.RecordBatch.from_arrays(
                [pa.array([current]), pa.array([firsts.min()]), pa.array([firsts.max()]), *[pa.array([b], pa.binary()) for b in blobs]],
                ["label", "low", "high", "nodes", "rows", "vectors"],
            )

        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            columns = [batch.column("first").to_numpy(), batch.column("node").to_numpy(), batch.column("rows").to_numpy(), _matrix(batch.column("vector"), width)]
            edges = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), len(label)]
            for low, end in zip(edges[:-1], edges[1:], strict=True):
                while low < end:
                    if size and (label[low] != current or size == most):
                        yield stripe()
                        held, size = [], 0
                    current = label[low]
                    high = min(end, low + most - size)
                    held.append(tuple(c[low:high] for c in columns))
                    size += high - low
                    low = high
        if size:
            yield stripe()

    return run


class Stripe:
    def __init__(self, nodes: bytes, rows: bytes, vectors: bytes, turn: np.ndarray):
        self.nodes, self.rows = np.frombuffer(nodes, np.int64), np.frombuffer(rows, np.int64)
        self.vectors = np.frombuffer(vectors, np.float64).reshape(len(self.nodes), -1)
        self.units = _units(self.vectors)
        turned = self.units @ turn
        order = _tiled(turned[:, :LEADING])
        self.nodes, self.rows, self.vectors, self.units, turned = self.nodes[order], self.rows[order], self.vectors[order], self.units[order], turned[order]
        steps, at = [], 0
        while at < turned.shape[1]:
            steps.append((at, min(turned.shape[1], at + STEPS[min(len(steps), len(STEPS) - 1)])))
            at = steps[-1][1]
        self.blocks = [turned[:, a:b] for a, b in steps]
        squares = np.cumsum(np.square(turned)[:, ::-1], 1)[:, ::-1]
        self.left_over = [np.sqrt(squares[:, b]) if b < turned.shape[1] else np.zeros(len(turned)) for _, b in steps]
        self.tiles = [slice(a, min(a + TILE, len(turned))) for a in range(0, len(turned), TILE)]
        self.low = np.array([turned[t, :LEADING].min(0) for t in self.tiles])
        self.high = np.array([turned[t, :LEADING].max(0) for t in self.tiles])


def _tiled(points: np.ndarray) -> np.ndarray:
    """An order in which stretches of ``TILE`` places are boxes: halves by the widest coordinate, again and again."""
    out, open_ = [], [np.arange(len(points))]
    while open_:
        members = open_.pop()
        if len(members) <= TILE:
            out.append(members)
            continue
        part = points[members]
        order = members[np.argsort(part[:, np.ptp(part, 0).argmax()], kind="stable")]
        half = -(-len(members) // (2 * TILE)) * TILE
        open_ += [order[half:], order[:half]]
    return np.concatenate(out)


def compare(one: Stripe, two: Stripe, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of linked pairs, each once, and how many pairs were open after the first step. ``two`` may be ``one``."""
    found_i, found_j, looked = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    room = 2 - 2 * threshold + SLACK
    for t, a in enumerate(one.tiles):
        gap = np.maximum(0, np.maximum(one.low[t] - two.high, two.low - one.high[t]))
        for u in np.flatnonzero(np.square(gap).sum(1) <= room).tolist():
            if one is two and u < t:
                continue
            b = two.tiles[u]
            product, k = one.blocks[0][a] @ two.blocks[0][b].T, 0
            while True:
                open_ = product + one.left_over[k][a][:, None] * two.left_over[k][b] >= threshold - SLACK
                if one is two and u == t:
                    open_ = np.triu(open_, 1)
                n = int(open_.sum())
                looked += n if k == 0 else 0
                k += 1
                if n * DENSE <= open_.size or k == len(one.blocks):
                    break
                product += one.blocks[k][a] @ two.blocks[k][b].T
            i, j = np.nonzero(open_)
            sums = product[i, j]
            i, j = i + a.start, j + b.start
            for later in range(k, len(one.blocks)):
                if not len(i):
                    break
                sums = sums + np.einsum("ij,ij->i", one.blocks[later][i], two.blocks[later][j])
                keep = sums + one.left_over[later][i] * two.left_over[later][j] >= threshold - SLACK
                i, j, sums = i[keep], j[keep], sums[keep]
            if len(i):
                keep = np.einsum("ij,ij->i", one.units[i], two.units[j]) >= threshold
                found_i.append(i[keep])
                found_j.append(j[keep])
    return np.concatenate(found_i), np.concatenate(found_j), looked


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """(node, smallest node it reaches) over the links, for all but the smallest ones."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        parent[max(x, y)] = min(x, y)
    pairs = [(x, top(x)) for x in parent]
    return [x for x, y in pairs if x != y], [y for x, y in pairs if x != y]


def _matches(turn, threshold: float):
    """Rows come sorted by (left, lane), the left stripe itself first; per task (node, linked rows) and forest edges (node, other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, left = None, None
        for batch in batches:
            for row in range(len(batch)):
                key, right = (batch.column("left")[row].as_py(), batch.column("lane")[row].as_py()), batch.column("right")[row].as_py()
                other = Stripe(*[batch.column(c)[row].as_py() for c in ("nodes", "rows", "vectors")], turn.value)
                if key != current:
                    current, left = key, other
                    if right is not None:
                        raise RuntimeError("a left stripe is missing")
                    continue
                if right == key[0]:
                    other = left
                i, j, _ = compare(left, other, threshold)
                a, b = left.nodes[i], other.nodes[j]
                nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
                linked = np.bincount(back, np.concatenate([other.rows[j], left.rows[i]]), len(nodes)).astype(np.int64)
                child, top = _forest(a, b)
                node = np.concatenate([nodes, np.array(child, np.int64)])
                counts = pa.array([*linked.tolist(), *[None] * len(child)], pa.int64())
                tops = pa.array([*[None] * len(nodes), *top], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), counts, tops], ["node", "linked", "top"])

    return run


def _links(stripes: DataFrame, turn, threshold: float) -> DataFrame:
    """(node, linked, top): parts of the number of rows a class is linked with, or an edge of a forest."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    spans = stripes.select("label", "stripe", "low", "high")
    one = spans.select("label", F.col("stripe").alias("left"), F.col("low").alias("l1"), F.col("high").alias("h1"))
    two = spans.select("label", F.col("stripe").alias("right"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    near = (F.col("l2") <= F.col("h1") + reach) & (F.col("l1") <= F.col("h2") + reach)
    pairs = one.join(two, "label").filter((F.col("left") <= F.col("right")) & near).select("left", "right")
    pairs = stage(pairs.withColumn("lane", F.pmod(F.xxhash64("right"), F.lit(1 << 20)).cast("int")), "tiles-pairs")
    lanes = pairs.groupBy("left").agg(F.ceil(F.count("*") / LANE).cast("int").alias("lanes"))
    pairs = pairs.join(lanes, "left").withColumn("lane", F.pmod(F.col("lane"), F.col("lanes"))).select("left", "lane", "right")
    pairs = stage(pairs, "tiles-lanes")
    content = stripes.select("stripe", "nodes", "rows", "vectors")
    firsts = pairs.select("left", "lane").distinct().withColumn("right", F.lit(None).cast("long"))
    rows = firsts.join(content, F.col("left") == F.col("stripe")).unionByName(pairs.join(content, F.col("right") == F.col("stripe"))).drop("stripe")
    tasks = max(1, firsts.count())
    dealt = rows.repartition(tasks, "left", "lane").sortWithinPartitions("left", "lane", F.col("right").asc_nulls_first())
    return stage(dealt.mapInArrow(_matches(turn, threshold), "node long, linked long, top long"), "tiles-links")


def near_duplicates(table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98) -> DataFrame:
    """One row per row of ``table``: the id, ``n_links``, ``component_id`` and ``kept``. ``threshold`` is over zero."""
    spark = table.sparkSession
    ship(spark)
    good = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull()
    rows = table.select(F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    part = rows.filter(good)
    alone = rows.filter(~F.coalesce(good, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    grouped = part.groupBy("label", "vector").agg(F.count("*").alias("rows"), F.min("id").alias("least"))
    classes = stage(grouped, "tiles-grouped").withColumn("node", F.monotonically_increasing_id())
    classes = stage(classes, "tiles-classes")
    width = classes.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return _named(alone, id)
    turn = spark.sparkContext.broadcast(axes(classes, width))
    inner = classes.select("label", "node", "rows", "vector")
    placed = stage(inner.mapInArrow(_first(turn, width), "label string, node long, rows long, vector array<double>, first double"), "tiles-first")
    parts = max(1, -(-placed.count() // _stripe_rows(width)))
    sorted_ = placed.repartitionByRange(parts, "label", "first", "node").sortWithinPartitions("label", "first", "node")
    packed = sorted_.mapInArrow(_pack(width), "label string, low double, high double, nodes binary, rows binary, vectors binary")
    stripes = stage(stage(packed, "tiles-packed").withColumn("stripe", F.monotonically_increasing_id()), "tiles-stripes")
    found = _links(stripes, turn, threshold)
    linked = found.filter("linked is not null").groupBy("node").agg(F.sum("linked").alias("linked"))
    labels = components(found.filter("top is not null").select(F.col("node").alias("a"), F.col("top").alias("b")))
    labels = labels.select(F.col("id").alias("node"), F.col("component").alias("_top"))
    known = classes.join(linked, "node", "left").join(labels, "node", "left").withColumn("_top", F.coalesce("_top", "node"))
    known = stage(known.select("label", "vector", "rows", "least", "_top", (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links")), "tiles-known")
    tops = stage(known.groupBy("_top").agg(F.min("least").alias("component_id"), F.count("*").alias("_n")), "tiles-tops")
    known = attach(known, tops, ["_top"], "_n").select("label", "vector", "rows", "n_links", "component_id")
    return _named(attach(part, stage(known, "tiles-final"), ["label", "vector"], "rows").select("id", "n_links", "component_id").unionByName(alone), id)


def _named(rows: DataFrame, id: str) -> DataFrame:
    return rows.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id)
