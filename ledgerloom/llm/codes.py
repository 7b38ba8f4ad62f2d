"""Short codes of vectors: a codebook for each of their parts, fitted over metric trees.

Vectors become whole numbers, floor(scale * x), and are cut into equal consecutive parts. The entries of a codebook start as the parts
of the vectors with the smallest ids. A round gives every part to its nearest entry and moves each entry to the mean of its parts,
rounded down; the final codes name the nearest entries.

Nearest entries are found over metric trees. Vectors are taken in chunks where they are read, and each part of a chunk becomes a tree
by the anchors hierarchy, middle out: about sqrt(n) anchors, each the point furthest from its anchor so far, take the points nearer to
them (the triangle inequality leaves most points alone); anchors are merged upwards, the pair with the smallest common ball first, and
each is divided downwards in the same way. A ball keeps its centre, radius, sum and number of points, equal parts being one point with
a number. In a round a ball inherits its parent's list of candidate entries and drops those that lie behind the nearest entry's
bisecting plane for the whole ball. With one candidate left its sum and count go to that entry as they are. Trees are built once, written,
and used by every round; a round sends (part, entry, place) sums alone, and only codebooks come to the driver.

Defined results: vectors that are null or hold null or non-finite components are left out; a shorter vector counts as if zeros followed,
up to the longest one and to equal parts; fewer vectors than entries make a smaller codebook; an entry without parts stays; null ids
come last, and rows with equal ids are ordered by vector; repeated rows count as often as they come; null labels are one label; an empty
table gives an empty table; other columns are ignored. Components whose whole number is over 2^24 are refused with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import ship
from ledgerloom.llm.vectors import attach, usable
from ledgerloom.session import stage

CHUNK = 4096  # vectors a tree is built over
LEAF = 16  # points of a ball that is not divided
LARGEST = 1 << 24
SLACK = 1 + 1e-9


def _far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.square(points - centre).sum(1)


class Tree:
    """Balls over weighted points; a ball holds the points ``start`` to ``end`` of the tree's order."""

    def __init__(self, points: np.ndarray, weight: np.ndarray):
        self.order: list[np.ndarray] = []
        self._points, self._weight, self._at = points, weight, 0
        self.start: list[int] = []
        self.end: list[int] = []
        self.children: list[tuple[int, int]] = []
        if len(points):
            self._divide(np.arange(len(points)))
        order = np.concatenate(self.order) if self.order else np.zeros(0, np.int64)
        self.points, self.weight, self.order = points[order], weight[order], order
        self._measure()

    def _leaf(self, members: np.ndarray) -> int:
        self.order.append(members)
        self.start.append(self._at)
        self._at += len(members)
        self.end.append(self._at)
        self.children.append((-1, -1))
        return len(self.start) - 1

    def _divide(self, members: np.ndarray) -> int:
        """The ball of ``members``: anchors, then each of them divided, then merged upwards."""
        anchors = self._anchors(members) if len(members) > LEAF else [members]
        if len(anchors) == 1:
            return self._leaf(members)
        return self._merge(anchors)

    def _anchors(self, members: np.ndarray) -> list[np.ndarray]:
        points = self._points[members]
        far = np.sqrt(_far(points, points[0]))
        order = np.argsort(-far, kind="stable")
        owned, distance, pivot = [order], [far[order]], [0]  # by falling distance from the anchor
        wanted = int(np.ceil(np.sqrt(len(members))))
        while len(owned) < wanted:
            k = max(range(len(owned)), key=lambda a: distance[a][0])
            if distance[k][0] == 0:
                break  # all points are anchors
            new = int(owned[k][0])
            apart = np.sqrt(_far(points[pivot], points[new]))
            taken, reach = [], []
            for a, gap in enumerate(apart.tolist()):
                # a point nearer to its anchor than half the way to the new one stays
                near = int(np.searchsorted(-distance[a], -gap / 2 * (1 - 1e-12), "right"))
                if not near:
                    continue
                there = np.sqrt(_far(points[owned[a][:near]], points[new]))
                moves = there < distance[a][:near]
                if moves.any():
                    taken.append(owned[a][:near][moves])
                    reach.append(there[moves])
                    stays = np.concatenate([~moves, np.ones(len(owned[a]) - near, bool)])
                    owned[a], distance[a] = owned[a][stays], distance[a][stays]
            taken, reach = np.concatenate(taken), np.concatenate(reach)
            order = np.argsort(-reach, kind="stable")
            owned.append(taken[order])
            distance.append(reach[order])
            pivot.append(new)
        return [members[x] for x in owned]

    def _merge(self, anchors: list[np.ndarray]) -> int:
        """Join the two balls with the smallest common ball until one is left, then lay the tree out from the top."""
        n = len(anchors)
        count = [int(self._weight[a].sum()) for a in anchors]
        centre = np.array([(self._points[a] * self._weight[a][:, None]).sum(0) / c for a, c in zip(anchors, count, strict=True)])
        radius = np.array([np.sqrt(_far(self._points[a], m).max()) for a, m in zip(anchors, centre, strict=True)])
        plan: list[int | tuple] = list(range(n))
        apart = np.sqrt(np.square(centre[:, None] - centre).sum(2))
        common = (apart + radius[:, None] + radius) / 2
        common[np.tril_indices(n)] = np.inf
        for _ in range(n - 1):
            i, j = divmod(int(common.argmin()), n)
            plan[i] = (plan[i], plan[j])
            centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
            count[i] += count[j]
            radius[i] = common[i, j]
            gap = (np.sqrt(np.square(centre - centre[i]).sum(1)) + radius + radius[i]) / 2
            common[j, :] = common[:, j] = np.inf
            alive = np.isfinite(common[i]) | np.isfinite(common[:, i])
            alive[i] = False
            later = np.arange(n) > i
            common[i] = np.where(alive & later, gap, np.inf)
            common[:, i] = np.where(alive & ~later, gap, np.inf)
            top = plan[i]

        stack: list[tuple] = [(top, False)]
        built: list[int] = []
        while stack:
            node, ready = stack.pop()
            if isinstance(node, int):
                built.append(self._divide(anchors[node]))
            elif ready:
                right, left = built.pop(), built.pop()
                self.start.append(self.start[left])
                self.end.append(self.end[right])
                self.children.append((left, right))
                built.append(len(self.start) - 1)
            else:
                stack += [(node, True), (node[1], False), (node[0], False)]
        return built[0]

    def _measure(self) -> None:
        """Sum, number, whole-number centre and squared radius of every ball, from its own points."""
        dims = self.points.shape[1]
        self.start, self.end = np.array(self.start, np.int64), np.array(self.end, np.int64)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)
        before = np.concatenate([np.zeros((1, dims), np.int64), np.cumsum(self.points * self.weight[:, None], 0)])
        self.sum = before[self.end] - before[self.start]
        numbers = np.concatenate([[0], np.cumsum(self.weight)])
        self.count = numbers[self.end] - numbers[self.start]
        self.centre = self.sum // np.maximum(self.count, 1)[:, None]
        self.radius = np.array([_far(self.points[s:e], c).max() for s, e, c in zip(self.start, self.end, self.centre, strict=True)], np.int64)

    def owners(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(balls, entries) that own them whole, and (points, entries) as numbers below zero: -1 - point."""
        gaps = np.square(entries[:, None] - entries).sum(2)
        nodes = np.array([len(self.start) - 1]) if len(self.start) else np.zeros(0, np.int64)
        lists = np.ones((len(nodes), len(entries)), bool)
        big = np.iinfo(np.int64).max
        while len(nodes):
            far = np.square(self.centre[nodes][:, None] - entries).sum(2)
            far[~lists] = big
            best = far.argmin(1)
            least = far[np.arange(len(nodes)), best]
            margin = np.where(lists, far - least[:, None], 0).astype(np.float64)
            reach = 2 * np.sqrt(gaps[best].astype(np.float64) * self.radius[nodes][:, None]) * SLACK
            twin = (gaps[best] == 0) & (np.arange(len(entries)) > best[:, None])
            lists &= ~((margin > reach) | twin)
            lists[np.arange(len(nodes)), best] = True
            alone = lists.sum(1) == 1
            yield nodes[alone], best[alone]
            leaf = self.children[nodes, 0] < 0
            rest = np.flatnonzero(~alone & leaf)
            if len(rest):
                sizes = self.end[nodes[rest]] - self.start[nodes[rest]]
                row = np.repeat(rest, sizes)
                point = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.start[nodes[row]]
                away = np.square(self.points[point][:, None] - entries).sum(2)
                away[~lists[row]] = big
                yield -1 - point, away.argmin(1)
            deeper = np.flatnonzero(~alone & ~leaf)
            nodes, lists = self.children[nodes[deeper]].ravel(), np.repeat(lists[deeper], 2, 0)

    def add(self, entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the points' sums and numbers to those of their nearest entries."""
        for what, entry in self.owners(entries):
            if len(what) and what[0] < 0:
                point = -1 - what
                np.add.at(sums, entry, self.points[point] * self.weight[point][:, None])
                np.add.at(counts, entry, self.weight[point])
            else:
                np.add.at(sums, entry, self.sum[what])
                np.add.at(counts, entry, self.count[what])

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every point, and the squared distance, in the order the points were given."""
        entry = np.zeros(len(self.points), np.int64)
        for what, best in self.owners(entries):
            if len(what) and what[0] < 0:
                entry[-1 - what] = best
            else:
                for ball, e in zip(what.tolist(), best.tolist(), strict=True):
                    entry[self.start[ball] : self.end[ball]] = e
        out, away = np.empty_like(entry), np.empty_like(entry)
        out[self.order] = entry
        away[self.order] = np.square(self.points - entries[entry]).sum(1)
        return out, away

    FIELDS = ("order", "points", "weight", "start", "end", "children", "sum", "count", "centre", "radius")

    def dump(self) -> bytes:
        """The tree as whole numbers; a reader knows the sizes from the first three."""
        head = np.array([len(self.points), len(self.start), self.points.shape[1]], np.int64)
        return b"".join(x.astype(np.int64).tobytes() for x in (head, *[getattr(self, f) for f in self.FIELDS]))

    @classmethod
    def load(cls, data: bytes) -> Tree:
        n, balls, dims = np.frombuffer(data, np.int64, 3).tolist()
        shapes = dict(order=(n,), points=(n, dims), weight=(n,), start=(balls,), end=(balls,), children=(balls, 2), sum=(balls, dims), count=(balls,), centre=(balls, dims), radius=(balls,))
        tree, at = cls.__new__(cls), 24
        for field in cls.FIELDS:
            size = int(np.prod(shapes[field]))
            setattr(tree, field, np.frombuffer(data, np.int64, size, at).reshape(shapes[field]))
            at += 8 * size
        return tree


def _whole(vectors: list[list], scale: float, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, vector in enumerate(vectors):
        values = np.floor(np.asarray(vector, np.float64) * scale)
        if len(values) and np.abs(values).max() > LARGEST:
            raise ValueError(f"a component is over {LARGEST} / {scale:g}")
        out[k, : len(values)] = values
    return out


def _grow(parts: int, width: int, scale: float):
    """A chunk of vectors as one row: ids, labels, and for each part the tree and the point of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk(table: pa.Table) -> pa.RecordBatch:
            whole = _whole(table.column("vector").to_pylist(), scale, width * parts)
            trees = []
            for p in range(parts):
                points, back, weight = np.unique(whole[:, p * width : (p + 1) * width], axis=0, return_inverse=True, return_counts=True)
                trees.append(zstandard.compress(back.reshape(-1).astype(np.int64).tobytes() + Tree(points, weight).dump(), 1))
            ids, labels = table.column("id").combine_chunks(), table.column("label").combine_chunks()
            one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(kind))
            return pa.RecordBatch.from_arrays([one(ids, pa.int64()), one(labels, pa.string()), pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            while size >= CHUNK:
                table = pa.Table.from_batches(held)
                yield chunk(table.slice(0, CHUNK))
                held = table.slice(CHUNK).to_batches()
                size -= CHUNK
        if size:
            yield chunk(pa.Table.from_batches(held))

    return run


def _trees(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, list[tuple[np.ndarray, Tree]]]]:
    for row in range(len(batch)):
        ids, labels = batch.column("ids")[row].values, batch.column("labels")[row].values
        blobs = [zstandard.decompress(x.as_py()) for x in batch.column("trees")[row].values]
        yield ids, labels, [(np.frombuffer(b, np.int64, len(ids)), Tree.load(b[8 * len(ids) :])) for b in blobs]


def _sums(books):
    """Sums and numbers of the parts nearest to each entry, over all chunks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        sums, counts = np.zeros_like(entries), np.zeros(entries.shape[:2], np.int64)
        for batch in batches:
            for _, _, parts in _trees(batch):
                for p, (_, tree) in enumerate(parts):
                    tree.add(entries[p], sums[p], counts[p])
        part, entry = np.nonzero(counts)
        if len(part):
            dims = entries.shape[2]
            columns = [np.repeat(part, dims), np.repeat(entry, dims), np.tile(np.arange(dims), len(part)), sums[part, entry].ravel(), np.repeat(counts[part, entry], dims)]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["part", "entry", "place", "total", "n"])

    return run


def _codes(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.value
        for batch in batches:
            for ids, labels, parts in _trees(batch):
                error, code = np.zeros(len(ids), np.int64), np.zeros((len(ids), len(parts)), np.uint8)
                for p, (spot, tree) in enumerate(parts):
                    best, away = tree.nearest(entries[p])
                    code[:, p] = best[spot]
                    error += away[spot]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)], ["id", "label", "code", "error"])

    return run


class Codes:
    """The result: ``codebooks`` (part, entry, place within the part) and ``rows`` (id, label, code, error)."""

    def __init__(self, codebooks: np.ndarray, rows: DataFrame):
        self.codebooks, self.rows = codebooks, rows

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()

    def with_label_error(self) -> DataFrame:
        """``rows`` with the error summed over equal labels."""
        key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
        rows = self.rows.withColumn("_label", key)
        sums = stage(rows.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows")), "codes-labels")
        return attach(rows, sums, ["_label"], "_rows").drop("_label", "_rows")


def fit(table: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> Codes:
    """Codebooks of ``entries`` (256 at most) entries for each of ``parts`` parts, and the code of every vector.

    A code holds a byte for each part. ``label`` may be of any type that has a text form.
    """
    spark = table.sparkSession
    ship(spark)
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number is one byte")
    kept = table.filter(usable(F.col(vector))).select(F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    whole = _whole([r["vector"] for r in first], scale, width * parts)
    books = np.ascontiguousarray(whole.reshape(len(first), parts, width).transpose(1, 0, 2))
    trees = stage(kept.mapInArrow(_grow(parts, width, scale), "ids array<long>, labels array<string>, trees array<binary>"), "codes-trees")
    for _ in range(rounds if len(first) else 0):
        shared = spark.sparkContext.broadcast(books)
        sent = trees.mapInArrow(_sums(shared), "part long, entry long, place long, total long, n long")
        books = books.copy()
        for row in sent.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books[row["part"], row["entry"], row["place"]] = row["total"] // row["n"]
    rows = trees.mapInArrow(_codes(spark.sparkContext.broadcast(books)), "id long, label string, code binary, error long")
    return Codes(books, stage(rows, "codes-rows"))
