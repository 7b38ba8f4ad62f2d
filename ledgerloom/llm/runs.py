"""Periodic runs of words inside each text, from the Lyndon arrays of its word sequence.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of at least ``max(least, times * q)``
words, that no neighbouring word extends with the same period.

1. Words that occur fewer than ``times`` times between two words already excluded can be in no run, nor extend one; they cut the
   text into segments, again and again until nothing changes. Most texts have no segment left then.
2. The first phase of Baier's suffix sorting groups the suffixes of a segment by their longest Lyndon prefix: groups are taken
   from the highest down, and each lengthens the prefix of the nearest suffix to the left that stands in a lower group. The lengths
   of the groups' prefixes are the Lyndon array, under the order of the words' numbers and under the reverse one.
3. By the runs theorem every run holds a Lyndon word of one of the two arrays as its root. Each root is extended to both sides by
   the longest common extension of two places, found from the ranks of blocks of 1, 2, 4 ... words; equal runs meet as one.

Each text is handled where it is read; nothing is shuffled. Time is n log n in the words of a text, memory 4 log n bytes a word
of its longest segment.

Defined results: a text that is null, empty or without words has no words and no runs; a null id is kept; repeated rows give equal
rows each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import ship

Run = tuple[int, int, int]  # start, length, period


def lyndon_lengths(word: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there; ``word`` holds small non-negative numbers."""
    n = len(word)
    top = max(word, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(top)]
    for i, w in enumerate(word):
        members[w].append(i)
    group = list(word)
    length = [1] * top
    below, above = list(range(-1, top - 1)), list(range(1, top + 1))  # neighbours of a group in the order
    lyndon, done = [0] * n, [False] * n
    left = list(range(-1, n - 1))  # a place to the left with nothing but done places between
    g = top - 1
    while g >= 0:
        span = length[g]
        current = [i for i in members[g] if group[i] == g]
        for i in current:
            done[i] = True
            lyndon[i] = span
        counts: dict[int, list[int]] = {}  # how often the group follows a place -> the places
        last, times = -1, 0
        for i in current:
            j = left[i]
            while j >= 0 and done[j]:
                left[i] = j = left[j]
            if j != last:
                if last >= 0:
                    counts.setdefault(times, []).append(last)
                last, times = j, 0
            times += 1
        if last >= 0:
            counts.setdefault(times, []).append(last)
        for times in sorted(counts, reverse=True):
            moved: dict[int, int] = {}  # group -> the group just above it that its members move to
            for j in counts[times]:
                old = group[j]
                new = moved.get(old)
                if new is None:
                    new = moved[old] = len(members)
                    members.append([])
                    length.append(length[old] + times * span)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    if up < len(below):
                        below[up] = new
                members[new].append(j)
                group[j] = new
        members[g] = []
        g = below[g]
    return lyndon


class Extensions:
    """Longest common extensions of pairs of places, by ranks of blocks of 1, 2, 4 ... words."""

    def __init__(self, word: np.ndarray):
        self._ranks = [np.unique(word, return_inverse=True)[1].astype(np.int32)]
        n, width = len(word), 1
        while 2 * width <= n:
            rank = self._ranks[-1]
            pair = rank[: n - 2 * width + 1].astype(np.int64) * (n + 1) + rank[width : n - width + 1]
            values, rank = np.unique(pair, return_inverse=True)
            if len(values) == len(pair):  # no two blocks of this width are equal, nor any wider
                break
            self._ranks.append(rank.astype(np.int32))
            width *= 2
        self._n = n

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal from places ``i`` < ``j`` on."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self._ranks) - 1, -1, -1):
            rank, width = self._ranks[k], 1 << k
            while True:  # the widest blocks may repeat
                fits = np.flatnonzero(j + width <= self._n)
                same = fits[rank[i[fits]] == rank[j[fits]]]
                i[same] += width
                j[same] += width
                total[same] += width
                if k < len(self._ranks) - 1 or not len(same):
                    break
        return total

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal to the left of places ``i`` < ``j``."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self._ranks) - 1, -1, -1):
            rank, width = self._ranks[k], 1 << k
            while True:
                fits = np.flatnonzero(i >= width)
                same = fits[rank[i[fits] - width] == rank[j[fits] - width]]
                i[same] -= width
                j[same] -= width
                total[same] += width
                if k < len(self._ranks) - 1 or not len(same):
                    break
        return total


def segment_runs(word: np.ndarray, times: int, least: int) -> set[Run]:
    """The runs of one sequence of numbers."""
    number = np.unique(word, return_inverse=True)[1]
    found: set[Run] = set()
    reach = Extensions(number)
    place = np.arange(len(number))
    for order in (number, number.max() - number):
        root = np.asarray(lyndon_lengths(order.tolist()))
        open_ = np.flatnonzero(place + root < len(number))
        # neighbours with one period and equal words between them are in one run
        i, q = place[open_], root[open_]
        right = reach.after(i, i + q)
        left = reach.before(i, i + q)
        size = left + q + right
        good = size >= np.maximum(least, times * q)
        found.update(zip((i - left)[good].tolist(), size[good].tolist(), q[good].tolist(), strict=True))
    return found


def _segments(words: list[bytes], times: int, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start and word numbers of the stretches outside which no run can be."""
    if len(words) < least:
        return
    number = {w: k for k, w in enumerate(w for w, c in Counter(words).items() if c >= times)}
    if not number:
        return
    ids = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
    spot = np.flatnonzero(ids >= 0)
    ids = ids[spot]
    while len(spot):
        new = np.empty(len(spot), bool)
        new[0] = True
        np.not_equal(spot[1:], spot[:-1] + 1, out=new[1:])
        segment = np.cumsum(new) - 1
        _, back, count = np.unique(segment * len(number) + ids, return_inverse=True, return_counts=True)
        keep = (count[back] >= times) & (np.bincount(segment)[segment] >= least)
        if keep.all():
            edges = [*np.flatnonzero(new).tolist(), len(spot)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                yield int(spot[low]), ids[low:high]
            return
        spot, ids = spot[keep], ids[keep]


def runs(words: list[bytes], times: int = 4, least: int = 6) -> list[Run]:
    """(start, length, period) of every run, by start, then period. ``times`` is 2 at least."""
    found = [(at + s, n, q) for at, ids in _segments(words, times, least) for s, n, q in segment_runs(ids, times, least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], found: list[Run]) -> bytes:
    """The words but those that stand in a run after its first period, joined by spaces."""
    if not found:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    return b" ".join(words[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist())


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", times: int = 4, least: int = 6, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``runs`` (start, length, period by start, then period) and ``collapsed``.

    Words are stretches without the six ASCII blanks; ``rewrite`` may give other words for a row before runs are looked for.
    """
    ship(docs.sparkSession)
    if times < 2:
        raise ValueError("a run holds its period twice at least")
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, every, texts = [], [], [], []
            size = 0

            def block() -> pa.RecordBatch:
                flat = [r for found in every for r in found]
                offsets = np.concatenate([[0], np.cumsum([len(found) for found in every])]).astype(np.int32)
                columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                values = pa.StructArray.from_arrays(columns, fields=list(RUN))
                listed = pa.ListArray.from_arrays(pa.array(offsets), values)
                arrays = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), listed, pa.array(texts, pa.string())]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            for row in range(len(batch)):
                key = batch.column("id")[row].as_py()
                words = (batch.column("text")[row].as_py() or "").encode().split()
                if rewrite:
                    words = rewrite(key, words)
                found = runs(words, times, least)
                ids.append(key)
                counts.append(len(words))
                every.append(found)
                texts.append(collapse(words, found).decode())
                size += len(texts[-1])
                if size > 16_000_000:
                    yield block()
                    ids, counts, every, texts = [], [], [], []
                    size = 0
            if ids:
                yield block()

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string").withColumnRenamed("id", id)
