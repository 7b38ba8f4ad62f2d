"""Parquet tables with a commit log: idempotent batches, several writers, numbers for new rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators.commits import CommitLog
from ledgerloom.operators.dedup import arrival, first_per_key
from ledgerloom.operators.joins import BROADCAST_ROWS
from ledgerloom.operators.keyindex import candidates, lookup, part_of_index, write_index
from ledgerloom.operators.numbering import dense_numbers
from ledgerloom.session import remove, stage

INDEXES = 16  # parts of the key index before small ones are merged
AT_ONCE = 50_000  # rows of a batch whose part of the index is written with it; a larger one is written when a small batch first asks
ROW = "_row"  # names a row of a batch
BATCH = T.StructField("batch_id", T.StringType())


def merged(index: list[dict]) -> list[dict]:
    """The smallest parts as one, with every part that is no larger than those before it together.

    So a part is only merged into one of at least about twice its size, and a key is written again a few times (the logarithm of
    the table), not once for every few batches. The part is written when a batch first asks for it.
    """
    parts = sorted(index, key=lambda e: e["rows"])
    taken, rows = 2, parts[0]["rows"] + parts[1]["rows"]
    while taken < len(parts) and parts[taken]["rows"] <= rows:
        rows += parts[taken]["rows"]
        taken += 1
    return [*parts[taken:], part_of_index(uuid.uuid4().hex, [f for e in parts[:taken] for f in e["of"]], rows)]


class BatchStore:
    """A table whose rows are unique on ``keys``.

    A batch is written to a folder of its own and becomes part of the table by a commit that lists the folder. A batch that
    failed is listed nowhere; one that was committed is not written again, so repeating it adds nothing. Writers that commit at
    the same time are put in order: the one that comes second compares its keys again, with what the first one added.
    Readers keep the folders of the version they started with.

    With ``id`` the table numbers its rows in that column: 1, 2, ... in the order rows arrive, never used twice.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], id: str | None = None):
        self.spark = spark
        self.path = path
        self.keys = keys
        self.id = id
        self.columns = schema.fieldNames()
        numbered = [T.StructField(id, T.LongType())] if id else []
        self.schema = T.StructType(numbered + schema.fields + [BATCH])
        self._index = T.StructType(numbered + [schema[k] for k in keys])
        self._log = CommitLog(spark, f"{path}/_commits")

    def versions(self) -> list[int]:
        return self._log.versions()

    def batches(self) -> dict[str, int]:
        """The batches the table is made of, and their rows."""
        return {b["name"]: b["rows"] for b in self._log.read()[1]["batches"]}

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one that is still known."""
        state = self._log.read(version)[1]
        folders = [f"{self.path}/data/{b['folder']}" for b in state["batches"] if b["rows"]]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def known(self, rows: DataFrame) -> DataFrame:
        """Stored keys (and ids) among the keys of ``rows``; reads the buckets of the key index that may hold one."""
        batch = stage(rows.select(*self.keys).distinct(), "known-keys")
        return self._lookup(batch, self._log.read()[1])

    def _lookup(self, batch: DataFrame, state: dict) -> DataFrame:
        return lookup(batch, self.keys, self._index, self.path, self._parts(state))

    def _parts(self, state: dict) -> list[dict]:
        """The parts of the key index; tables of before say nothing of what a part is made of, and get one for all."""
        index = state.get("index", [])
        if all("of" in e for e in index):
            return index
        held = [b for b in state["batches"] if b["rows"]]
        name = uuid.uuid5(uuid.NAMESPACE_OID, ",".join(b["folder"] for b in held)).hex  # the same until the next commit
        return [part_of_index(name, [b["folder"] for b in held], sum(b["rows"] for b in held))]

    def _write(self, rows: DataFrame, batch_id: str) -> dict:
        """Write a batch, and its index if it is small; returns its entry in the commit."""
        folder = uuid.uuid4().hex
        named = rows.select(*([self.id] if self.id else []), *self.columns, F.lit(batch_id).alias("batch_id"))
        named.write.parquet(f"{self.path}/data/{folder}")
        # counted from the file footers of what was really written
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{folder}")
        count = written.count()
        index = part_of_index(folder, [folder], count) if count else None
        if 0 < count <= AT_ONCE:
            write_index(self.spark, self.keys, self._index, self.path, index)
        return {"name": batch_id, "folder": folder, "rows": count, "index": index}

    def _commit(self, version: int, state: dict, batches: list[dict], index: list[dict], added: int) -> bool:
        if len(index) > INDEXES:
            index = merged(index)
        content = {"batches": batches, "index": index, "next_id": state["next_id"] + added}
        return self._log.commit(version + 1, content)

    def insert(self, rows: DataFrame, batch_id: str, seq: str | None = None, dry_run: bool = False) -> int:
        """Insert the rows whose key is new and return how many there were.

        Of rows with the same key the one that arrived first (``seq``, rows without one last, then a hash of the row) is the one
        that counts. Only keys are grouped, looked up in the key index and numbered; the winners, unique by construction, pick
        their rows. The input is evaluated once, when it is written with a number for each row. Rows with a ``ROW`` column, a
        name for each row, are stored already and are read where they are; of a table of keys alone only the keys are written.
        """
        done = self.batches().get(batch_id)
        if done is not None and not dry_run:
            return done
        names = list(dict.fromkeys([*self.columns, *([seq] if seq else [])]))
        bare = not self.id and set(names) <= set(self.keys)
        if bare:
            first = rows.select(*self.keys).distinct()
        else:
            if ROW not in rows.columns:
                rows = stage(rows.select(*names).withColumn(ROW, F.monotonically_increasing_id()), "insert")
            rows = rows.select(*names, ROW)
            order = F.struct(arrival(names, seq).alias("arrival"), F.col(ROW))
            late = [F.col("_first.arrival.missing").alias("_late"), F.col("_first.arrival.seq").alias("_seq")] if seq else []
            first = rows.groupBy(*self.keys).agg(F.min(order).alias("_first")).select(*self.keys, f"_first.{ROW}", *late)
        first = stage(first, "insert-keys")
        while True:
            version, state = self._log.read()
            done = {b["name"]: b["rows"] for b in state["batches"]}.get(batch_id)
            if done is not None and not dry_run:
                return done  # another writer of the same batch
            known = candidates(first, self.keys, self._index, self.path, self._parts(state))
            winners = first if known is None else first.join(known.select(*self.keys), self.keys, "left_anti")
            if dry_run:
                return winners.count()
            if self.id:
                winners = dense_numbers(winners.drop(*self.keys), self.id, *(["_late", "_seq"] if seq else []), ROW, first=state["next_id"])
            elif known is not None and not bare:
                winners = stage(winners, "insert-new")
            entry = {"name": batch_id, "folder": uuid.uuid4().hex, "rows": 0, "index": None}
            if bare:
                entry = self._write(winners, batch_id)
                if not entry["rows"]:
                    self._drop(entry["folder"])
            elif count := winners.count():
                # the winners' names are the small side, so that whole rows are not sorted
                names_of = winners.select(ROW, *([self.id] if self.id else []))
                small = F.broadcast(names_of) if count <= BROADCAST_ROWS else names_of.hint("shuffle_hash")
                entry = self._write(rows.join(small, ROW), batch_id)
            index = self._parts(state) + ([entry["index"]] if entry["rows"] else [])
            entry.pop("index")
            if self._commit(version, state, [*state["batches"], entry], index, entry["rows"]):
                return entry["rows"]
            self._drop(entry["folder"])

    def truncate_and_load(self, rows: DataFrame, batch_id: str) -> None:
        """Replace the whole content; of rows with the same key the first counts.

        The new batch is complete before it is listed, so a load that fails leaves the old content as it was, and a reader sees
        the old content or the new. Old folders stay for readers until ``vacuum``.
        """
        rows = stage(first_per_key(rows.select(*self.columns), self.keys, None), "load")
        while True:
            version, state = self._log.read()
            named = dense_numbers(rows, self.id, *self.keys, first=state["next_id"]) if self.id else rows
            entry = self._write(named, batch_id)
            index = entry.pop("index")
            if self._commit(version, state, [entry], [index] if index else [], entry["rows"]):
                return
            self._drop(entry["folder"])

    def _drop(self, folder: str) -> None:
        remove(self.spark, f"{self.path}/data/{folder}")
        remove(self.spark, f"{self.path}/index/{folder}")

    def vacuum(self, hours: float = 24.0) -> int:
        """Delete folders that no known version lists and that are older than any job still running; returns how many."""
        used = set()
        for version in self.versions():
            state = self._log.read(version)[1]
            used |= {b["folder"] for b in state["batches"]} | {e["folder"] for e in state.get("index", [])}
        gone = 0
        for part in ("data", "index"):
            top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
            files = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
            now = self.spark._jvm.System.currentTimeMillis()
            for status in files.listStatus(top) if files.exists(top) else []:
                if status.getPath().getName() not in used and now - status.getModificationTime() >= hours * 3_600_000:
                    files.delete(status.getPath(), True)
                    gone += 1
        return gone

    def seed_if_empty(self, rows: DataFrame) -> bool:
        """Write ``rows`` only when the table holds none."""
        if any(self.batches().values()):
            return False
        self.truncate_and_load(rows, "seed")
        return True
