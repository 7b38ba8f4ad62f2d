"""Transforms over stored articles, each with its own output table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.news import not_transformed

Transform = Callable[[DataFrame], DataFrame]
_VERSIONS = "transform string, n long, full boolean, version string"


class TransformRunner:
    """Runs registered transforms; each reads the article table on its own.

    A transform is a pure function from articles (with an ``id``) to an output
    table. Every run writes a version of its own, with the ids it read, and lists it
    only when all of it is written: a run that fails leaves the output as it was. A
    full run replaces what came before, a run over new articles adds to it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._transforms: dict[str, tuple[Transform, Callable[[DataFrame, str], object] | None]] = {}
        spark.createDataFrame([], _VERSIONS).write.mode("ignore").parquet(f"{path}/_versions")

    def add(
        self, transform_id: str, transform: Transform, then: Callable[[DataFrame, str], object] | None = None
    ) -> "TransformRunner":
        """``then`` gets the written output and its version, before the version is listed: to store links, say."""
        self._transforms[transform_id] = (transform, then)
        return self

    def _versions(self, transform_id: str) -> list:
        """The versions that make up the output, one row per run since the last full one."""
        rows = self.spark.read.schema(_VERSIONS).parquet(f"{self.path}/_versions").filter(F.col("transform") == transform_id)
        listed = sorted(rows.collect(), key=lambda r: r["n"])
        last_full = max((k for k, r in enumerate(listed) if r["full"]), default=0)
        return listed[last_full:]

    def _folders(self, transform_id: str, part: str) -> list[str]:
        return [f"{self.path}/{transform_id}/{r['version']}/{part}" for r in self._versions(transform_id)]

    def output(self, transform_id: str) -> DataFrame:
        folders = self._folders(transform_id, "rows")
        if not folders:
            raise KeyError(f"no output of {transform_id}")
        return self.spark.read.parquet(*folders)

    def log(self, transform_id: str) -> DataFrame | None:
        """(article_id, transform) of the articles that are in the output; None before the first run."""
        folders = self._folders(transform_id, "log")
        return self.spark.read.parquet(*folders) if folders else None

    def run(
        self, articles: DataFrame, only: str | None = None, log: DataFrame | None = None, incremental: bool = False
    ) -> dict[str, str]:
        """Apply all transforms, or one; an error in one does not stop the rest.

        With a ``log`` of (article_id, transform), or ``incremental`` for the log of
        earlier runs, only articles that are not in it are read and the output is
        added to. Returns ``ok`` or the error per transform.
        """
        if only is not None and only not in self._transforms:
            raise KeyError(f"unknown transform: {only}")
        outcome = {}
        for name in [only] if only else list(self._transforms):
            try:
                done = log if log is not None else self.log(name) if incremental else None
                self._run(name, articles if done is None else not_transformed(articles, done, name), done is None)
                outcome[name] = "ok"
            except Exception as error:  # noqa: BLE001 - reported, and the next one runs
                outcome[name] = f"failed: {str(error).splitlines()[0]}"
        return outcome

    def _run(self, name: str, rows: DataFrame, full: bool) -> None:
        transform, then = self._transforms[name]
        version = uuid.uuid4().hex
        folder = f"{self.path}/{name}/{version}"
        rows.transform(transform).write.parquet(f"{folder}/rows")
        self.log_rows(rows, name).write.parquet(f"{folder}/log")
        if then is not None:
            then(self.spark.read.parquet(f"{folder}/rows"), version)
        n = max((r["n"] for r in self._versions(name)), default=0) + 1
        listed = self.spark.range(1).select(
            F.lit(name).alias("transform"), F.lit(n).cast("long").alias("n"), F.lit(full).alias("full"), F.lit(version).alias("version")
        )
        listed.write.mode("append").parquet(f"{self.path}/_versions")

    def log_rows(self, articles: DataFrame, transform_id: str) -> DataFrame:
        """What a run adds to the transform log."""
        return articles.select(F.col("id").alias("article_id"), F.lit(transform_id).alias("transform"))
