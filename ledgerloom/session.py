"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on: adaptive re-planning splits skewed
# join partitions and merges small ones, and times are UTC.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TEXT_ROWS = 2000  # rows of an Arrow batch of texts

_ROOTS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else by ``set_scratch``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _ROOTS.get(spark.sparkContext.applicationId)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def set_scratch(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a session that was built without ``spark.checkpoint.dir``."""
    _ROOTS[spark.sparkContext.applicationId] = folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that nothing has been written to yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give heavy work per row at least one partition per core.

    A small table in a few files would otherwise be parsed by a few tasks. An
    input with enough partitions is returned as it is; ``key`` must be spread
    evenly (an id).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the true size of the result. The shuffle files of the write, which
    nothing else reads, go when it ends, not when the driver collects garbage.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Give Python tasks whole texts by TEXT_ROWS: the JVM and the worker each hold a batch, and some copies of it.

    The setting stays with the session, because results are read after the call that plans them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(TEXT_ROWS, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
