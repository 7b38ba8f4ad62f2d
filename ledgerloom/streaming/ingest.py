"""Incremental ingestion of landed article files."""

from __future__ import annotations

from concurrent.futures import Future
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import schemas
from ledgerloom.functions.text import or_null
from ledgerloom.operators.dedup import bounded_stream_dedup
from ledgerloom.operators.news import resolve_links
from ledgerloom.operators.store import ROW, BatchStore
from ledgerloom.session import stage
from ledgerloom.sources.articles import quarantine

@dataclass
class NewsWarehouse:
    """The article, link and quarantine tables under one folder.

    Articles are numbered by the table (``id``) and stamped with the time they came (``fetched_at``); a link is an article's
    number and a ticker.
    """

    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        self.articles = BatchStore(self.spark, f"{self.path}/articles", schemas.ARTICLES.schema, ["url"], id="id")
        self.links = BatchStore(self.spark, f"{self.path}/links", schemas.ARTICLE_TICKERS.schema, ["article_id", "ticker"])

    def ingest(self, rows: DataFrame, batch_id: str) -> int:
        """Store the new articles and links of one batch.

        A repeated batch id adds nothing, whichever table a failure came before. The batch is written once with a number for each
        row and read for each table; one whose rows have names (``ROW``) is stored already, and is read where it is. Numbers of
        articles that were stored before are looked up by the batch's own urls.
        """
        if ROW not in rows.columns:
            rows = stage(rows.withColumn(ROW, F.monotonically_increasing_id()), "batch")
        good, bad = quarantine(rows)
        bad.drop(ROW).write.mode("overwrite").parquet(f"{self.path}/quarantine/batch_id={batch_id}")
        stamped = good.withColumn("fetched_at", F.current_timestamp().cast("timestamp_ntz"))
        inserted = self.articles.insert(stamped, batch_id, seq="seq")
        linked = good.filter(F.size("mentioned_tickers") > 0)
        self.links.insert(resolve_links(linked, self.articles.known(linked)), batch_id)
        return inserted


def stream_ingest(
    spark: SparkSession,
    landing: str,
    warehouse: NewsWarehouse,
    checkpoint: str,
    max_files: int | None = None,
    dedup_within: str | None = None,
) -> dict[str, int]:
    """Ingest the files that arrived since the last run, then stop; returns how many rows came, were repeats, and were late.

    With ``dedup_within`` (an interval) the stream itself drops repeats of a url that arrive within it, before a batch is written:
    its state is bounded by a watermark over the time of arrival, so no row is late. What the state has forgotten the
    table still knows. Rows without a url are repeats only of rows equal to them.

    The checkpoint remembers the files and the stream's own id. A batch is named
    by that id and its number, so a replayed micro-batch replaces its own rows and
    no other stream's; a stream with a new checkpoint has a new id.
    """
    reader = spark.readStream.schema(schemas.ARTICLE_ROW)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    started: Future[str] = Future()  # the first batch may come before start() returns
    # a landed file stays, so its rows are read again by their places instead of written
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    rows = reader.parquet(landing) if dedup_within else reader.parquet(landing).withColumn(ROW, place)
    if dedup_within:
        own = F.concat(F.lit("?"), F.xxhash64(*schemas.ARTICLE_ROW.fieldNames()).cast("string"))
        marked = rows.withColumn("_key", F.coalesce(or_null("url"), own)).withColumn("_at", F.current_timestamp())
        rows = bounded_stream_dedup(marked, "_key", "_at", dedup_within).drop("_key", "_at")
    query = (
        rows.writeStream.foreachBatch(lambda rows, n: _ingest_batch(warehouse, rows, f"{started.result()}-{n}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set_result(query.id)
    query.awaitTermination()
    progress = query.recentProgress
    states = [s for p in progress for s in p["stateOperators"]]
    return {
        "rows": sum(p["numInputRows"] for p in progress),
        "repeats": sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in states),
        "late": sum(s["numRowsDroppedByWatermark"] for s in states),
    }


def _ingest_batch(warehouse: NewsWarehouse, rows: DataFrame, name: str) -> None:
    warehouse.ingest(rows, f"stream-{name}")
