from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators.dedup import bounded_stream_dedup
from ledgerloom.session import fresh_dir
from ledgerloom.sources.articles import conform
from ledgerloom.streaming.ingest import NewsWarehouse, stream_ingest
from ledgerloom.streaming.transforms import TransformRunner

START = datetime(2024, 1, 1)


def batch(spark, rows):
    made = [
        (u, f"t{i}", None, None, "s", None, None if late else START + timedelta(minutes=i), tickers, i)
        for i, (u, tickers, late) in enumerate(rows)
    ]
    return spark.createDataFrame(made, schemas.ARTICLE_ROW)


ROWS = [("u1", ["A"], False), ("u2", [], False), ("u1", ["B"], False), ("u3", ["C"], True)]
MORE = [("u1", ["D"], False), ("u4", ["A", "E"], False), ("", ["Z"], False)]


def state(w):
    return (
        {(r["url"], r["title"]) for r in w.articles.read().collect()},
        {(r["url"], r["ticker"]) for r in w.links.read().join(w.articles.read(), F.col("article_id") == F.col("id")).collect()},
    )


WANT = ({("u1", "t0"), ("u2", "t1"), ("u4", "t1")}, {("u1", t) for t in "ABD"} | {("u4", "A"), ("u4", "E")})


def test_batch_ingest_and_replay(spark, path):
    w = NewsWarehouse(spark, path)
    assert w.ingest(batch(spark, ROWS), "0") == 2
    assert w.ingest(batch(spark, ROWS), "0") == 2
    assert w.ingest(batch(spark, MORE), "1") == 1
    assert w.ingest(batch(spark, ROWS), "2") == 0
    assert state(w) == WANT
    bad = spark.read.parquet(f"{path}/quarantine")
    assert sorted(r["reason"] for r in bad.filter("batch_id IN ('0', '1')").collect()) == ["no date", "no url"]


def test_stream_equals_batch(spark, path):
    w = NewsWarehouse(spark, path)
    landing, offsets = fresh_dir(spark, "landing"), fresh_dir(spark, "offsets")
    for rows in (ROWS, MORE, ROWS):
        batch(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        stream_ingest(spark, landing, w, offsets, max_files=1)
    stream_ingest(spark, landing, w, offsets)
    assert state(w) == WANT


def test_bounded_stream_dedup(spark, path):
    conform(batch(spark, ROWS[:3])).withColumn("published_at", F.col("published_at").cast("timestamp")).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    query = (
        bounded_stream_dedup(stream, "url", "published_at", "1 hour")
        .writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r["url"] for r in spark.table("deduped").collect()) == ["u1", "u2"]


def test_transforms(spark, path):
    articles = spark.createDataFrame([(1, "x"), (2, "y")], "id long, content string")

    def broken(rows):
        return rows.select(F.raise_error(F.lit("no")).alias("x"))

    runner = TransformRunner(spark, path).add("a", lambda d: d.select("id")).add("b", broken).add("c", lambda d: d)
    outcome = runner.run(articles)
    assert outcome["a"] == outcome["c"] == "ok" and outcome["b"].startswith("failed")
    assert runner.output("a").count() == 2
    with pytest.raises(KeyError):
        runner.run(articles, only="zzz")
    more = articles.unionByName(spark.createDataFrame([(3, "z")], articles.schema))
    assert runner.run(more, only="a", incremental=True) == {"a": "ok"}
    assert sorted(r["id"] for r in runner.output("a").collect()) == [1, 2, 3]
    assert sorted(r["article_id"] for r in runner.log("a").collect()) == [1, 2, 3]
    assert runner.run(more, only="a", log=runner.log_rows(more, "a")) == {"a": "ok"}
    assert runner.output("a").count() == 3 and runner.output("c").count() == 2


def test_failed_run_keeps_the_output(spark, path):
    articles = spark.createDataFrame([(1, "x"), (2, "y")], "id long, content string")
    TransformRunner(spark, path).add("a", lambda d: d.select("id")).run(articles)
    broken = TransformRunner(spark, path).add("a", lambda d: d.select(F.raise_error(F.lit("no")).alias("id")))
    assert broken.run(articles)["a"].startswith("failed")
    assert sorted(r["id"] for r in broken.output("a").collect()) == [1, 2]


def test_two_streams_and_a_new_checkpoint_lose_and_repeat_nothing(spark, path):
    w = NewsWarehouse(spark, path)
    one, two, offsets = (fresh_dir(spark, n) for n in ("landing", "landing", "offsets"))
    batch(spark, ROWS).write.parquet(one)
    batch(spark, MORE).write.parquet(two)
    stream_ingest(spark, one, w, offsets)
    stream_ingest(spark, two, w, fresh_dir(spark, "offsets"))
    stream_ingest(spark, one, w, fresh_dir(spark, "offsets"))
    assert state(w) == WANT
    assert w.articles.read().groupBy("url").count().filter("count > 1").isEmpty()


def test_landed_rows_are_not_written_twice(spark, path):
    """A stream's rows are read where they landed: nothing but keys and new rows is written, and copies of a file count once."""
    import os

    from pyspark.sql import functions as F

    from ledgerloom.session import scratch_root
    from ledgerloom.sources import articles

    def staged():
        return {f for f in os.listdir(scratch_root(spark).removeprefix("file:")) if f.startswith(("batch-", "insert-")) and not f.startswith(("insert-keys", "insert-new"))}

    rows = articles.conform(spark.range(40).select(
        F.concat(F.lit("u"), (F.col("id") % 30).cast("string")).alias("url"), F.col("id").cast("string").alias("title"), F.lit("text").alias("content"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published_at"), F.array(F.lit("A")).alias("mentioned_tickers"), F.col("id").alias("seq"),
    ))
    warehouse = NewsWarehouse(spark, f"{path}/news")
    before = staged()
    for _ in range(2):
        rows.repartition(3).write.mode("append").parquet(f"{path}/landing")
        stream_ingest(spark, f"{path}/landing", warehouse, f"{path}/offsets")
    assert staged() == before
    got = sorted((r["id"], r["url"], r["title"]) for r in warehouse.articles.read().collect())
    assert got == [(k + 1, f"u{k}", str(k)) for k in range(30)]
    assert warehouse.links.read().count() == 30


def test_a_batch_that_fills_the_buckets_asks_no_filter(spark, path, monkeypatch):
    from pyspark.sql import types as T

    from ledgerloom.operators import keyindex
    from ledgerloom.operators.store import BatchStore

    store = BatchStore(spark, f"{path}/links", T.StructType.fromDDL("a long, b string"), ["a", "b"])
    pairs = lambda lo, hi: spark.range(lo, hi).selectExpr("id AS a", "cast(id % 7 AS string) AS b")
    assert store.insert(pairs(0, 3000).unionByName(pairs(0, 10)), "first") == 3000
    assert store.known(pairs(2995, 3005)).count() == 5  # by the filters
    monkeypatch.setattr(keyindex, "opened", lambda *a: 1 / 0)
    assert store.insert(pairs(1000, 5000), "second") == 2000
    assert store.read().distinct().count() == store.read().count() == 5000
