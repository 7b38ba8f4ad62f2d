"""Every registered query against its check SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


OWN = [name for name in entry.queries() if not name.startswith("op") and name != "pipeline"]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    result = entry.queries()[name](spark, FOLDER)
    assert differences(result, con, entry.oracle_sql()[name]) is None
    plan = result._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_brand,Brand#17)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_scoring_shuffles_one_row_per_text(spark):
    """The only exchange of a scoring plan carries the sums of the map tasks."""
    from ledgerloom.operators import sentiment

    rows = [(1, "good film", "pos"), (2, "bad film", "neg")]
    train = spark.createDataFrame(rows, "id int, text string, label string")
    plan = sentiment.fit(train, "id", min_df=1).score(train, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan.split("Exchange hashpartitioning")[1]


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "title", "publisher", "published_at"]


@pytest.mark.parametrize("name", ["article_sources", "feed_articles", "rss_articles"])
def test_pages_that_share_a_url_stay(spark, path, name):
    """Two pages of one url are two articles, as the SQL has it."""
    from pyspark.sql import functions as F

    for table in ("documents", "orders", "customer"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(20).coalesce(1).write.parquet(f"{path}/{table}.parquet")
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").filter("page_id < 20")
    pages.withColumn("url", F.when(F.col("page_id") < 6, F.lit("https://a.example.com/x?p=1&q=2#top")).otherwise(F.col("url"))).coalesce(1).write.parquet(f"{path}/pages.parquet")
    got = entry.queries()[name](spark, path)
    con = _views(path, "documents", "orders", "customer", "pages")
    assert differences(got, con, entry.oracle_sql()[name]) is None


def _views(path, *names):
    import duckdb

    con = duckdb.connect()
    for name in names:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path.removeprefix('file:')}/{name}.parquet/*.parquet')")
    return con
