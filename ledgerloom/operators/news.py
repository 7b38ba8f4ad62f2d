"""Lookups and links between articles and tickers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.dedup import without_stored
from ledgerloom.operators.joins import BROADCAST_ROWS, is_bounded


def articles_by_ticker(articles: DataFrame, links: DataFrame, ticker: str) -> DataFrame:
    """Articles linked to one ticker, newest first.

    The ticker filter reaches the scan of the links; what remains joins on the
    article id, which is unique per ticker and so evenly spread.
    """
    ids = links.filter(F.col("ticker") == ticker).select("article_id").distinct()
    return articles.join(ids, articles.id == ids.article_id, "left_semi").orderBy(F.desc("published_at"), "id")


def ids_by_url(articles: DataFrame, urls: DataFrame) -> DataFrame:
    """The ids of those urls that are stored."""
    keys = urls.select("url").distinct()
    if is_bounded(keys, BROADCAST_ROWS):
        keys = F.broadcast(keys)
    return articles.join(keys, "url", "left_semi").select("url", "id")


def id_by_url(articles: DataFrame, url: str) -> int | None:
    row = articles.filter(F.col("url") == url).select("id").first()
    return None if row is None else row["id"]


def resolve_links(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Unique (article_id, ticker) pairs of in-flight rows with known tickers.

    A url stored earlier under another ticker still gets its new pair; a url
    without an id is dropped. Pairs are made unique before the join, so repeats
    of a popular url collapse in the map tasks.
    """
    pairs = rows.select("url", F.explode("mentioned_tickers").alias("ticker")).distinct()
    ids = articles.select("url", F.col("id").alias("article_id"))
    return pairs.join(ids, "url").select("article_id", "ticker")


def new_links(links: DataFrame, stored: DataFrame) -> DataFrame:
    return without_stored(links.dropDuplicates(["article_id", "ticker"]), stored, ["article_id", "ticker"])


def tickers_of_articles(links: DataFrame) -> DataFrame:
    """The sorted tickers of each article."""
    return links.groupBy("article_id").agg(F.array_sort(F.collect_set("ticker")).alias("tickers"))


def not_transformed(articles: DataFrame, log: DataFrame, transform_id: str) -> DataFrame:
    """Articles a transform has not been applied to yet."""
    done = log.filter(F.col("transform") == transform_id).select(F.col("article_id").alias("id")).distinct()
    return articles.join(done, "id", "left_anti")
