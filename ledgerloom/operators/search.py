"""Keyword, full-text and TF-IDF search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.text import STOPWORDS, match_count, unnest, with_term_counts, word_tokens
from ledgerloom.operators.joins import BROADCAST_ROWS, HOT_SHARE, is_bounded, salted_join
from ledgerloom.session import stage


def keyword_search(
    docs: DataFrame, query: str, regex: bool = False, text: str = "text", key: str = "doc_id", top: int | None = None
) -> DataFrame:
    """Rows whose text contains the query in any case, most matches first.

    An empty query finds nothing.
    """
    if not query:
        return docs.withColumn("matches", F.lit(0)).limit(0)
    found = docs.withColumn("matches", match_count(text, query, regex)).filter(F.col("matches") > 0)
    ordered = found.orderBy(F.desc("matches"), F.col(key))
    return ordered if top is None else ordered.limit(top)


def inverted_index(
    docs: DataFrame, text: Column, key: str = "doc_id", stopwords: list[str] | None = STOPWORDS
) -> DataFrame:
    """Postings ``(term, key, tf)``. Terms are counted inside each row."""
    counted = with_term_counts(docs.select(key, text.alias("_text")), word_tokens("_text", stopwords), without="_text")
    return unnest(counted, [key], F.col("terms"), "x").select("x.term", key, "x.tf")


def fulltext_search(
    index: DataFrame, terms: list[str], key: str = "doc_id", stopwords: list[str] | None = STOPWORDS
) -> DataFrame:
    """Documents holding every term, with how often they hold them.

    Terms are cut as the index cuts texts, so stop words and marks of the query
    ask for nothing; without any other term nothing is found. Only the postings
    of the terms are read; they join nothing.
    """
    asked = index.sparkSession.range(1).select(F.explode(word_tokens(F.lit(" ".join(terms)), stopwords)).alias("term"))
    wanted = sorted({r["term"] for r in asked.collect()})  # a handful of words
    if not wanted:
        return index.groupBy(key).agg(F.sum("tf").alias("hits")).limit(0)
    return (
        index.filter(F.col("term").isin(wanted))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("hits"))
        .filter(F.col("n_terms") == len(wanted))
        .select(key, "hits")
    )


def tfidf_scores(
    docs: DataFrame, query: str, text: str = "text", key: str = "doc_id", stopwords: list[str] | None = STOPWORDS
) -> DataFrame:
    """Cosine of every document with the query; zero where they share no term.

    Smooth inverse document frequency, raw term counts, unit length vectors.
    The term statistics are written out first: a small vocabulary is broadcast,
    so no posting is shuffled; a large one is joined with its hot terms salted.
    """
    spark = docs.sparkSession
    counted = with_term_counts(docs.select(key, text), word_tokens(text, stopwords), without=text)
    # Read three times below; cheaper to keep than to tokenize again.
    counted = stage(counted, "term-counts")
    postings = unnest(counted, [key], F.col("terms"), "x").select(key, "x.term", "x.tf")
    n_docs = counted.agg(F.count(F.lit(1)).alias("n"))
    stats = stage(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")
    idf = (F.ln((F.lit(1.0) + n_docs.scalar()) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf")
    weights = stage(stats.select("term", "df", idf), "idf")

    asked = (
        spark.range(1)
        .select(F.explode(word_tokens(F.lit(query), stopwords)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    # The query has a handful of terms.
    asked = weights.join(F.broadcast(asked), "term").select("term", (F.col("qtf") * F.col("idf")).alias("qw"))
    norm = F.sqrt(asked.agg(F.sum(F.col("qw") * F.col("qw"))).scalar())

    if is_bounded(weights, BROADCAST_ROWS):
        # A document without any term keeps one row here, with a null term.
        every = counted.select(key, F.inline_outer("terms"))
        joined = every.join(F.broadcast(weights), "term", "left")
    else:
        hot = weights.filter(F.col("df") * HOT_SHARE > weights.agg(F.sum("df")).scalar())
        found = salted_join(postings, weights, "term", key, hot)
        joined = found.unionByName(counted.select(key), allowMissingColumns=True)
    w = F.col("tf") * F.col("idf")
    vectors = joined.join(F.broadcast(asked), "term", "left").groupBy(key).agg(
        F.sum(w * w).alias("square"), F.sum(w * F.coalesce("qw", F.lit(0.0))).alias("dot")
    )
    cosine = F.coalesce(F.try_divide(F.col("dot"), F.sqrt("square") * norm), F.lit(0.0))
    return vectors.select(key, cosine.alias("score"))


def tfidf_search(
    docs: DataFrame,
    query: str,
    top: int = 50,
    text: str = "text",
    key: str = "doc_id",
    stopwords: list[str] | None = STOPWORDS,
) -> DataFrame:
    """The ``top`` documents by cosine; zero scores fill up a short list."""
    return tfidf_scores(docs, query, text, key, stopwords).orderBy(F.desc("score"), F.col(key)).limit(top)


def export_csv(rows: DataFrame, path: str) -> None:
    """Write a result as CSV with a header."""
    rows.write.option("header", True).option("escape", '"').csv(path)
