"""Text sentiment: vocabulary, TF-IDF, multinomial naive Bayes, evaluation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom.functions.text import unnest, with_clean_term_counts
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.numbering import dense_numbers
from ledgerloom.session import stage

MIN_DF = 3
MAX_FEATURES = 6000


def stars_label(stars: str = "stars") -> Column:
    """Review stars to a class."""
    return F.when(F.col(stars) > 2, "pos").otherwise("neg")


def compound_label(score: str) -> Column:
    return F.when(F.col(score) > 0, "pos").otherwise("neg")


def clear_ratings(df: DataFrame, stars: str = "stars") -> DataFrame:
    """Drop the middle ratings."""
    return df.filter((F.col(stars) > 4) | (F.col(stars) < 3))


def train_part(key: str, share: float) -> Column:
    """True for about ``share`` of the rows, the same rows on every run."""
    cut = format(int(share * 65536), "04x")
    return F.substring(F.md5(F.col(key).cast("string")), 1, 4) < cut


def word_freq(tokens: DataFrame, label: str = "label") -> DataFrame:
    """Word counts per class of a table with a ``tokens`` array."""
    words = unnest(tokens, [label], F.col("tokens"), "word")
    return words.groupBy(label, "word").agg(F.count(F.lit(1)).alias("n"))


def exclusive_words(freq: DataFrame, label: str = "label") -> DataFrame:
    """Words that occur in one class only."""
    per_word = freq.groupBy("word").agg(F.min(label).alias("lo"), F.max(label).alias("hi"), F.sum("n").alias("n"))
    return per_word.filter("lo = hi").select(F.col("lo").alias(label), "word", "n")


def vocabulary(
    docs: DataFrame, text: str = "text", min_df: int = MIN_DF, max_features: int | None = None
) -> DataFrame:
    """Terms in ``min_df`` texts or more; with ``max_features``, the most frequent ones.

    ``term_index`` is the alphabetical position. Terms are counted inside each
    row, so only (term, counts) is shuffled.
    """
    counted = with_clean_term_counts(docs.select(F.coalesce(text, F.lit("")).alias("_text")), "_text")
    counts = (
        unnest(counted, [], F.col("terms"), "x")
        .groupBy("x.term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("x.tf").alias("freq"))
    )
    return _choose(counts, min_df, max_features)


def _choose(counts: DataFrame, min_df: int, max_features: int | None) -> DataFrame:
    kept = counts.filter(F.col("df") >= min_df)
    if max_features is None:
        return dense_numbers(kept, "term_index", "term", first=0).withColumn("term_index", F.col("term_index").cast("int"))
    # a bounded number of terms
    kept = kept.orderBy(F.desc("freq"), "term").limit(max_features)
    return kept.withColumn("term_index", F.row_number().over(Window.orderBy("term")) - 1)


@dataclass
class SentimentModel:
    """A fitted classifier: one row per term and the log odds of the classes.

    ``log_ratio`` is ln P(term|pos) - ln P(term|neg).
    """

    terms: DataFrame
    prior: float

    def predict(self, df: DataFrame, key: str, text: str = "text") -> DataFrame:
        """``key``, ``p_pos`` (full precision), ``prediction`` and ``known`` (has text).

        ``key`` must be unique. Terms are counted inside each row and meet the
        broadcast model there; after the map-side sums one small row per text is
        shuffled.
        """
        known = F.coalesce(F.trim(text) != "", F.lit(False))
        counted = with_clean_term_counts(df.select(key, known.alias("known"), F.coalesce(text, F.lit("")).alias("_text")), "_text")
        postings = counted.select(key, "known", F.explode_outer("terms").alias("x")).select(
            key, "known", "x.term", "x.tf"
        )
        w = F.col("tf") * F.col("idf")
        sums = (
            lookup_join(postings, self.terms.select("term", "idf", "log_ratio"), "term", key, "left")
            .groupBy(key, "known")
            .agg(F.sum(w * F.col("log_ratio")).alias("dot"), F.sum(w * w).alias("square"))
        )
        odds = F.lit(self.prior) + F.coalesce(F.try_divide(F.col("dot"), F.sqrt("square")), F.lit(0.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
        return sums.select(key, "known", p.alias("p_pos")).withColumn(
            "prediction", F.when(F.col("p_pos") > 0.5, "pos").otherwise("neg")
        )

    def score(self, df: DataFrame, key: str, text: str = "text") -> DataFrame:
        """``key`` and ``sentiment_score``: three decimals, half to even; no text, no score."""
        return self.predict(df, key, text).select(
            key, F.when(F.col("known"), F.bround("p_pos", 3)).alias("sentiment_score")
        )

    def vocabulary(self) -> DataFrame:
        return self.terms.select("term", "term_index")

    def save(self, path: str) -> None:
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        prior = self.terms.sparkSession.createDataFrame([(self.prior,)], "prior double")
        prior.write.mode("overwrite").parquet(f"{path}/prior")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SentimentModel":
        return SentimentModel(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/prior").first()[0])


def fit(
    train: DataFrame,
    key: str,
    text: str = "text",
    label: str = "label",
    min_df: int = MIN_DF,
    max_features: int | None = None,
) -> SentimentModel:
    """Bag of words, smooth TF-IDF of unit length, multinomial naive Bayes.

    Smoothing of one count per term; the class odds are the plain shares.
    """
    rows = train.select(key, (F.col(label) == "pos").alias("pos"), F.coalesce(text, F.lit("")).alias("_text"))
    counted = stage(with_clean_term_counts(rows, "_text"), "train-counts")
    n, n_pos = counted.agg(F.count(F.lit(1)), F.count_if("pos")).first()
    postings = unnest(counted, [key, "pos"], F.col("terms"), "x").select(key, "pos", "x.term", "x.tf")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("freq"))
    idf = F.ln(F.lit(n + 1.0) / (F.col("df") + 1)) + 1
    terms = stage(_choose(counts, min_df, max_features).withColumn("idf", idf), "vocabulary")
    if n_pos in (0, n) or terms.isEmpty():
        raise ValueError("training needs rows of both classes and a vocabulary")
    weighted = lookup_join(postings, terms.select("term", "idf"), "term", key).withColumn(
        "w", F.col("tf") * F.col("idf")
    )
    # One number per text, summed in the map tasks first, goes back to the texts, not to their terms.
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scaled = unnest(counted.join(norms, key), [key, "pos", "norm"], F.col("terms"), "x").select(key, "pos", "norm", "x.term", "x.tf")
    unit = lookup_join(scaled, terms.select("term", "idf"), "term", key).withColumn("u", F.col("tf") * F.col("idf") / F.col("norm"))
    zero = F.lit(0.0)
    sums = stage(
        unit.groupBy("term").agg(
            F.sum(F.when(F.col("pos"), F.col("u")).otherwise(zero)).alias("s_pos"),
            F.sum(F.when(F.col("pos"), zero).otherwise(F.col("u"))).alias("s_neg"),
        ),
        "class-sums",
    )
    size, t_pos, t_neg = sums.agg(F.count(F.lit(1)), F.sum("s_pos"), F.sum("s_neg")).first()
    log_ratio = (
        F.ln((F.col("s_pos") + 1) / F.lit(t_pos + size)) - F.ln((F.col("s_neg") + 1) / F.lit(t_neg + size))
    )
    fitted = terms.join(sums, "term").select("term", "term_index", "idf", log_ratio.alias("log_ratio"))
    return SentimentModel(stage(fitted, "model"), math.log(n_pos / (n - n_pos)))


def keyword_sentiment(hits: DataFrame) -> DataFrame:
    """Mean score of the hits of each keyword, in percent; no hit, no value."""
    return hits.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("n"), (F.avg("sentiment_score") * 100).alias("keyword_sentiment")
    )


def confusion(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predicted.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def class_report(matrix: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class; zero where undefined.

    Works on the confusion matrix, which has one row per pair of classes.
    """
    rows = matrix.select(
        F.inline(
            F.array(
                F.struct(F.col(label).alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("said")),
                F.struct(F.col(prediction).alias("cls"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("said")),
            )
        ),
        label,
        prediction,
    )
    hit = F.when(F.col(label) == F.col(prediction), F.col("actual")).otherwise(0)
    sums = rows.groupBy("cls").agg(
        F.sum(hit).alias("hit"), F.sum("actual").alias("support"), F.sum("said").alias("said")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hit", "said"), zero)
    recall = F.coalesce(F.try_divide("hit", "support"), zero)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("hit"), F.col("support") + F.col("said")), zero)
    return sums.select(
        F.col("cls").alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def score_summary(scored: DataFrame, score: str = "sentiment_score") -> DataFrame:
    return scored.agg(
        F.count(score).alias("n"), F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean")
    )


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("corr"))
