"""A corpus for language models: quality rules, near duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last return the columns
of ``documents``. ``run`` writes each result to the shared folder and reads it again for the next stage.

Defined results: a null, empty or blank text fails the quality rules and goes with its document; a null id is kept through all
stages, comes last among near duplicates' smallest ids and last in the order in which repeated passages stay; of rows repeated whole
one stays after the near duplicates; rows that share an id but not a text are documents of their own; of texts that tie, the smallest
id stays; very long texts are judged, cut and packed whole; an empty table gives an empty result; further columns, whatever
their names, are carried to the last stage, which returns pieces alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, packing, pii, quality, repeats
from ledgerloom.session import stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail go, and documents that fail the base rules or lose too much."""
    return _counted(quality.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the one with the smallest id stays."""
    return jaccard.keep_one(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that starts earlier in the corpus go."""
    return _counted(repeats.clean(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return _counted(pii.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), special_as_text=False)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packed),
]

# DuckDB cannot express similarity components, the trained models or the tokenizer; tests hold run() against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
