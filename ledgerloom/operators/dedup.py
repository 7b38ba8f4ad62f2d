"""First-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def arrival(columns: list[str], seq: str | None) -> Column:
    """What rows are ordered by: ``seq``, those without one last, then a hash of the row."""
    first = [F.col(seq).isNull().alias("missing"), F.col(seq).alias("seq")] if seq else []
    return F.struct(*first, F.xxhash64(*columns).alias("hash"))


def first_per_key(df: DataFrame, keys: list[str], seq: str | None) -> DataFrame:
    """The row with the smallest ``seq`` for each key.

    An aggregate rather than a window: each map task keeps one row per key, so
    a key with very many copies costs one row per task in the shuffle.
    Rows without a ``seq`` come last, and a hash of the row decides between equal
    ones, so the result is the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), arrival(df.columns, seq)).alias("_row"))
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def last_value_per_key(df: DataFrame, keys: list[str], value: str, *order: str) -> DataFrame:
    """Later rows overwrite earlier ones."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def without_stored(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet.

    The batch's keys look up the stored ones first, so that a small batch reads
    the stored keys once, without a shuffle of them, and meets only those it has.
    """
    known = stored.select(*keys).join(df.select(*keys).distinct(), keys, "left_semi").distinct()
    return df.join(known, keys, "left_anti")


def bounded_stream_dedup(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeats of ``key`` arriving within ``delay``; state stays bounded."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
