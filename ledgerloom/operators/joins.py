"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000
SALTS = 32
# A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are
# never more than HOT_SHARE hot keys and their table is always small.
HOT_SHARE = 1000


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    """Keys holding more than their fair share (at most ``HOT_SHARE`` rows)."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.groupBy(key).agg(n.alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    return sizes.filter(F.col("_n") * HOT_SHARE > total).select(key)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a large ``left`` with a keyed ``right`` (one row per key).

    ``right`` is broadcast when its checked size allows, which needs no shuffle;
    otherwise hot keys are salted.
    """
    if is_bounded(right, max_rows):
        return left.join(F.broadcast(right), key, how)
    return salted_join(left, right, key, spread_by, hot_keys(left, key), how)


def salted_join(
    left: DataFrame, right: DataFrame, key: str, spread_by: str, hot: DataFrame, how: str = "inner"
) -> DataFrame:
    """Equi join whose hot keys are spread over ``SALTS`` tasks.

    The salt is a hash of ``spread_by``, so a recomputed task gives the same one.
    Only the hot rows of ``right`` are repeated; rows without a key, which match
    nothing, are spread too.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    marks = F.broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    spread = F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salted_left = left.join(marks, key, "left").withColumn("_salt", spread).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(marks, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
