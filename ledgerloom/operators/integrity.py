"""Audit queries for the rules a database would enforce row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _text_key(cols: list[str]):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def unique_violations(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("rule"), _text_key(keys).alias("key"), "n"
    )


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str, rule: str) -> DataFrame:
    """Foreign keys without a parent; a null key breaks no rule.

    The child is reduced to one row per key first, so a hot key costs nothing.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(pk).alias("key")), "key", "left_anti").select(
        F.lit(rule).alias("rule"), F.col("key").cast("string").alias("key"), "n"
    )


def null_violations(df: DataFrame, table: str, required: list[str]) -> DataFrame:
    """Nulls per required column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    parts = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_null")) for c in required]
    )
    return counts.select(F.inline(parts)).select(F.lit(table).alias("table_name"), "column_name", "n_null")


def length_violations(df: DataFrame, table: str, limits: dict[str, int], key: str) -> DataFrame:
    """Values longer than their column allows."""
    parts = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.length(c).cast("bigint").alias("length"), F.lit(n).alias("limit_n")
            )
            for c, n in limits.items()
        ]
    )
    return (
        df.select(F.col(key).cast("string").alias("key"), F.inline(parts))
        .filter(F.col("length") > F.col("limit_n"))
        .select(F.lit(table).alias("table_name"), "column_name", "key", "length", "limit_n")
    )


def all_of(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def cascade_delete(children: DataFrame, fk: str, deleted: DataFrame, pk: str) -> DataFrame:
    """The children that stay when parents are deleted."""
    gone = deleted.select(F.col(pk).alias(fk)).distinct()
    return children.join(gone, fk, "left_anti")


def restricted(deleted: DataFrame, pk: str, children: DataFrame, fk: str) -> DataFrame:
    """Parents that may not be deleted because a child refers to them."""
    used = children.select(F.col(fk).alias(pk)).distinct()
    return deleted.join(used, pk, "left_semi")


def restrict_delete(parents: DataFrame, deleted: DataFrame, pk: str, children: DataFrame, fk: str) -> DataFrame:
    """Parents after a delete; refuses it while children refer to a deleted row."""
    if not restricted(deleted, pk, children, fk).isEmpty():
        raise ValueError("rows still refer to the parents to delete")
    return parents.join(deleted.select(pk).distinct(), pk, "left_anti")
