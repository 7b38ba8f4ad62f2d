"""What the operators on vectors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANY = 1000  # a key with more than 1/MANY of the rows is a frequent one; there are fewer than MANY of them


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: finite(x.cast("double"))), F.lit(False))


def attach(rows: DataFrame, table: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``rows`` joined with the one row that ``table`` holds for their keys, which are never null.

    ``count`` is the column of ``table`` with the number of rows of a key. Frequent keys, fewer than ``MANY``, are broadcast, so that
    their rows stay where they are; all others are joined by a shuffle.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    frequent = table.filter(F.col(count) * MANY > total)
    common = rows.join(F.broadcast(frequent), keys, "inner")
    others = rows.join(F.broadcast(frequent.select(*keys)), keys, "left_anti").join(table.filter(F.col(count) * MANY <= total), keys, "inner")
    return common.unionByName(others)
