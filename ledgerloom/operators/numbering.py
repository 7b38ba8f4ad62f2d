"""Dense numbers over many partitions, without a window that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import stage

LOCAL = 33  # bits of the place inside a partition


def dense_numbers(rows: DataFrame, name: str, *order: str, first: int = 1) -> DataFrame:
    """``rows`` with the numbers ``first``, ``first`` + 1, ... in ``order``, under ``name``.

    Rows are sorted by ranges of ``order`` and written with their partition and place, so that a task that runs again
    cannot number them anew; partitions are counted, and the running totals of these few counts (one row a
    partition) are added. Ties of ``order`` are numbered in any order.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbers")
    part = F.shiftrightunsigned("_place", LOCAL).cast("int")
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_part").collect()
    offsets, total = [], first
    for row in sizes:
        offsets.append((row["_part"], total))
        total += row["_n"]
    known = rows.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    local = F.col("_place").bitwiseAND((1 << LOCAL) - 1)
    numbered = placed.withColumn("_part", part).join(F.broadcast(known), "_part")
    return numbered.withColumn(name, F.col("_offset") + local).drop("_place", "_part", "_offset")
