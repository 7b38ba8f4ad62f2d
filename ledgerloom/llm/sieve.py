"""A bit table of fixed size over ids: spares most rows that have no partner the shuffle of a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 23  # 2^23 bits, 1 MB, whatever the input


def _cell(id: Column) -> tuple[Column, Column]:
    cell = F.xxhash64(id).bitwiseAND((1 << BITS) - 1)
    return F.shiftright(cell, 6).cast("int"), cell.bitwiseAND(63).cast("int")


def sieve(rows: DataFrame, key: str, ids: DataFrame, id: str) -> DataFrame:
    """``rows`` with ``_maybe``: false only if ``key`` is not among ``ids``.

    The table that is broadcast has at most 2^BITS / 64 rows of 12 bytes. With more ids than bits it lets
    nearly every row pass, and the join behind it, which is exact, shuffles them as it would without.
    """
    word, bit = _cell(F.col(id).cast("long"))
    bits = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    word, bit = _cell(F.col(key).cast("long"))
    joined = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
    maybe = F.coalesce(F.expr("shiftright(_bits, _bit) & 1 = 1"), F.lit(False))
    return joined.withColumn("_maybe", maybe).drop("_word", "_bit", "_bits")
