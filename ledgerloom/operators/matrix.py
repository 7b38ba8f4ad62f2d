"""Products of matrices held as long tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

BLOCK = 256


def multiply(
    left: DataFrame,
    right: DataFrame,
    row: str,
    inner: str,
    col: str,
    left_value: str,
    right_value: str,
    out: str,
    shape: tuple[int, int, int],
    block: int = BLOCK,
) -> DataFrame:
    """``left(row, inner) x right(inner, col)``; absent cells are zero.

    Indexes are hashed into blocks of about ``block`` values. Each cell is sent
    to the block products it takes part in, every block product is one small
    NumPy multiplication, and the products are summed. Pairs of cells are never
    enumerated as rows, and a task holds no more than two blocks. ``shape`` (rows,
    inner, columns) only sizes the blocks, so estimates will do.
    """
    n_row, n_in, n_col = [max(1, -(-int(n) // block)) for n in shape]

    def home(name: str, n: int):
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    a = left.select(
        F.col(row).alias("i"), F.col(inner).alias("k"), F.col(left_value).cast("double").alias("v"),
        home(row, n_row).alias("bi"), home(inner, n_in).alias("bk"),
    ).withColumn("bj", every(n_col))
    b = right.select(
        F.col(inner).alias("k"), F.col(col).alias("j"), F.col(right_value).cast("double").alias("v"),
        home(inner, n_in).alias("bk"), home(col, n_col).alias("bj"),
    ).withColumn("bi", every(n_row))

    def block_product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame({"i": [], "j": [], "v": []}, dtype=object)
        at_k, _ = pd.factorize(pd.concat([x["k"], y["k"]]).astype(object))
        at_i, i = pd.factorize(x["i"].astype(object))
        at_j, j = pd.factorize(y["j"].astype(object))
        width = at_k.max() + 1
        p, q = np.zeros((len(i), width)), np.zeros((width, len(j)))
        p[at_i, at_k[: len(x)]] = x["v"]
        q[at_k[len(x) :], at_j] = y["v"]
        i, j = np.asarray(i, dtype=object), np.asarray(j, dtype=object)
        return pd.DataFrame({"i": np.repeat(i, len(j)), "j": np.tile(j, len(i)), "v": (p @ q).ravel()})

    types = {"i": a.schema["i"].dataType.simpleString(), "j": b.schema["j"].dataType.simpleString()}
    parts = (
        a.groupBy("bi", "bj", "bk")
        .cogroup(b.groupBy("bi", "bj", "bk"))
        .applyInPandas(block_product, f"i {types['i']}, j {types['j']}, v double")
    )
    return parts.groupBy(F.col("i").alias(row), F.col("j").alias(col)).agg(F.sum("v").alias(out))
