"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.joins import is_bounded
from ledgerloom.session import stage

QUARTILES = (0.25, 0.5, 0.75)
SLICES = 400
STEP = 20
MAX_BROADCAST_KEYS = 10_000


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key and distinct value; copies collapse in the map tasks."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: tuple[float, ...]) -> DataFrame:
    """Exact quantiles (linear interpolation) per key, one row per key and ``prob``.

    Two rounds, so no task ever holds a whole group: a sketch gives ``SLICES``
    cut points per key, the values are counted per slice between the
    cuts, and only the slices holding a wanted rank are sorted.
    """
    cells = value_counts(df, keys, value)
    grid = [i / SLICES for i in range(1, SLICES)]
    sketch = F.percentile_approx(value, F.array(*map(F.lit, grid)), 10_000)
    cuts = stage(df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(sketch.alias("_cuts")), "cuts")
    # Few keys are broadcast; with many, the planner's skew join does the rest.
    few = is_bounded(cuts, MAX_BROADCAST_KEYS)
    small = F.broadcast if few else (lambda d: d)
    # every STEP-th cut first, then those between two of them: some 40 compares a value instead of SLICES
    below = lambda some: F.size(F.filter(some, lambda c: c < F.col(value)))
    coarse = F.filter("_cuts", lambda _, i: i % STEP == STEP - 1)
    near = F.slice("_cuts", F.col("_coarse") * STEP + 1, STEP)
    cuts = cuts.withColumn("_some", coarse)
    placed = cells.join(small(cuts), keys).withColumn("_coarse", below("_some")).withColumn("_slice", F.col("_coarse") * STEP + below(near))
    placed = stage(placed.drop("_cuts", "_some", "_coarse"), "cells")
    sizes = placed.groupBy(*keys, "_slice").agg(F.sum("n").alias("_rows"))
    per_key = sizes.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_slice", "_rows"))).alias("_all"), F.sum("_rows").alias("_total")
    )
    # At most SLICES slices per key, so these arrays are small.
    wanted = per_key.withColumn("prob", F.explode(F.array(*map(F.lit, probs)))).withColumn(
        "_rank", F.col("prob") * (F.col("_total") - 1)
    )
    starts = F.expr(
        "transform(_all, (s, i) -> struct(s._slice as _slice, s._rows as _rows, "
        "aggregate(slice(_all, 1, i), 0L, (a, x) -> a + x._rows) as _before))"
    )
    targets = (
        wanted.withColumn("_s", F.explode(starts))
        .select(*keys, "prob", "_rank", "_total", "_s.*")
        .filter(
            (F.col("_before") <= F.ceil("_rank")) & (F.col("_before") + F.col("_rows") > F.floor("_rank"))
        )
    )
    targets = stage(targets, "targets")
    # Running counts inside the wanted slices: a spilling sort, nothing collected.
    wanted_slices = targets.select(*keys, "_slice", "_before").distinct()
    running = Window.partitionBy(*keys, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        placed.join(small(wanted_slices), [*keys, "_slice"])
        .withColumn("_end", F.col("_before") + F.sum("n").over(running))
        .select(*keys, "_slice", F.col(value).cast("double").alias("_v"), (F.col("_end") - F.col("n")).alias("_from"), "_end")
    )
    lo_rank, hi_rank = F.floor("_rank"), F.ceil("_rank")

    def covers(rank: Column) -> Column:
        return (F.col("_from") <= rank) & (rank < F.col("_end"))

    found = (
        inside.join(small(targets.drop("_before", "_rows", "_total")), [*keys, "_slice"])
        .filter(covers(lo_rank) | covers(hi_rank))
        .groupBy(*keys, "prob", "_rank")
        .agg(
            F.max(F.when(covers(lo_rank), F.col("_v"))).alias("lo"),
            F.max(F.when(covers(hi_rank), F.col("_v"))).alias("hi"),
        )
    )
    return found.select(
        *keys, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("_rank") - lo_rank)).alias("value")
    )


def describe(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum.

    One row per key and described column.
    """
    parts = F.array(
        *[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("x")) for v in values]
    )
    long = df.select(*keys, F.inline(parts))
    by = [*keys, "variable"]
    basics = long.groupBy(*by).agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    wide = (
        exact_quantiles(long, by, "x", QUARTILES)
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES])
    )
    return basics.join(wide, by, "left")


def histogram(df: DataFrame, label: str, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Rows per label and equal-width bin; the last bin is closed."""
    bin_no = F.least(F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins).cast("bigint"))
    return (
        df.filter(F.col(value).between(lo, hi))
        .groupBy(label, bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", F.lit(lo) + (F.col("bin") - 1) * F.lit((hi - lo) / bins))
    )


def letter_values(df: DataFrame, key: str, value: str, depth: int = 4) -> DataFrame:
    """Median and the paired tail quantiles 1/4, 1/8, ... per key."""
    tails = [2.0 ** -(i + 1) for i in range(1, depth + 1)]
    probs = tuple(sorted({0.5, *tails, *[1 - t for t in tails]}))
    return exact_quantiles(df, [key], value, probs)
