"""Returns, covariance and portfolio risk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.rates import annual_return, annual_volatility, daily_rate
from ledgerloom.operators.matrix import multiply


def simple_return(price: Column, before: Column) -> Column:
    """``price / before - 1``; a zero price before gives an infinite return."""
    return F.when(before != 0, price / before - 1).when(price != 0, F.signum(price) * F.lit(float("inf")))


def daily_returns(bars: DataFrame, price: str = "close") -> DataFrame:
    """Daily returns of every ticker on every day all of them are known.

    A ticker without a price on a day keeps the one before, so its return is
    zero then. The gap days are generated from the day numbers of neighbouring
    prices; no grid of days and tickers is joined. Days up to the latest first
    price are dropped. A ticker has one row per day, which bounds its window.
    """
    prices = bars.filter(F.col(price).isNotNull()).select(
        "ticker", "date", F.col(price).cast("double").alias("price")
    )
    # One row per calendar day: small whatever the number of tickers.
    days = prices.select("date").distinct().withColumn(
        "day", F.row_number().over(Window.orderBy("date"))
    )
    series = Window.partitionBy("ticker").orderBy("date")
    numbered = prices.join(days, "date").select(
        "ticker",
        "day",
        simple_return(F.col("price"), F.lag("price").over(series)).alias("ret"),
        F.lead("day").over(series).alias("next_day"),
    )
    last_day = days.agg(F.max("day")).scalar()
    first_common = (
        numbered.groupBy("ticker").agg(F.min("day").alias("first")).agg(F.max("first")).scalar()
    )
    filled = numbered.withColumn(
        "covered", F.explode(F.sequence(F.col("day"), F.coalesce(F.col("next_day") - 1, last_day)))
    ).select(
        "ticker",
        F.col("covered").alias("day"),
        F.when(F.col("covered") == F.col("day"), F.col("ret")).otherwise(F.lit(0.0)).alias("ret"),
    )
    common = filled.filter(F.col("day") > first_common)
    # Nothing divided by nothing leaves no return; that day goes for everybody.
    undefined = common.filter(F.col("ret").isNull()).select("day").distinct()
    return common.join(undefined, "day", "left_anti").join(days, "day").select("ticker", "date", "ret")


def return_stats(returns: DataFrame) -> DataFrame:
    return returns.groupBy("ticker").agg(
        F.count("ret").alias("n"), F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std")
    )


def return_cov(returns: DataFrame) -> DataFrame:
    """Sample covariance of every pair of tickers, as ``(t1, t2, cov)``.

    Returns are centred, then the matrix is multiplied with its transpose.
    """
    means = returns.groupBy("ticker").agg(F.avg("ret").alias("mean"), F.count("ret").alias("n"))
    centred = returns.join(means, "ticker").select("ticker", "date", (F.col("ret") - F.col("mean")).alias("x"))
    n = means.agg(F.max("n")).scalar()
    shape = returns.agg(F.approx_count_distinct("ticker"), F.approx_count_distinct("date")).first()
    cross = multiply(
        centred.select(F.col("ticker").alias("t1"), "date", "x"),
        centred.select("date", F.col("ticker").alias("t2"), "x"),
        "t1", "date", "t2", "x", "x", "s",
        shape=(shape[0], shape[1], shape[0]),
    )
    return cross.select("t1", "t2", F.when(n > 1, F.col("s") / (n - 1)).alias("cov"))


def random_weights(tickers: DataFrame, n_portfolios: int = 1000, seed: int = 7) -> DataFrame:
    """Long-only weights drawn uniformly from the simplex (Dirichlet of ones).

    The draws hash (seed, portfolio, ticker), so every run and every recomputed
    task draws the same numbers.
    """
    cells = tickers.select("ticker").distinct().withColumn(
        "portfolio_id", F.explode(F.sequence(F.lit(0), F.lit(n_portfolios - 1)))
    )
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("portfolio_id").cast("string"), F.col("ticker")))
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(16**13))
    drawn = cells.withColumn("g", -F.ln(unit))
    total = drawn.groupBy("portfolio_id").agg(F.sum("g").alias("total"))
    return drawn.join(total, "portfolio_id").select(
        "portfolio_id", "ticker", (F.col("g") / F.col("total")).alias("weight")
    )


def portfolio_risk(
    returns: DataFrame, weights: DataFrame, annual_rf: float = 0.03, rf_mode: str = "reference"
) -> DataFrame:
    """Annual return, volatility and Sharpe ratio of every portfolio.

    The weights times the return matrix give each portfolio's daily series;
    its variance equals ``w' cov w``, so no pair of tickers is formed.
    ``reference`` subtracts the daily risk-free rate twice from the mean,
    ``standard`` takes the annual rate off the annual return in the ratio.
    """
    n_portfolios, n_tickers = weights.agg(
        F.approx_count_distinct("portfolio_id"), F.approx_count_distinct("ticker")
    ).first()
    n_days = returns.agg(F.approx_count_distinct("date")).first()[0]
    series = multiply(
        weights.select("portfolio_id", "ticker", "weight"),
        returns.select("ticker", "date", "ret"),
        "portfolio_id", "ticker", "date", "weight", "ret", "ret",
        shape=(n_portfolios, n_tickers, n_days),
    )
    stats = series.groupBy("portfolio_id").agg(F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std"))
    invested = weights.groupBy("portfolio_id").agg(F.sum("weight").alias("invested"))
    volatility = annual_volatility(F.col("std"))
    if rf_mode == "reference":
        ret = annual_return(F.col("mean") - F.lit(2 * daily_rate(annual_rf)) * F.col("invested"))
        excess = ret
    elif rf_mode == "standard":
        ret = annual_return(F.col("mean"))
        excess = ret - F.lit(annual_rf) * F.col("invested")
    else:
        raise ValueError(f"unknown rf_mode: {rf_mode}")
    return stats.join(invested, "portfolio_id").select(
        "portfolio_id",
        ret.alias("portfolio_return"),
        volatility.alias("portfolio_volatility"),
        F.try_divide(excess, volatility).alias("sharpe_ratio"),
    )


def benchmark_risk(
    bars: DataFrame, ticker: str, annual_rf: float = 0.03, rf_mode: str = "reference"
) -> DataFrame:
    """The same three figures for one ticker held alone.

    ``reference`` takes the *daily* rate off the annual return.
    """
    returns = daily_returns(bars.filter(F.col("ticker") == ticker))
    rf = daily_rate(annual_rf) if rf_mode == "reference" else annual_rf
    stats = returns.groupBy("ticker").agg(F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std"))
    ret, volatility = annual_return(F.col("mean")), annual_volatility(F.col("std"))
    return stats.select(
        "ticker",
        ret.alias("annual_return"),
        volatility.alias("annual_volatility"),
        F.try_divide(ret - F.lit(rf), volatility).alias("sharpe_ratio"),
    )


def top_portfolios(risk: DataFrame, n: int = 5) -> DataFrame:
    """The best portfolios by Sharpe ratio, by return and by low volatility."""
    orders = {
        "sharpe": F.desc("sharpe_ratio"),
        "return": F.desc("portfolio_return"),
        "volatility": F.asc("portfolio_volatility"),
    }
    lists = [
        risk.orderBy(order, "portfolio_id").limit(n).withColumn("ranking", F.lit(name))
        for name, order in orders.items()
    ]
    return reduce(DataFrame.unionByName, lists)


def with_weights(portfolios: DataFrame, weights: DataFrame) -> DataFrame:
    """The weights of the portfolios beside their figures, one row per ticker.

    The portfolios are the best few; the weights are scanned once.
    """
    return weights.select("portfolio_id", "ticker", "weight").join(portfolios, "portfolio_id")
