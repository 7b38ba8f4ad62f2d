import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import risk
from ledgerloom.operators.matrix import multiply
from ledgerloom.sources.market import bars_from_ticks

# C starts late, A has a gap, B ends early and holds a zero.
PRICES = pd.DataFrame(
    {
        "A": [10, 11, None, 12, 13, 12.5],
        "B": [5, 5.5, 0, 6, None, None],
        "C": [None, 7, 7.7, 7.7, 8, 9],
    },
    index=pd.date_range("2024-01-01", periods=6),
    dtype=float,
)


def long(spark, wide):
    rows = [(t, d.date(), None if math.isnan(v) else v) for t in wide for d, v in wide[t].items()]
    return spark.createDataFrame(rows, "ticker string, date date, close double")


def pandas_returns(wide):
    return wide.ffill().pct_change(fill_method=None).dropna()


def test_returns_like_a_filled_wide_table(spark):
    got = risk.daily_returns(long(spark, PRICES)).toPandas().pivot(index="date", columns="ticker", values="ret")
    want = pandas_returns(PRICES)
    assert list(got.index) == [d.date() for d in want.index]
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


def test_undefined_return_drops_the_day(spark):
    wide = PRICES.assign(B=[1.0, 0, 0, 0, 2, 3])
    got = risk.daily_returns(long(spark, wide)).toPandas()
    want = pandas_returns(wide)
    assert sorted(set(got["date"])) == [d.date() for d in want.index]


@pytest.fixture(scope="module")
def returns(spark):
    rng = np.random.default_rng(3)
    wide = pd.DataFrame(rng.normal(0, 0.02, (40, 7)), columns=list("ABCDEFG"), index=pd.date_range("2024-01-01", periods=40))
    rows = [(t, d.date(), float(v)) for t in wide for d, v in wide[t].items()]
    return wide, spark.createDataFrame(rows, "ticker string, date date, ret double")


def test_covariance(returns):
    wide, df = returns
    got = risk.return_cov(df).toPandas().pivot(index="t1", columns="t2", values="cov")
    np.testing.assert_allclose(got.to_numpy(), wide.cov().to_numpy(), atol=1e-15)


@pytest.mark.parametrize("mode", ["reference", "standard"])
def test_portfolios(returns, mode):
    wide, df = returns
    weights = risk.random_weights(df, 30)
    w = weights.toPandas().pivot(index="portfolio_id", columns="ticker", values="weight")
    np.testing.assert_allclose(w.sum(axis=1), 1)
    assert (w.to_numpy() > 0).all()
    got = risk.portfolio_risk(df, weights, rf_mode=mode).toPandas().set_index("portfolio_id").sort_index()
    rf = 1.03 ** (1 / 252) - 1
    vol = np.sqrt(np.einsum("pi,ij,pj->p", w, wide.cov(), w)) * np.sqrt(252)
    ret = w.to_numpy() @ (wide.mean() - (2 * rf if mode == "reference" else 0)).to_numpy() * 252
    np.testing.assert_allclose(got["portfolio_volatility"], vol)
    np.testing.assert_allclose(got["portfolio_return"], ret)
    np.testing.assert_allclose(got["sharpe_ratio"], (ret - (0 if mode == "reference" else 0.03)) / vol)
    best = risk.top_portfolios(risk.portfolio_risk(df, weights, rf_mode=mode), 3)
    assert best.count() == 9
    assert risk.with_weights(best, weights).count() == 9 * 7


def test_unknown_mode(returns):
    with pytest.raises(ValueError):
        risk.portfolio_risk(returns[1], risk.random_weights(returns[1], 2), rf_mode="x")


def test_weights_repeat(spark, returns):
    a, b = (risk.random_weights(returns[1].repartition(n), 5).orderBy("portfolio_id", "ticker").collect() for n in (1, 7))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    np.testing.assert_allclose([r["weight"] for r in a], [r["weight"] for r in b], rtol=1e-12)


@pytest.mark.parametrize("block", [2, 3, 100])
def test_block_product(spark, block):
    rng = np.random.default_rng(1)
    p, q = rng.normal(size=(5, 7)), rng.normal(size=(7, 4))
    p[1, :], q[3, :] = 0, 0
    left = spark.createDataFrame([(i, k, float(p[i, k])) for i in range(5) for k in range(7) if p[i, k]], "i int, k int, v double")
    right = spark.createDataFrame([(k, f"c{j}", float(q[k, j])) for k in range(7) for j in range(4) if q[k, j]], "k int, j string, v double")
    got = multiply(left, right, "i", "k", "j", "v", "v", "s", shape=(5, 7, 4), block=block).toPandas()
    for i, j, s in got[["i", "j", "s"]].itertuples(index=False):
        assert abs(s - (p @ q)[i, int(j[1:])]) < 1e-12
    assert set(got["i"]) == {0, 2, 3, 4}


def test_benchmark(spark):
    got = risk.benchmark_risk(long(spark, PRICES), "C").first()
    r = pandas_returns(PRICES[["C"]])["C"]
    rf = 1.03 ** (1 / 252) - 1
    assert abs(got["annual_return"] - r.mean() * 252) < 1e-12
    assert abs(got["sharpe_ratio"] - (r.mean() * 252 - rf) / (r.std() * 252**0.5)) < 1e-12


def test_bars_break_ties_by_order(spark):
    ticks = spark.createDataFrame(
        [("A", "2024-01-01 09:00:00", 2, 5.0), ("A", "2024-01-01 09:00:00", 1, 4.0), ("A", "2024-01-01 10:00:00", 3, 1.0)],
        "t string, ts string, id int, v double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    row = bars_from_ticks(ticks, "t", "ts", "v", "id").first()
    assert (row["Open"], row["High"], row["Low"], row["Close"], row["Volume"]) == (4.0, 5.0, 1.0, 1.0, 3)
