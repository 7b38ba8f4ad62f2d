"""Rate conversions on a 252-day trading year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TRADING_DAYS = 252


def daily_rate(annual: float) -> float:
    return (1 + annual) ** (1 / TRADING_DAYS) - 1


def annual_return(daily_mean: Column) -> Column:
    return daily_mean * TRADING_DAYS


def annual_volatility(daily_std: Column) -> Column:
    return daily_std * F.sqrt(F.lit(TRADING_DAYS))
