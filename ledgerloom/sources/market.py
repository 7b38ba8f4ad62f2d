"""Daily prices, watch lists and symbol lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom import schemas

BAR_FIELDS = ["Open", "High", "Low", "Close", "Volume"]


def daily_bars(rows: DataFrame, start: str | Column | None = None, end: str | Column | None = None) -> DataFrame:
    """Price rows on the stored shape: lower-case names, days in the range."""
    day = F.to_date("Date")
    bars = rows.select(
        "ticker",
        day.alias("date"),
        *[F.col(f).cast(schemas.DAILY_OHLCV.schema[f.lower()].dataType).alias(f.lower()) for f in BAR_FIELDS],
    )
    if start is not None:
        bars = bars.filter(F.col("date") >= _day(start))
    if end is not None:
        bars = bars.filter(F.col("date") < _day(end))
    return bars


def _day(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def bars_from_ticks(
    ticks: DataFrame, ticker: str, ts: str, value: str, order: str | None = None
) -> DataFrame:
    """Open, high, low, close and count per ticker and day.

    ``order`` breaks ties between ticks of one instant, at the price of a sort in
    the map tasks; where instants are unique, leave it out and the aggregate is
    a plain hash aggregate.
    """
    when = F.col(ts) if order is None else F.struct(ts, order)
    return ticks.groupBy(F.col(ticker).alias("ticker"), F.to_date(ts).alias("Date")).agg(
        F.min_by(value, when).alias("Open"),
        F.max(value).alias("High"),
        F.min(value).alias("Low"),
        F.max_by(value, when).alias("Close"),
        F.count(F.lit(1)).alias("Volume"),
    )


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Landed price files, CSV with a header in a folder ``ticker=<name>`` for each ticker, as rows for ``daily_bars``.

    A row whose day cannot be read is left out, as a day without data is.
    """
    rows = spark.read.schema(schemas.PRICE_BAR).option("header", True).csv(path)
    return rows.filter(F.col("Date").try_cast("date").isNotNull())


def read_symbols(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed symbol lists; every value is text. ``multi_line`` reads files that are one JSON array."""
    return spark.read.schema(schemas.SYMBOL_MASTER).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def read_watchlist(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Ticker list; bad JSON or a row without a ticker is fatal.

    ``multi_line`` reads files that are one JSON array; otherwise every line
    holds an object or an array, and large files are split over tasks.
    """
    rows = (
        spark.read.schema(schemas.WATCHLIST).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    )
    ticker = F.when(F.col("Ticker").isNull(), F.raise_error(F.lit("watch list row without Ticker"))).otherwise(
        F.col("Ticker")
    )
    return rows.withColumn("Ticker", ticker)


# Plain numbers only: casts also take NaN, which sorts above every number, and suffixes such as d.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def symbol_universe(*lists: DataFrame) -> DataFrame:
    """Listed symbols worth following, from any number of lists."""
    rows = lists[0]
    for other in lists[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    text = F.trim(F.col("marketCap").cast("string"))
    cap = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return rows.filter(
        ~F.contains("symbol", F.lit("^"))
        & (cap > schemas.MIN_MARKET_CAP)
        & F.col("country").isin(schemas.ACCEPTED_COUNTRIES)
    ).select(
        F.replace("symbol", F.lit("/"), F.lit("-")).alias("symbol"),
        "name",
        cap.alias("marketCap"),
        "country",
        "ipoyear",
        "industry",
        "sector",
    )


def symbols_like(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose symbol contains a pattern, case-sensitive."""
    return rows.filter(F.col(column).rlike(pattern))


def keep_exchange(rows: DataFrame, column: str, name: str = "NYSE") -> DataFrame:
    """Rows of one exchange (substring, any case); all rows if there is none.

    Whether any row matches is an uncorrelated scalar subquery, so no join.
    """
    match = F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(name.lower()))
    found = rows.agg(F.coalesce(F.max(match), F.lit(False)).alias("found")).scalar()
    return rows.filter(match | ~found)
