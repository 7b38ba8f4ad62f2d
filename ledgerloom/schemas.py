"""Table contracts and the shapes of landed files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOL, DATE, TIMESTAMP, NAIVE = T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType()
PRICE, STRINGS = T.DecimalType(12, 4), T.ArrayType(STRING)


def _struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


VALUES = T.ArrayType(_struct(value=STRING))


@dataclass(frozen=True)
class Table:
    """A warehouse table and the rules its rows must keep."""

    schema: T.StructType
    unique: list[list[str]]
    required: list[str]
    lengths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, bool] = field(default_factory=dict)


EXCHANGES = Table(
    _struct(
        code=STRING, name=STRING, country=STRING, currency=STRING, timezone=STRING, created_at=TIMESTAMP,
        updated_at=TIMESTAMP
    ),
    unique=[["code"]],
    required=["code", "name", "created_at", "updated_at"],
    lengths={"code": 20, "name": 100, "country": 100, "currency": 10, "timezone": 50},
)

COMPANIES = Table(
    _struct(
        name=STRING, ticker=STRING, exchange_code=STRING, country=STRING, sector=STRING, industry=STRING,
        description=STRING, website=STRING, headquarters=STRING, market_cap=LONG, employees=LONG,
        fiscal_year_end=STRING, isin=STRING, cusip=STRING, cik=STRING, sedar_id=STRING, is_active=BOOL,
        created_at=TIMESTAMP, updated_at=TIMESTAMP
    ),
    unique=[["ticker", "exchange_code"]],
    required=["name", "ticker", "exchange_code", "is_active", "created_at", "updated_at"],
    # The fiscal year end is a date in words ("December 31"), so 20 rather than 10.
    lengths={
        "name": 255, "ticker": 20, "country": 100, "sector": 100, "industry": 150, "website": 255,
        "headquarters": 255, "fiscal_year_end": 20, "isin": 20, "cusip": 20, "cik": 20, "sedar_id": 50,
    },
    defaults={"is_active": True},
)

INSIDERS = Table(
    _struct(
        company_id=LONG, name=STRING, role=STRING, is_board_member=BOOL, is_insider=BOOL, start_date=DATE,
        end_date=DATE, created_at=TIMESTAMP, updated_at=TIMESTAMP
    ),
    unique=[],
    required=["company_id", "name", "is_board_member", "is_insider", "created_at", "updated_at"],
    lengths={"name": 255, "role": 100},
    defaults={"is_board_member": False, "is_insider": True},
)

ARTICLES = Table(
    _struct(
        url=STRING, title=STRING, author=STRING, publisher=STRING, source=STRING, content=STRING,
        published_at=NAIVE, fetched_at=NAIVE
    ),
    unique=[["url"]],
    required=["url", "published_at", "fetched_at"],
    lengths={"publisher": 255, "source": 64},
)

ARTICLE_TICKERS = Table(
    _struct(article_id=LONG, ticker=STRING),
    unique=[["article_id", "ticker"]],
    required=["article_id", "ticker"],
    lengths={"ticker": 10},
)

DAILY_OHLCV = Table(
    _struct(
        ticker=STRING, date=DATE, open=PRICE, high=PRICE, low=PRICE, close=PRICE, volume=LONG, fetched_at=NAIVE
    ),
    unique=[["ticker", "date"]],
    required=["ticker", "date", "fetched_at"],
    lengths={"ticker": 20},
)

# Landed files.
FEED_ITEM = _struct(
        link=STRING, title=STRING, author=STRING, published=STRING, content=VALUES, summary=STRING,
        feed_title=STRING, feed_url=STRING, seq=LONG
    )
# An item of a landed RSS 2.0 file and an entry of a landed Atom file, name spaces left out.
RSS_ITEM = _struct(
        link=STRING, title=STRING, author=STRING, creator=STRING, pubDate=STRING, date=STRING, description=STRING,
        encoded=STRING
    )
ATOM_ENTRY = _struct(
        title=STRING, link=T.ArrayType(_struct(_href=STRING, _rel=STRING)), author=_struct(name=STRING), published=STRING,
        updated=STRING, summary=STRING, content=STRING
    )
NEWS_HISTORY = _struct(
        Date=STRING, Article_title=STRING, Stock_symbol=STRING, Url=STRING, Publisher=STRING, Author=STRING
    )
PRICE_BAR = _struct(Date=STRING, Open=DOUBLE, High=DOUBLE, Low=DOUBLE, Close=DOUBLE, Volume=LONG, ticker=STRING)
WATCHLIST = _struct(Ticker=STRING, Company=STRING, GICS_Sector=STRING, GICS_Sub_Industry=STRING)
PROFILE = _struct(
        symbol=STRING, exchange=STRING, longName=STRING, shortName=STRING, country=STRING, sector=STRING,
        industry=STRING, longBusinessSummary=STRING, website=STRING, city=STRING, state=STRING, marketCap=LONG,
        fullTimeEmployees=LONG
    )
SYMBOL_MASTER = _struct(
        symbol=STRING, name=STRING, marketCap=STRING, country=STRING, ipoyear=STRING, industry=STRING,
        sector=STRING
    )
REVIEW = _struct(text=STRING, stars=INT, type=STRING, cool=INT, useful=INT, funny=INT)

# In flight: an article plus the tickers its source already knows.
ARTICLE_ROW = _struct(
        url=STRING, title=STRING, author=STRING, publisher=STRING, source=STRING, content=STRING,
        published_at=NAIVE, mentioned_tickers=STRINGS, seq=LONG
    )

# The exchanges a new warehouse starts with.
EXCHANGE_SEEDS = [
    ("NYSE", "New York Stock Exchange", "United States", "USD", "America/New_York"),
    ("NASDAQ", "NASDAQ Stock Market", "United States", "USD", "America/New_York"),
    ("TSX", "Toronto Stock Exchange", "Canada", "CAD", "America/Toronto"),
    ("TSXV", "TSX Venture Exchange", "Canada", "CAD", "America/Toronto"),
]

# Exchange codes of the profile source and the warehouse codes.
EXCHANGE_CODES = {"NYQ": "NYSE", "NMS": "NASDAQ", "NGM": "NASDAQ", "NCM": "NASDAQ"}

# The countries a listed symbol may come from.
ACCEPTED_COUNTRIES = [
    "United States", "Canada", "United Kingdom", "Germany", "France", "Italy", "Spain", "Netherlands",
    "Switzerland", "Australia", "Japan", "Kazakhstan", "Ireland", "Sweden", "Denmark", "Norway", "Finland",
]
MIN_MARKET_CAP = 10_000_000
