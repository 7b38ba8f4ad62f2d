"""Date parsing; every result is a zone-less timestamp in UTC, or null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted shapes of a historical date, in the order tried.
NAIVE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}:\d{1,2})?$"
OFFSET_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(Z|[+-]\d{2}:?\d{2})$"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"
ISO_OFFSET_SHAPE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"
MAIL_FORMATS = ("d MMM yyyy HH:mm:ss [Z][z]", "d MMM yyyy HH:mm [Z][z]")

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_naive(instant: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session time zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH))


def feed_date(col: Column) -> Column:
    """RFC 2822 first, then ISO 8601."""
    text = F.trim(col)
    bare = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    mail = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in MAIL_FORMATS])
    return F.coalesce(utc_naive(mail), _shaped(text, ISO_SHAPE, ISO_OFFSET_SHAPE))


def published_day(col: Column) -> Column:
    """The day as written, in the time zone it was written in."""
    return F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(col, 1, 10).try_cast("date")).otherwise(
        F.to_date(feed_date(col))
    )


def history_date(col: Column) -> Column:
    """Historical news dates: `` UTC`` dropped, then the accepted shapes."""
    return _shaped(F.trim(F.replace(col, F.lit(" UTC"), F.lit(""))), NAIVE_SHAPE, OFFSET_SHAPE)


def _shaped(text: Column, naive: str, offset: str) -> Column:
    return F.when(text.rlike(naive), text.try_cast("timestamp_ntz")).when(
        text.rlike(offset), utc_naive(text.try_cast("timestamp"))
    )


def default_range(years_in_days: int = 3650) -> tuple[Column, Column]:
    """First and last day of the price history loaded by default."""
    return F.date_sub(F.current_date(), years_in_days), F.current_date()
