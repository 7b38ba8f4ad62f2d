from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        feed = {
            "Mon, 06 Apr 2026 04:57:00 GMT": datetime(2026, 4, 6, 4, 57),
            "6 Apr 2026 04:57:00 -0400": datetime(2026, 4, 6, 8, 57),
            "Sun, 08 Mar 2026 02:30:00 GMT": datetime(2026, 3, 8, 2, 30),
            "2026-04-06T04:57:00Z": datetime(2026, 4, 6, 4, 57),
            "2026-04-06T04:57:00+02:00": datetime(2026, 4, 6, 2, 57),
            "2026-03-08T02:30:00": datetime(2026, 3, 8, 2, 30),
            "2026-04-06": datetime(2026, 4, 6),
            "yesterday": None,
            "2026-02-30T00:00:00Z": None,
            "": None,
        }
        old = {
            "2020-06-05 06:30:54 UTC": datetime(2020, 6, 5, 6, 30, 54),
            "2020-06-05 06:30:54+0200": datetime(2020, 6, 5, 4, 30, 54),
            "2020-06-05T06:30:54-04:00": datetime(2020, 6, 5, 10, 30, 54),
            "2020-06-05T06:30:54": datetime(2020, 6, 5, 6, 30, 54),
            " 2020-06-05 ": datetime(2020, 6, 5),
            "05/06/2020": None,
        }
        for cases, fn in ((feed, dates.feed_date), (old, dates.history_date)):
            df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", fn(F.col("s")).alias("d"))
            assert {r["s"]: r["d"] for r in df.collect()} == cases
        assert spark.createDataFrame([(None,)], "s string").select(dates.history_date(F.col("s"))).first()[0] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_published_day_keeps_the_written_day(spark):
    df = spark.createDataFrame([("2024-01-01T23:00:00-05:00",), ("nope",)], "s string")
    assert [r[0] for r in df.select(dates.published_day(F.col("s"))).collect()] == [date(2024, 1, 1), None]


def test_default_range(spark):
    lo, hi = dates.default_range()
    assert (lambda r: (r[1] - r[0]).days)(spark.range(1).select(lo, hi).first()) == 3650
