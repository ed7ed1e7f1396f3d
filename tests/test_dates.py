import datetime as dt

import pytest
from pyspark.sql import functions as F

from curata.functions.dates import iso_or_rfc_date, normalize_date, relative_date, with_freshness

REF = "2026-08-15 12:00:00"


def _parse(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_iso_and_rfc(spark):
    got = _parse(spark, ["2026-08-15T10:00:00Z", "Sat, 15 Aug 2026 10:00:00 GMT", "2026-08-15T10:00:00.250Z",
                         "2026-08-15T15:30:00+05:30", "2026-08-15T02:00:00-0800", "2026-08-15 10:00:00",
                         "2026-08-15", "15 Aug 2026 10:00:00 EST", "15 Aug 26 10:00 -0000"], iso_or_rfc_date)
    assert got[0] == dt.datetime(2026, 8, 15, 10, 0)
    assert got[1] == dt.datetime(2026, 8, 15, 10, 0)
    assert got[2] == dt.datetime(2026, 8, 15, 10, 0, 0, 250000)
    assert got[3] == dt.datetime(2026, 8, 15, 10, 0)
    assert got[4] == dt.datetime(2026, 8, 15, 10, 0)
    assert got[5] == dt.datetime(2026, 8, 15, 10, 0)
    assert got[6] == dt.datetime(2026, 8, 15, 0, 0)
    assert got[7] == dt.datetime(2026, 8, 15, 15, 0)   # EST is a fixed -05:00
    assert got[8] == dt.datetime(2026, 8, 15, 10, 0)


@pytest.mark.parametrize("text", ["2026-08-15T10:00:00", "Aug 15, 2026", "15 Aug 2026", "", None, "junk"])
def test_unparseable(spark, text):
    assert _parse(spark, [text], iso_or_rfc_date) == [None]


def test_relative(spark):
    got = _parse(spark, ["2 hours ago", "30 mins ago", "yesterday", "Just now", "today", "5d ago",
                         "2 weeks ago", "an hour ago", "posted 10 seconds ago"], lambda c: relative_date(c, REF))
    assert got[0] == dt.datetime(2026, 8, 15, 10, 0)
    assert got[1] == dt.datetime(2026, 8, 15, 11, 30)
    assert got[2] == dt.datetime(2026, 8, 14, 0, 0)
    assert got[3] == dt.datetime(2026, 8, 15, 12, 0)
    assert got[4] == dt.datetime(2026, 8, 15, 0, 0)
    assert got[5] == dt.datetime(2026, 8, 10, 12, 0)
    assert got[6] is None and got[7] is None
    assert got[8] == dt.datetime(2026, 8, 15, 11, 59, 50)


def test_normalize_prefers_absolute(spark):
    assert _parse(spark, ["2026-08-15T10:00:00Z"], lambda c: normalize_date(c, REF)) == [dt.datetime(2026, 8, 15, 10)]


def _verdicts(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    f = with_freshness(df, "raw", REF, 24.0, out="f")
    return [(r.f.verdict, r.f.is_fresh, r.f.reason) for r in f.collect()]


def test_freshness_cases(spark):
    got = _verdicts(spark, ["2026-08-15T10:00:00Z", "2026-08-14T06:00:00Z", None, "2026-08-14T12:01:00Z",
                            "2026-08-14T11:59:59Z", "2026-08-15T13:00:00Z", "2026-08-14T12:00:00Z",
                            "2026-08-15T12:05:00Z", "nonsense"])
    assert got[0][:2] == ("FRESH", True) and got[0][2] == "VERIFIED_FRESH: 2.00h old"
    assert got[1][0] == "STALE" and got[1][2].startswith("REJECTED_STALE: 30.00h")
    assert got[2] == ("MISSING", False, "REJECTED: Missing publication date")
    assert got[3][0] == "FRESH"            # 23h59m
    assert got[4][0] == "STALE"            # 24h + 1s
    assert got[5] == ("FUTURE", False, "REJECTED: Future publication timestamp")
    assert got[6][0] == "FRESH"            # exactly 24h is fresh
    assert got[7][0] == "FRESH"            # exactly 300 s in the future passes
    assert got[8] == ("UNPARSEABLE", False, "REJECTED: Unparseable date format")


def test_html_fallback(spark):
    html = '<html><head><script type="application/ld+json">{"datePublished": "2026-08-15T08:15:00Z"}</script></head></html>'
    df = spark.createDataFrame([(None, html)], "raw string, html string")
    f = with_freshness(df, "raw", REF, 24.0, out="f", html="html").collect()[0].f
    assert f.published_at == dt.datetime(2026, 8, 15, 8, 15) and f.is_fresh
