"""Date normalisation and freshness over raw dates rendered from ``events``."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import iso_or_rfc_date, with_freshness, normalize_date, relative_date
from .catalog import register
from .derive import REFERENCE_TIME, raw_dates

REF = REFERENCE_TIME

# Expected instants per rendered shape, stated from events.ts directly.
_EXPECTED = f"""
WITH e AS (
  SELECT event_id, user_id, event_type, value, ts, event_id % 12 AS fmt,
         (event_id // 12) % 4 AS sub, (event_id // 12) % 6 AS sub6, user_id % 40 AS n,
         epoch_us(TIMESTAMP '{REF}') AS ref_us
  FROM events),
x AS (
  SELECT *,
    CASE WHEN fmt IN (0, 2, 4, 5, 7) THEN epoch_us(date_trunc('second', ts))
         WHEN fmt IN (1, 3) THEN epoch_us(ts)
         WHEN fmt = 6 THEN epoch_us(date_trunc('minute', ts))
         WHEN fmt = 8 THEN epoch_us(date_trunc('day', ts))
    END AS iso_us,
    CASE WHEN fmt = 10 THEN ref_us - n * (CASE sub WHEN 0 THEN 1000000 WHEN 1 THEN 60000000
                                                   WHEN 2 THEN 3600000000 ELSE 86400000000 END)
         WHEN fmt = 11 AND sub6 = 0 THEN ref_us
         WHEN fmt = 11 AND sub6 = 1 THEN epoch_us(date_trunc('day', TIMESTAMP '{REF}'))
         WHEN fmt = 11 AND sub6 = 2 THEN epoch_us(date_trunc('day', TIMESTAMP '{REF}' - INTERVAL 1 DAY))
    END AS rel_us,
    (fmt = 11 AND sub6 IN (4, 5)) AS missing
  FROM e),
v AS (
  SELECT *, CASE WHEN missing THEN NULL ELSE coalesce(iso_us, rel_us) END AS pub_us FROM x),
f AS (
  SELECT *, CAST(ref_us - pub_us AS DOUBLE) / 1000000.0::DOUBLE AS age_s FROM v),
g AS (
  SELECT *, CASE WHEN missing THEN 'MISSING' WHEN pub_us IS NULL THEN 'UNPARSEABLE'
                 WHEN age_s < -300 THEN 'FUTURE'
                 WHEN age_s / 3600.0::DOUBLE <= 24.0::DOUBLE THEN 'FRESH' ELSE 'STALE' END AS verdict
  FROM f)
"""


def _us(c):
    return F.unix_micros(c)


@register("iso_or_rfc_date", _EXPECTED + "SELECT event_id, fmt, iso_us AS parsed_us FROM g")
def q_iso_or_rfc_date(spark, sf):
    d = raw_dates(spark, sf)
    return d.select("event_id", "fmt", _us(iso_or_rfc_date("raw_date")).alias("parsed_us"))


@register("relative_date", _EXPECTED + "SELECT event_id, fmt, rel_us AS parsed_us FROM g")
def q_relative_date(spark, sf):
    d = raw_dates(spark, sf)
    return d.select("event_id", "fmt", _us(relative_date("raw_date", REF)).alias("parsed_us"))


@register("normalize_date", _EXPECTED + "SELECT event_id, fmt, pub_us AS parsed_us FROM g")
def q_normalize_date(spark, sf):
    d = raw_dates(spark, sf)
    return d.select("event_id", "fmt", _us(normalize_date("raw_date", REF)).alias("parsed_us"))


@register("freshness", _EXPECTED + """
SELECT event_id, fmt, verdict, verdict = 'FRESH' AS is_fresh, pub_us AS published_us,
       ref_us - pub_us AS age_us
FROM g""")
def q_freshness(spark, sf):
    d = with_freshness(raw_dates(spark, sf), "raw_date", REF, 24.0, out="f")
    return d.select("event_id", "fmt", F.col("f.verdict").alias("verdict"), F.col("f.is_fresh").alias("is_fresh"),
                    _us(F.col("f.published_at")).alias("published_us"),
                    (_us(F.lit(REF).cast("timestamp")) - _us(F.col("f.published_at"))).alias("age_us"))


@register("filter_fresh", _EXPECTED + """
SELECT event_id, user_id, event_type, pub_us AS published_us FROM g WHERE verdict = 'FRESH'""")
def q_filter_fresh(spark, sf):
    d = with_freshness(raw_dates(spark, sf), "raw_date", REF, 24.0, out="f")
    return (d.filter(F.col("f.is_fresh"))
             .select("event_id", "user_id", "event_type", _us(F.col("f.published_at")).alias("published_us")))
