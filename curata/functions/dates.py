"""Date normalisation and the freshness verdict, as native Spark expressions.

Semantics (all results are UTC instants):

* ``iso_or_rfc_date`` accepts exactly six ISO-8601 shapes (``Z``/offset with and
  without fraction, ``Y-m-d H:M:S`` and ``Y-m-d``; zone-less = UTC) and RFC-2822
  dates.  A zone-less ``T`` form such as ``2026-08-15T10:00:00`` is *not*
  accepted, and neither is ``Aug 15, 2026``.
* ``relative_date`` understands "just now", "today", "yesterday" and
  ``<n> sec|min|hr|hour|day|d[s] ago`` anywhere in the text.
* ``freshness`` yields the verdict struct used by the news and job jobs.

The reference time is always an explicit argument so re-runs are reproducible.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c, py_strip

# --- fixed values -----------------------------------------------------------
# Accepted ISO-8601 shapes, as Spark datetime patterns (fraction: 1-6 digits).
ISO_PATTERNS = [
    "yyyy-M-d'T'H:m:s[.SSSSSS]XXX",   # ...Z, ...+05:30 (also .ffffff forms)
    "yyyy-M-d'T'H:m:s[.SSSSSS]XX",    # ...+0530
    "yyyy-M-d H:m:s",
    "yyyy-M-d",
]
# RFC-2822 zone names with their fixed offsets in minutes (Python email.utils).
RFC_ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun",
          "jul", "aug", "sep", "oct", "nov", "dec",
          "january", "february", "march", "april", "may", "june", "july",
          "august", "september", "october", "november", "december"]
DAY_NAMES = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
NOW_WORDS = ["just now", "moments ago", "right now"]
RELATIVE_PATTERN = r"(?U)(\d+)\s*(sec|second|min|minute|hr|hour|day|d)s?\s*ago"
REASON_MISSING = "REJECTED: Missing publication date"
REASON_UNPARSEABLE = "REJECTED: Unparseable date format"
REASON_FUTURE = "REJECTED: Future publication timestamp"
REASON_FRESH_PREFIX = "VERIFIED_FRESH: "
REASON_STALE_PREFIX = "REJECTED_STALE: "
FUTURE_TOLERANCE_SECONDS = 300
# ---------------------------------------------------------------------------

_US = {"sec": 1_000_000, "min": 60_000_000, "hr": 3_600_000_000, "day": 86_400_000_000}


def ts_literal(value) -> Column:
    """A UTC timestamp literal from a datetime, ISO string or Column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    s = str(value).replace("T", " ").rstrip("Z")
    return F.to_timestamp(F.lit(s))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body`` (keeps plans small)."""
    return F.get(F.transform(F.array(value), body), 0)


def _lookup(mapping: dict) -> Column:
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])


def _month_index(tok: Column) -> Column:
    return F.try_element_at(_lookup({m: i % 12 + 1 for i, m in enumerate(MONTHS)}), F.lower(tok))


def _zone_minutes(tok: Column) -> Column:
    """Offset in minutes; null means 'no zone' (naive -> UTC)."""
    named = F.try_element_at(_lookup(RFC_ZONES), F.upper(tok))
    sign = F.when(F.substring(tok, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.regexp_extract(tok, r"^[+-](\d{2})(\d{2})$", 1).try_cast("int")
    mm = F.regexp_extract(tok, r"^[+-](\d{2})(\d{2})$", 2).try_cast("int")
    return F.coalesce(named, sign * (hh * 60 + mm))


def rfc2822_date(col) -> Column:
    """RFC-2822 date (weekday optional, seconds optional, 2- or 4-digit year,
    day/month in either order, numeric or named zone; unknown zone = UTC)."""
    cleaned = F.regexp_replace(F.regexp_replace(py_strip(col), r"(?U)\s+", " "),
                               r"^(?i)(?:[^ ]*, ?|(?:mon|tue|wed|thu|fri|sat|sun) )", "")
    return let(cleaned, _rfc_body)


_RFC_CORE = (r"^(\d{1,2}|[A-Za-z]+),? ([A-Za-z]+|\d{1,2}),? (\d{2,4}),? "
             r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?,?(?: ?([^ ]*))?$")


def _rfc_body(s: Column) -> Column:
    core = _RFC_CORE
    g = lambda i: F.regexp_extract(s, core, i)
    a, b = g(1), g(2)
    b_month = _month_index(b)
    month = F.coalesce(b_month, _month_index(a))
    day = F.when(b_month.isNotNull(), a).otherwise(b).try_cast("int")
    yy = g(3).try_cast("int")
    year = F.when(yy < 100, F.when(yy > 68, yy + 1900).otherwise(yy + 2000)).otherwise(yy)
    ss = F.coalesce(g(6).try_cast("int"), F.lit(0))
    zmin = F.coalesce(_zone_minutes(g(7)), F.lit(0))
    local = F.try_make_timestamp_ntz(year, month, day, g(4).try_cast("int"), g(5).try_cast("int"), ss)
    utc_us = F.unix_micros(local.cast("timestamp")) - zmin.cast("long") * 60_000_000
    return F.when(s.rlike(core), F.timestamp_micros(utc_us))


_ISO_T = r"^\d{4}-\d{1,2}-\d{1,2}T"
_ISO_SPACE = r"^\d{4}-\d{1,2}-\d{1,2} "
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_COMPACT_OFFSET = r"[+-]\d{4}$"


def _iso_rfc_body(s: Column) -> Column:
    """Parse an already-stripped string.  Each pattern is only tried when a cheap
    anchored test says it can match (a failing parse is costly), and RFC-2822
    only when no ISO shape applies."""
    iso_t = s.rlike(_ISO_T)
    iso = (F.when(iso_t & s.rlike(_COMPACT_OFFSET), F.try_to_timestamp(s, F.lit(ISO_PATTERNS[1])))
            .when(iso_t, F.try_to_timestamp(s, F.lit(ISO_PATTERNS[0])))
            .when(s.rlike(_ISO_SPACE), F.try_to_timestamp(s, F.lit(ISO_PATTERNS[2])))
            .when(s.rlike(_ISO_DATE), F.try_to_timestamp(s, F.lit(ISO_PATTERNS[3]))))
    return F.when(s != "", F.coalesce(iso, F.when(~iso_t, rfc2822_date(s))))


def iso_or_rfc_date(col) -> Column:
    """Strict ISO-8601 shapes first, then RFC-2822; null if nothing parses."""
    return F.when(_c(col).isNotNull(), let(py_strip(col), _iso_rfc_body))


def relative_date(col, reference_time) -> Column:
    """'just now' / 'today' / 'yesterday' / '<n> <unit> ago' against the reference time."""
    ref = ts_literal(reference_time)
    return F.when(_c(col).isNotNull() & (_c(col) != ""),
                  let(F.lower(py_strip(col)), lambda t: _relative_body(t, ref)))


FIRST_MICROS = -62_135_596_800_000_000  # 0001-01-01T00:00:00Z


def _relative_body(t: Column, ref: Column) -> Column:
    digits = F.regexp_extract(t, RELATIVE_PATTERN, 1)
    unit = F.regexp_extract(t, RELATIVE_PATTERN, 2)
    unit_us = (F.when(unit.startswith("sec"), F.lit(_US["sec"]))
                .when(unit.startswith("min"), F.lit(_US["min"]))
                .when(unit.startswith("hr") | unit.startswith("hour"), F.lit(_US["hr"]))
                .when(unit.startswith("day") | (unit == "d"), F.lit(_US["day"])))
    # an age that leaves the calendar (before year 1, or any overflow) is unparseable
    micros = F.try_subtract(F.unix_micros(ref), F.try_multiply(digits.try_cast("long"), unit_us))
    ago = F.when(micros >= F.lit(FIRST_MICROS), F.timestamp_micros(micros))
    return (F.when(t.isin(*NOW_WORDS), ref)
             .when(t == "today", F.date_trunc("day", ref))
             .when(t == "yesterday", F.date_trunc("day", ref - F.expr("INTERVAL 1 DAY")))
             .otherwise(ago))


def with_parsed_date(df, raw: str, reference_time, out: str = "parsed_at", html_ts: Column | None = None):
    """DataFrame form of :func:`normalize_date`: the stripped text is computed once
    in its own projection and the parsers reference it by name (whole-stage codegen,
    no per-row lambda)."""
    r = F.col(raw)
    d = df.withColumn("_s", F.when(r.isNotNull() & (r != ""), py_strip(r)))
    d = d.withColumns({"_abs": _iso_rfc_body(F.col("_s")), "_low": F.lower(F.col("_s"))})
    rel = _relative_body(F.col("_low"), ts_literal(reference_time))
    d = d.withColumn(out, F.coalesce(F.col("_abs"), rel, html_ts) if html_ts is not None
                     else F.coalesce(F.col("_abs"), rel))
    return d.drop("_s", "_abs", "_low")


def normalize_date(raw, reference_time, html_ts: Column | None = None) -> Column:
    """Raw string (ISO/RFC, then relative), else a date taken from the page HTML."""
    r = _c(raw)
    from_raw = F.when(r.isNotNull() & (r != ""),
                      F.coalesce(iso_or_rfc_date(r), relative_date(r, reference_time)))
    if html_ts is None:
        return from_raw
    return F.coalesce(from_raw, html_ts)


def verdict_struct(ts, missing, reference_time, max_age_hours: float = 24.0) -> Column:
    """Verdict struct from an already-parsed timestamp column (reference it by name)."""
    ref = ts_literal(reference_time)
    t = _c(ts)
    m = _c(missing)
    age_s = (F.unix_micros(ref) - F.unix_micros(t)) / F.lit(1_000_000.0)
    age_h = age_s / F.lit(3600.0)
    verdict = (F.when(m, F.lit("MISSING"))
                .when(t.isNull(), F.lit("UNPARSEABLE"))
                .when(age_s < -FUTURE_TOLERANCE_SECONDS, F.lit("FUTURE"))
                .when(age_h <= F.lit(float(max_age_hours)), F.lit("FRESH"))
                .otherwise(F.lit("STALE")))
    hours_txt = F.format_string("%.2f", age_h)
    reason = (F.when(m, F.lit(REASON_MISSING))
               .when(t.isNull(), F.lit(REASON_UNPARSEABLE))
               .when(age_s < -FUTURE_TOLERANCE_SECONDS, F.lit(REASON_FUTURE))
               .when(age_h <= F.lit(float(max_age_hours)), F.concat(F.lit(REASON_FRESH_PREFIX), hours_txt, F.lit("h old")))
               .otherwise(F.concat(F.lit(REASON_STALE_PREFIX), hours_txt, F.lit("h old"))))
    return F.struct(
        (verdict == "FRESH").alias("is_fresh"),
        t.alias("published_at"),
        F.when(t.isNotNull(), age_h).alias("age_hours"),
        verdict.alias("verdict"),
        reason.alias("reason"),
    )


def with_freshness(df, raw: str, reference_time, max_age_hours: float = 24.0,
                   out: str = "freshness", html: str | None = None):
    """Adds the verdict struct ``out``: is_fresh, published_at, age_hours, verdict, reason.

    ``verdict`` is one of MISSING, UNPARSEABLE, FUTURE, FRESH, STALE; ``reason``
    is the display text (its ``%.2f`` uses Spark rounding: display only).  With
    ``html`` (a page column) a date embedded in the page is the fallback.
    The parsed instant is computed once in its own projection.
    """
    r = F.col(raw)
    missing = r.isNull() | (r == "")
    html_ts = None
    if html is not None:
        from .html import html_date
        missing = missing & (F.col(html).isNull() | (F.col(html) == ""))
        df = df.withColumn("_html_ts", html_date(F.col(html), reference_time))
        html_ts = F.col("_html_ts")
    df = with_parsed_date(df.withColumn("_missing", missing), raw, reference_time, "_pub", html_ts)
    pub = F.when(~F.col("_missing"), F.col("_pub"))
    df = df.withColumn("_pub", pub)
    # as a generated column the verdict is computed once: a filter on it is not pushed below the
    # generator, where it would repeat the whole date rule
    kept = [c for c in df.columns if c not in ("_pub", "_missing", "_html_ts", out)]
    verdict = verdict_struct("_pub", "_missing", reference_time, max_age_hours)
    return df.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.array(verdict)).alias(out))


def iso_utc_string(ts) -> Column:
    """Python ``datetime.isoformat()`` of an aware UTC datetime."""
    t = _c(ts)
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, ".SSSSSS")
    return F.when(t.isNotNull(), F.concat(base, F.when(F.unix_micros(t) % 1_000_000 != 0, frac).otherwise(F.lit("")),
                                          F.lit("+00:00")))
