"""Fetch-log analytics: the crawl retry policy as queries over an attempt log.

Attempt log columns: ``url, source_name, attempt (0-based), status_code
(null on transport error), error, ts (timestamp), latency_ms`` and, if the
crawler wrote one, ``crawl_id``.  A url is crawled many times; every operator
here works per crawl (see :func:`with_crawl`).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import _c

# --- fixed values -----------------------------------------------------------
TERMINAL_STATUSES = [404, 403]
RETRYABLE_STATUSES = [429, 500, 502, 503, 504]
MAX_RETRIES = 4
INITIAL_BACKOFF_S = 1.0
BACKOFF_FACTOR = 2.0
MAX_BACKOFF_S = 30.0
JITTER = (0.5, 1.5)
FAILED_STATUS = 500
# ---------------------------------------------------------------------------


def classify_fetch(status="status_code") -> Column:
    """success (200) | terminal (404, 403) | retryable (429, 5xx, transport errors, anything else)."""
    s = _c(status)
    return (F.when(s == 200, F.lit("success"))
             .when(s.isin(*TERMINAL_STATUSES), F.lit("terminal"))
             .otherwise(F.lit("retryable")))


def with_crawl(attempts: DataFrame) -> DataFrame:
    """Adds ``crawl``: the log's ``crawl_id``, else the start (microseconds) of the attempt's crawl.

    Without ids a crawl starts at each attempt 0.  The start is carried forward day by day: the
    window over a url holds one row per day and the other one day of attempts, so a feed polled
    every minute for years is not sorted in one task.  Attempts before a url's first attempt 0
    form one crawl with a null start.
    """
    if "crawl_id" in attempts.columns:
        return attempts.withColumn("crawl", F.col("crawl_id"))
    a = (attempts.withColumn("_day", F.to_date("ts"))
                 .withColumn("_start", F.when(F.col("attempt") == 0, F.unix_micros("ts"))))
    so_far = Window.partitionBy("url").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (a.groupBy("url", "_day").agg(F.max("_start").alias("_last"))
             .select(F.col("url").alias("_u"), F.col("_day").alias("_d"),
                     F.last("_last", ignorenulls=True).over(so_far).alias("_carried")))
    in_day = (Window.partitionBy("url", "_day").orderBy("ts", "attempt")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = a.join(days, F.col("url").eqNullSafe(F.col("_u")) & F.col("_day").eqNullSafe(F.col("_d")), "left")
    start = F.coalesce(F.last("_start", ignorenulls=True).over(in_day), F.col("_carried"))
    return j.withColumn("crawl", start).drop("_day", "_start", "_u", "_d", "_carried")


def final_outcome(attempts: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """One row per url and crawl: last attempt, retries used, final status / error / outcome."""
    a = with_crawl(attempts).withColumn("_cls", classify_fetch("status_code"))
    last = (a.groupBy("url", "crawl")
             .agg(F.max_by(F.struct("attempt", "status_code", "error", "_cls"), F.col("attempt")).alias("l"),
                  F.count(F.lit(1)).alias("n_attempts")))
    exhausted = F.col("l._cls").eqNullSafe("retryable") & (F.col("l.attempt") >= max_retries)
    outcome = (F.when(F.col("l._cls") == "success", F.lit("success"))
                .when(F.col("l._cls") == "terminal", F.lit("rejected"))
                .when(exhausted, F.lit("failed"))
                .otherwise(F.lit("pending")))
    return last.select(
        "url", "crawl", "n_attempts", F.col("l.attempt").alias("retries"),
        F.when(exhausted, F.lit(FAILED_STATUS)).otherwise(F.col("l.status_code")).alias("final_status"),
        F.when(exhausted, F.lit(f"Failed after {max_retries} retries")).otherwise(F.col("l.error")).alias("final_error"),
        outcome.alias("outcome"))


def policy_wait_s(n) -> Column:
    """min(initial * factor^n, max) seconds before retry n+1 (jitter excluded)."""
    return F.least(F.lit(INITIAL_BACKOFF_S) * F.pow(F.lit(BACKOFF_FACTOR), _c(n).cast("double")),
                   F.lit(MAX_BACKOFF_S))


def backoff_compliance(attempts: DataFrame) -> DataFrame:
    """Per retry: gap since the previous attempt's response vs the jittered policy window.

    The previous attempt is the one before it in the same crawl, so there is one row per attempt
    that has a predecessor.  ``missing`` counts attempts the log lacks between the two; the waits
    cannot be judged then and both verdicts are null.
    """
    w = Window.partitionBy("url", "crawl").orderBy("attempt", "ts")
    a = with_crawl(attempts).withColumns({
        "_prev_ts": F.lag("ts").over(w), "_prev_lat": F.lag("latency_ms").over(w),
        "_prev_attempt": F.lag("attempt").over(w)}).filter(F.col("_prev_attempt").isNotNull())
    missing = (F.col("attempt") - F.col("_prev_attempt") - 1).cast("long")
    gap_us = F.unix_micros(F.col("ts")) - F.unix_micros(F.col("_prev_ts"))
    wait = policy_wait_s(F.col("_prev_attempt"))
    sleep_ms = gap_us / F.lit(1000.0) - F.coalesce(F.col("_prev_lat"), F.lit(0.0))
    lo = wait * F.lit(JITTER[0] * 1000.0)
    hi = wait * F.lit(JITTER[1] * 1000.0)
    return a.select("url", "crawl", "attempt", missing.alias("missing"), gap_us.alias("gap_us"),
                    (wait * 1000.0).alias("policy_wait_ms"),
                    F.when(missing == 0, sleep_ms < lo).alias("too_early"),
                    F.when(missing == 0, sleep_ms > hi).alias("too_late"))


def fetch_report(attempts: DataFrame, source: str = "source_name", accuracy: int = 10000) -> DataFrame:
    """Per source: attempts, urls, successful urls, retries, latency quantiles (approximate)."""
    a = attempts.withColumn("_cls", classify_fetch("status_code"))
    return a.groupBy(source).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_distinct("url").alias("urls"),
        F.count_if(F.col("_cls") == "success").alias("successes"),
        F.count_if(F.col("attempt") > 0).alias("retries"),
        F.percentile_approx("latency_ms", 0.5, accuracy).alias("latency_p50"),
        F.max("latency_ms").alias("latency_max"))
