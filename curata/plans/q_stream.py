"""Streaming jobs run with an available-now trigger over payload files in the shared folder."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..schemas import PAYLOAD
from ..session import scratch_path
from ..streaming.streams import stream_jobs, stream_news
from .catalog import ORACLES, register
from .derive import REFERENCE_TIME, job_feed_payloads, job_json_payloads, news_feed_payloads
from .q_jobs import JOBS_REFERENCE_TIME
from .q_resolve import LOG_TS


def _land(df, path, mode="errorifexists"):
    cols = [f.name for f in PAYLOAD.fields]
    full = df
    for f in PAYLOAD.fields:
        if f.name not in df.columns:
            full = full.withColumn(f.name, F.lit(None).cast(f.dataType))
    full.select(*[F.col(c).cast(PAYLOAD[c].dataType) for c in cols]).write.mode(mode).parquet(path)


def _in_three_runs(spark, payloads, stream, base, reference_time):
    """The payloads land in three parts in page order, the second and third with some pages of the
    part before once more; the stream stops after each part and goes on from its checkpoint."""
    from ..operators.store import read_store
    last = payloads.agg(F.max("page")).first()[0] or 0
    for part in range(3):
        low, high = last * part // 3, last * (part + 1) // 3
        landing = payloads.filter(F.col("page").between(low - last // 9 if part else 0, high))
        _land(landing, f"{base}/payloads", "append")
        stream(spark, f"{base}/payloads", f"{base}/store", f"{base}/checkpoint", reference_time,
               collected_at=LOG_TS).awaitTermination()
    return read_store(spark, f"{base}/store")


@register("stream_news")
def q_stream_news(spark, sf):
    base = scratch_path(spark, f"stream_news_{uuid.uuid4().hex}")
    s = _in_three_runs(spark, news_feed_payloads(spark, sf), stream_news, base, REFERENCE_TIME)
    return s.select("article_url", "title", F.unix_micros("published_at").alias("published_us"), "dedup_key", "id",
                    "collected_at", "record_type", "extraction_status", "content")


@register("stream_jobs")
def q_stream_jobs(spark, sf):
    base = scratch_path(spark, f"stream_jobs_{uuid.uuid4().hex}")
    payloads = job_json_payloads(spark, sf).unionByName(job_feed_payloads(spark, sf))
    s = _in_three_runs(spark, payloads, stream_jobs, base, JOBS_REFERENCE_TIME)
    return s.select("job_url", "company_name", "canonical_company_name", F.unix_micros("published_at").alias("published_us"),
                    "dedup_key", "id", "collected_at", "record_type")


def _oracles():
    """The batch jobs' rows, and what every stored row carries."""
    def stored(name, kind, more=""):
        return (f"SELECT *, sha256(dedup_key) AS id, '{LOG_TS}' AS collected_at, '{kind}' AS record_type{more} "
                f"FROM ({ORACLES[name]})")
    # 'Event <b>id</b> type' as text
    text = "'Event' || regexp_extract(title, '[0-9]+') || split_part(article_url, '/', 4)"
    ORACLES["stream_news"] = stored("job_news", "NEWS", f", 'skipped' AS extraction_status, {text} AS content")
    ORACLES["stream_jobs"] = stored("job_jobs", "JOB")


_oracles()
