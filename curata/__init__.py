"""curata: record-curation jobs expressed as Spark DataFrame transforms.

Every public operator is a function ``DataFrame -> DataFrame`` (use it with
``df.transform``) or a ``Column`` builder.  Python workers are only used for
HTML parsing, chunking, fuzzy scoring and user-supplied extraction callables,
always through Arrow-batched pandas UDFs.

Common entry points (imported lazily, so Python workers that unpickle a UDF
only load the module it lives in)::

    from curata import build_session, job_news, job_jobs, stream_news
    spark = build_session("local[8]")
    fresh = job_news(payloads, reference_time="2026-08-15 12:00:00")
"""
from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "iso_or_rfc_date": "functions.dates", "normalize_date": "functions.dates",
    "relative_date": "functions.dates", "with_freshness": "functions.dates",
    "dedup_first": "operators.dedup", "dedup_key": "operators.dedup", "dedup_seen": "operators.dedup",
    "resolve_entities": "operators.resolve", "resolve_names": "operators.resolve",
    "export_tabs": "operators.sinks", "insert_if_absent": "operators.sinks", "write_new": "operators.sinks",
    "job_export": "plans.jobs", "job_jobs": "plans.jobs", "job_metrics": "plans.jobs", "job_news": "plans.jobs",
    "job_papers": "plans.jobs", "job_products": "plans.jobs", "job_startups": "plans.jobs",
    "build_session": "session", "checkpoint_dir": "session", "prepare": "session",
    "stream_jobs": "streaming.streams", "stream_news": "streaming.streams",
}
__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(f".{_EXPORTS[name]}", __name__), name)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
