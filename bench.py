"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion with the ``noop`` sink (full evaluation,
no driver collect).  Times are wall-clock seconds per query after a warm-up.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "freshness", "scan_news_feed", "scan_jobs_json", "scan_jobs_feed", "scan_papers_atom", "scan_startups_json",
    "scan_products_json", "dedup_key", "dedup_first", "insert_if_absent", "resolve_entities", "attach_canonical",
    "html_date", "article_text", "chunk_text", "build_prompts", "extract_batch", "final_outcome",
    "backoff_compliance", "fetch_report", "source_breakdown", "job_papers", "job_startups", "job_products",
    "job_news", "job_jobs",
]


def _default_driver_memory() -> str:
    """About 60% of physical memory, capped at 16g (local mode: the driver is the executor)."""
    try:
        with open("/proc/meminfo") as f:
            kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal:"))
        gb = max(1, min(16, int(kb / 1024 / 1024 * 0.6)))
        return f"{gb}g"
    except Exception:  # noqa: BLE001
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from curata.plans.catalog import queries
    from curata.session import build_session
    spark = build_session(f"local[{cpus}]", app="curata-bench", shuffle_partitions=max(8, cpus * 2),
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", _default_driver_memory()))
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):   # JIT / codegen warm-up on the smallest tables, not timed
        for name in HEADLINE:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    rows_in = 0
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    for t in ("lineitem", "orders", "events", "documents", "pages", "customer", "part"):
        rows_in += spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")).count()
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus, "input_rows": rows_in, "warmup": warm_dir,
                      "rows_per_sec": round(rows_in * len(HEADLINE) / total, 1) if total else None}))


if __name__ == "__main__":
    main()
