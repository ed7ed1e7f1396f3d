"""Registry of named queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables (or data Spark derives from them) in
full.  An oracle is given wherever plain SQL can state the expected answer;
operators whose answer needs a parser or an iterative algorithm have none and
are checked by unit tests against brute force on small fixtures instead.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run
    return deco


def load_all() -> None:
    from . import q_dates, q_dedup, q_extract, q_jobs, q_ops, q_resolve, q_scans, q_text  # noqa: F401
    from . import q_stream  # noqa: F401  (after q_jobs: reuses its oracles)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
