"""The curated store: Parquet written once per batch, counted only by its commit record.

``<store>/data/attempt=<name>/``   the rows of one write attempt
``<store>/commits/<version>.json`` one record per batch: (version, batch_id, attempt, keys)

Readers see the attempts that a commit record names and nothing else, so a batch that was
half written, or written by a task that ran twice, is neither read nor counted.  A batch id is
committed once: writing it again saves nothing.  Two writers may work at a time: a version can
be claimed by one of them only, and the other takes the keys committed meanwhile out of its
attempt before it claims the next version, so a key is stored once.

The record is written beside its place and renamed into it.  Between machines that needs a file
system whose rename is atomic and does not overwrite (HDFS and its like).
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from .sinks import insert_if_absent

COMMIT = "version long, batch_id string, attempt string, keys long"


def commits(spark: SparkSession, store: str) -> DataFrame:
    """The commit records of a store (none before its first batch)."""
    try:
        return spark.read.schema(COMMIT).json(f"{store}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _records(spark: SparkSession, store: str) -> list[Row]:
    return sorted(commits(spark, store).collect(), key=lambda r: r["version"])  # one small row per batch


def _attempts(spark: SparkSession, store: str, records: list[Row]) -> DataFrame | None:
    paths = [_folder(store, r["attempt"]) for r in records if r["keys"]]
    return spark.read.option("basePath", f"{store}/data").parquet(*paths).drop("attempt") if paths else None


def _folder(store: str, attempt: str) -> str:
    return f"{store}/data/attempt={attempt}"


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """All committed rows, or None before the first."""
    return _attempts(spark, store, _records(spark, store))


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _claim(spark: SparkSession, store: str, record: dict) -> bool:
    """Make ``record`` the commit of its version; False if that version is taken."""
    target, fs = _path(spark, f"{store}/commits/{record['version']:012d}.json")
    draft, _ = _path(spark, f"{store}/commits/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    if not fs.exists(target) and fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False


def _write(df: DataFrame, store: str, partition_by: list[str]) -> tuple[str, int]:
    """A new attempt with the rows of ``df``, and their number as read back from its files."""
    attempt = uuid.uuid4().hex
    df.write.partitionBy(*partition_by).parquet(_folder(store, attempt))
    try:
        return attempt, df.sparkSession.read.schema(df.schema).parquet(_folder(store, attempt)).count()
    except AnalysisException:  # partitions of no rows are no folder
        return attempt, 0


def commit_batch(incoming: DataFrame, store: str, batch_id: str, key: str = "dedup_key", order: str = "ord",
                 partition_by: list[str] | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Store the first row (by ``order``) of every key of ``incoming`` that the store lacks, as batch
    ``batch_id``; returns the number of rows this call saved: 0 if the batch is there already.

    ``finish`` adds what only new rows need (texts, names, ids) before they are written.  ``incoming``
    is evaluated once.  Of the stored rows only the key column is read.
    """
    spark = incoming.sparkSession
    seen = _records(spark, store)
    if any(r["batch_id"] == batch_id for r in seen):
        return 0
    new = insert_if_absent(incoming, _attempts(spark, store, seen), key, order)
    new = finish(new) if finish else new
    attempt, keys = _write(new, store, partition_by or [])
    while True:
        version = seen[-1]["version"] + 1 if seen else 0
        if _claim(spark, store, {"version": version, "batch_id": batch_id, "attempt": attempt, "keys": keys}):
            return keys
        now = _records(spark, store)
        later, seen = [r for r in now if r["version"] >= version], now
        lost = _folder(store, attempt)
        if any(r["batch_id"] == batch_id for r in later):  # the other writer stored this very batch
            attempt, keys = "", 0
        elif keys and (taken := _attempts(spark, store, later)) is not None:
            mine = spark.read.schema(new.schema).parquet(lost)
            attempt, keys = _write(mine.join(taken.select(key), key, "left_anti").select(*mine.columns), store, partition_by or [])
        else:
            continue
        path, fs = _path(spark, lost)
        fs.delete(path, True)
        if not attempt:
            return 0


def remove_abandoned(spark: SparkSession, store: str, older_than_s: float = 7 * 86400) -> int:
    """Delete attempts without a commit record that nobody has touched for ``older_than_s`` seconds;
    returns how many.  A running writer's attempt is younger."""
    import time
    path, fs = _path(spark, f"{store}/data")
    if not fs.exists(path):
        return 0
    named = {r["attempt"] for r in _records(spark, store)}
    gone = [s.getPath() for s in fs.listStatus(path)
            if s.getPath().getName().removeprefix("attempt=") not in named
            and s.getModificationTime() / 1000 < time.time() - older_than_s]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def new_version(spark: SparkSession, store: str, write: Callable[[str], None]) -> None:
    """``write`` a whole new state of ``store`` into the folder it is given, then make it the current one.
    Of two writers the one that ends last wins; if ``write`` fails nothing changes."""
    attempt = uuid.uuid4().hex
    write(_folder(store, attempt))
    while True:
        seen = _records(spark, store)
        version = seen[-1]["version"] + 1 if seen else 0
        if _claim(spark, store, {"version": version, "batch_id": attempt, "attempt": attempt, "keys": 0}):
            return


def current_version(spark: SparkSession, store: str) -> str | None:
    """The folder that the last commit record names."""
    seen = _records(spark, store)
    return _folder(store, seen[-1]["attempt"]) if seen else None
