"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import BATCH_BYTES, checkpoint_dir, small_batches  # noqa: F401

#: A word is a maximal run of characters other than ASCII whitespace.
SPACE_RUN = r"[\x20\x09-\x0D]+"

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole input table, through Spark's reader (any file system)."""
    small_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files every executor can read, so later jobs see one
    fixed state (row order and partition numbers included) and a lost executor
    costs a re-read, never another computation.
    """
    small_batches(df.sparkSession)
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, name: str) -> None:
    """Delete the folder ``name`` of working tables that ``materialize`` wrote as ``name``/..."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def slices(batches: Iterator, max_bytes: int = 16 << 20) -> Iterator:
    """Arrow batches cut into pieces of about ``max_bytes`` (one row at least), so
    that a task's working memory does not depend on how long the texts are."""
    for batch in batches:
        step = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
