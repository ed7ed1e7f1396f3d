"""Reading the driver tables (one parquet file per table)."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import small_batches

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full scan of one driver table; its splits are the session's business
    (``spark.sql.files.minPartitionNum``, ``maxPartitionBytes``)."""
    small_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
