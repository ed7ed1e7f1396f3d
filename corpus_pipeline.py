"""Corpus pipeline: documents through five stages, each written as Parquet and reread by the next.

quality classifier -> n-gram Jaccard join -> benchmark decontamination -> mixing -> sharding.
A stage's decision is taken per doc_id and takes effect on the rows it read; all but the
last return the columns of ``documents``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm.common import materialize, read_table
from curata.llm.decontaminate import find_leaks
from curata.llm.importance import resample
from curata.llm.jaccard_join import jaccard_components
from curata.llm.mixing import mixed_rows
from curata.llm.sharding import shuffle_into_shards
from curata.session import prepare

SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws; rows of one id (null too) stand or fall together."""
    drawn = resample(docs, read_table(spark, sf_dir, "labels")).filter("kept").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(drawn, docs["doc_id"].eqNullSafe(drawn["id"]), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies (five words, Jaccard 0.8): the smallest id.

    Of rows that share that id the one of the least row hash stays, so reruns agree.  Rows with a
    null id belong to no group and stay; null, empty and blank texts are copies of nothing."""
    first = jaccard_components(docs, width=5, percent=80).filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    mark = max([*docs.columns, "hash"], key=len) + "_"  # clashes with no column
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    known = docs.filter(F.col("doc_id").isNotNull()).withColumn(mark, F.xxhash64(*hashed))
    one = known.groupBy("doc_id").agg(F.min(F.col(f"`{mark}`")).alias(mark)).join(first, "doc_id", "left_semi")
    return known.join(one, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark]).select(
        *(F.col(f"`{c}`") for c in docs.columns)) \
        .unionAll(docs.filter(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs; rows of one id (null too) stand or fall together.
    Null and empty texts hold no item and stay."""
    leaks = find_leaks(docs, read_table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("id")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["id"]), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or up to three times.
    Null and empty texts have size 0; a null source is a source, a null id an id like any other."""
    return mixed_rows(docs, F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row in a shard of exact size: the columns of documents, shard and slot.
    Null ids and null or empty texts are rows like any other."""
    return shuffle_into_shards(docs, SHARDS)


#: (name, function) of each stage; a function takes (spark, docs, sf_dir).
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing), ("sharding", sharding),
]

#: No plain SQL states the sampled stages; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole documents table."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
