"""Counts and breakdowns over curated tables (one aggregation each)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PRICING_TYPES

# --- fixed values -----------------------------------------------------------
METRIC_NAMES = ["records_discovered", "records_processed", "records_rejected", "duplicates",
                "fresh_records", "stale_records", "entity_matches", "github_stars_enriched",
                "deterministic_extractions", "llm_extractions_attempted", "llm_extractions_skipped",
                "gemini_429s", "llm_fallbacks"]
PRICING_REPORT_ORDER = ["UNKNOWN", "FREE", "PAID", "FREEMIUM"]
SAMPLE_TITLE_CHARS = 60
# ---------------------------------------------------------------------------


def source_breakdown(df: DataFrame, source: str = "source_name", text: str = "content") -> DataFrame:
    """Records per source and their average text length (code points)."""
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("records"),
                                  F.avg(F.length(text).cast("long")).alias("avg_text_len"))


def source_samples(df: DataFrame, k: int = 3, source: str = "source_name", order: str = "ord",
                   title: str = "title", text: str = "content") -> DataFrame:
    """First ``k`` rows per source (top-k is the feature) with truncated title and length."""
    w = Window.partitionBy(source).orderBy(order)
    r = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return r.select(source, "rank", F.substring(title, 1, SAMPLE_TITLE_CHARS).alias("title_sample"),
                    F.length(text).cast("long").alias("text_len"))


def pricing_breakdown(products: DataFrame, pricing: str = "pricing_type") -> DataFrame:
    """Count per pricing type, every enum value present (zeros included)."""
    spark = products.sparkSession
    enum = spark.createDataFrame([(p,) for p in PRICING_TYPES], "pricing_type string")
    c = products.groupBy(F.col(pricing).alias("pricing_type")).agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(enum).join(c, "pricing_type", "left")
             .select("pricing_type", F.coalesce("n", F.lit(0)).cast("long").alias("records")))


def coverage_report(df: DataFrame, key: str = "dedup_key", valid: str | None = None,
                    with_repo: str | None = None, enriched: str | None = None) -> DataFrame:
    """discovered / valid / unique, plus repo coverage for papers."""
    aggs = [F.count(F.lit(1)).alias("discovered"),
            (F.count_if(F.col(valid)) if valid else F.count(F.lit(1))).alias("valid"),
            F.count_distinct(key).alias("unique_keys")]
    if with_repo:
        aggs += [F.count_if(F.col(with_repo).isNotNull()).alias("with_repo"),
                 F.count_if(F.col(with_repo).isNull()).alias("without_repo")]
    if enriched:
        aggs.append(F.count_if(F.col(enriched).isNotNull()).alias("stars_enriched"))
    return df.agg(*aggs)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table plus a 'total' row (one small aggregate per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    total = u.agg(F.lit("total").alias("table_name"), F.sum("rows").cast("long").alias("rows"))
    return u.unionByName(total)


def run_metrics(**counts) -> DataFrame:
    """One-row metrics table.  Each value is an int or a DataFrame whose single
    row / first column holds the count; the parts are unioned as (metric, value)
    rows and folded into one row by a single global aggregate."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    parts = [spark.createDataFrame([(n, 0)], "metric string, value long") for n in METRIC_NAMES]
    for name, v in counts.items():
        if isinstance(v, DataFrame):
            parts.append(v.select(F.lit(name).alias("metric"), F.col(v.columns[0]).cast("long").alias("value")))
        else:
            parts.append(spark.createDataFrame([(name, int(v))], "metric string, value long"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.sum(F.when(F.col("metric") == n, F.col("value")).otherwise(F.lit(0))).cast("long").alias(n)
                   for n in METRIC_NAMES])
