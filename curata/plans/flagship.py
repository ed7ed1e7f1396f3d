"""The flagship query used by ``entry``: fresh, de-duplicated news per source."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import with_freshness
from ..operators.dedup import dedup_first, dedup_key
from ..session import prepare
from .derive import REFERENCE_TIME, raw_dates


def fresh_unique_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    d = raw_dates(spark, sf_dir)
    news = (d.withColumn("source_name", F.col("event_type"))
             .withColumn("article_url", F.concat(F.lit("https://news.example.com/"), F.col("event_type"),
                                                 F.lit("/"), F.col("user_id").cast("string")))
             .withColumn("ord", F.col("event_id")))
    f = with_freshness(news, "raw_date", REFERENCE_TIME, 24.0, out="f").filter(F.col("f.is_fresh"))
    keyed = f.withColumn("dedup_key", dedup_key("news", article_url="article_url"))
    first = dedup_first(keyed.select("dedup_key", "ord", "source_name", "article_url"), "dedup_key", "ord")
    return first.groupBy("source_name").agg(F.count(F.lit(1)).alias("fresh_unique"))
