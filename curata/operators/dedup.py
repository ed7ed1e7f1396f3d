"""Typed SHA-256 dedup keys, keep-first dedup, store anti-joins, provenance.

Keep-first is an aggregation (``min_by`` over the ordinal), not a window: the
partial aggregate runs map-side, so a key that holds a third of all rows is
collapsed to one row per task before the shuffle instead of being sorted in a
single task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import url_is_http
from ..functions.strings import _c, py_or, py_strip


def dedup_key_text(entity: str, **c) -> Column:
    """The typed key text before hashing.  ``c`` maps field name -> column."""
    g = lambda k: _c(c.get(k, k))
    if entity == "startup":
        parts = ["startup:", py_or(g("canonical_name"), F.lower(g("name"))), ":",
                 py_or(g("website_url"), g("source_url"))]
    elif entity == "product":
        parts = ["product:", py_or(g("canonical_name"), F.lower(g("name"))), ":",
                 py_or(g("product_url"), g("source_url"))]
    elif entity == "paper":
        parts = ["paper:", F.lower(py_strip(g("paper_url")))]
    elif entity == "job":
        parts = ["job:", F.lower(g("company_name")), ":", F.lower(g("role_title")), ":",
                 py_strip(g("job_url"))]
    elif entity == "news":
        parts = ["news:", F.lower(py_strip(g("article_url")))]
    else:
        parts = ["generic:", F.lower(py_strip(g("source_url")))]
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("None")) for p in parts])


def dedup_key(entity: str, **cols) -> Column:
    """64-hex SHA-256 of the typed key text."""
    return F.sha2(dedup_key_text(entity, **cols), 256)


def with_dedup_key(df: DataFrame, entity: str, out: str = "dedup_key", **cols) -> DataFrame:
    return df.withColumn(out, dedup_key(entity, **cols))


def dedup_first(df: DataFrame, key: str = "dedup_key", order: str = "ord") -> DataFrame:
    """Keep the first row (smallest ``order``) of every key."""
    cols = df.columns
    payload = [c for c in cols if c != key]
    return (df.groupBy(key)
              .agg(F.min_by(F.struct(*payload), F.col(order)).alias("_r"))
              .select(key, *[F.col("_r")[c].alias(c) for c in payload])
              .select(*cols))


def dedup_seen(df: DataFrame, store: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Rows whose key is not already stored (reads only the key column of the store)."""
    return df.join(store.select(key), key, "left_anti")


def dedup_name_priority(df: DataFrame, name: str = "name", order: str = "ord",
                        valid: str | None = "is_valid") -> DataFrame:
    """First *valid* row per lower(strip(name)); rejected rows claim nothing."""
    src = df.filter(F.col(valid)) if valid else df
    k = "_name_key"
    return dedup_first(src.withColumn(k, F.lower(py_strip(name))), k, order).drop(k)


def dedup_listing_id(df: DataFrame, listing_id: str = "listing_id", order: str = "ord") -> DataFrame:
    return dedup_first(df, listing_id, order)


def provenance_check(df: DataFrame, table: str, source_url: str = "source_url") -> DataFrame:
    """One row: table, rows, rows with an http(s) source_url, all-valid flag."""
    ok = url_is_http(source_url)
    return df.agg(F.lit(table).alias("table_name"),
                  F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(ok).alias("n_valid"),
                  F.coalesce(F.bool_and(ok), F.lit(True)).alias("provenance_valid"))
