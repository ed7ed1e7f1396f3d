"""Dedup keys, keep-first, store anti-joins, name/listing priority, provenance."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.dedup import (dedup_first, dedup_key, dedup_listing_id, dedup_name_priority,
                               dedup_seen, provenance_check)
from ..operators.enrich import anti_join_store
from ..operators.sinks import insert_if_absent
from ..operators.store import commit_batch, read_store
from ..session import scratch_path
from .catalog import register
from .tables import table


def _key_rows(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    startups = c.select(F.lit("startup").alias("entity"), k.alias("rec_id"), dedup_key(
        "startup", name=F.col("c_name"),
        canonical_name=F.when(k % 3 == 1, F.lit("")).when(k % 3 == 2, F.upper("c_mktsegment")),
        website_url=F.when(k % 2 == 0, F.concat(F.lit("https://c"), k.cast("string"), F.lit(".example.com"))),
        source_url=F.concat(F.lit("https://directory.example.com/n/"), F.col("c_nationkey").cast("string"))
    ).alias("dedup_key"))
    p = table(spark, sf, "part")
    pk = F.col("p_partkey")
    products = p.select(F.lit("product").alias("entity"), pk.alias("rec_id"), dedup_key(
        "product", name=F.col("p_name"), canonical_name=F.lit(None),
        product_url=F.when(pk % 2 == 0, F.concat(F.lit("https://huggingface.co/spaces/"),
                                                 F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit("/"),
                                                 F.replace("p_name", F.lit(" "), F.lit("-")))).otherwise(F.lit("")),
        source_url=F.concat(F.lit("https://listings.example.com/"), F.col("p_brand"))).alias("dedup_key"))
    o = table(spark, sf, "orders")
    papers = o.select(F.lit("paper").alias("entity"), F.col("o_orderkey").alias("rec_id"), dedup_key(
        "paper", paper_url=F.concat(F.lit("  HTTP://Arxiv.Example.org/abs/"), F.col("o_orderkey").cast("string"),
                                    F.lit(" "))).alias("dedup_key"))
    s = table(spark, sf, "supplier")
    jobs = s.select(F.lit("job").alias("entity"), F.col("s_suppkey").alias("rec_id"), dedup_key(
        "job", company_name=F.col("s_name"),
        role_title=F.concat(F.lit("Role "), F.col("s_nationkey").cast("string")),
        job_url=F.concat(F.lit(" https://jobs.example.com/S/"), F.col("s_suppkey").cast("string"), F.lit(" "))
    ).alias("dedup_key"))
    pg = table(spark, sf, "pages")
    news = pg.select(F.lit("news").alias("entity"), F.col("page_id").alias("rec_id"),
                     dedup_key("news", article_url=F.col("url")).alias("dedup_key"))
    return startups.unionByName(products).unionByName(papers).unionByName(jobs).unionByName(news)


@register("dedup_key", """
SELECT 'startup' AS entity, c_custkey AS rec_id, sha256('startup:' ||
  coalesce(nullif(CASE WHEN c_custkey % 3 = 1 THEN '' WHEN c_custkey % 3 = 2 THEN upper(c_mktsegment) END, ''),
           lower(c_name)) || ':' ||
  coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'https://c' || c_custkey || '.example.com' END,
           'https://directory.example.com/n/' || c_nationkey)) AS dedup_key FROM customer
UNION ALL
SELECT 'product', p_partkey, sha256('product:' || lower(p_name) || ':' ||
  coalesce(nullif(CASE WHEN p_partkey % 2 = 0 THEN 'https://huggingface.co/spaces/' ||
                       lower(replace(p_brand, '#', '')) || '/' || replace(p_name, ' ', '-') ELSE '' END, ''),
           'https://listings.example.com/' || p_brand)) FROM part
UNION ALL
SELECT 'paper', o_orderkey, sha256('paper:' || lower(trim('  HTTP://Arxiv.Example.org/abs/' || o_orderkey || ' ')))
FROM orders
UNION ALL
SELECT 'job', s_suppkey, sha256('job:' || lower(s_name) || ':' || lower('Role ' || s_nationkey) || ':' ||
  trim(' https://jobs.example.com/S/' || s_suppkey || ' ')) FROM supplier
UNION ALL
SELECT 'news', page_id, sha256('news:' || lower(trim(url))) FROM pages""")
def q_dedup_key(spark, sf):
    return _key_rows(spark, sf)


def _lineitem_products(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        dedup_key("product", name=F.concat(F.lit("part-"), F.col("l_partkey").cast("string")),
                  canonical_name=F.lit(None),
                  product_url=F.concat(F.lit("https://huggingface.co/spaces/s"), F.col("l_suppkey").cast("string"),
                                       F.lit("/part-"), F.col("l_partkey").cast("string")),
                  source_url=F.lit("https://listings.example.com/")).alias("dedup_key"),
        F.struct("l_orderkey", "l_linenumber").alias("ord"), "l_orderkey", "l_linenumber")


@register("dedup_first", """
WITH k AS (SELECT sha256('product:part-' || l_partkey || ':https://huggingface.co/spaces/s' || l_suppkey ||
                         '/part-' || l_partkey) AS dedup_key, l_orderkey, l_linenumber FROM lineitem)
SELECT dedup_key, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY l_orderkey, l_linenumber) AS rn FROM k)
WHERE rn = 1""")
def q_dedup_first(spark, sf):
    return dedup_first(_lineitem_products(spark, sf), "dedup_key", "ord").drop("ord")


def _order_jobs(spark, sf):
    o = table(spark, sf, "orders")
    url = F.concat(F.lit("https://jobs.example.com/"), F.col("o_custkey").cast("string"), F.lit("/"),
                   F.replace("o_orderpriority", F.lit(" "), F.lit("_")))
    return o.select(dedup_key("job", company_name=F.concat(F.lit("Cust"), F.col("o_custkey").cast("string")),
                              role_title=F.col("o_orderpriority"), job_url=url).alias("dedup_key"),
                    F.col("o_orderkey").alias("ord"), "o_orderkey", "o_orderdate")


_ORDER_JOBS_SQL = """
WITH k AS (SELECT sha256('job:cust' || o_custkey || ':' || lower(o_orderpriority) || ':https://jobs.example.com/' ||
                         o_custkey || '/' || replace(o_orderpriority, ' ', '_')) AS dedup_key, o_orderkey, o_orderdate
           FROM orders),
store AS (SELECT DISTINCT dedup_key FROM k WHERE o_orderdate < TIMESTAMP '1995-01-01')"""


@register("insert_if_absent", _ORDER_JOBS_SQL + """
SELECT dedup_key, min(o_orderkey) AS o_orderkey FROM k
WHERE dedup_key NOT IN (SELECT dedup_key FROM store) GROUP BY dedup_key""")
def q_insert_if_absent(spark, sf):
    j = _order_jobs(spark, sf)
    store = j.filter(F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")).select("dedup_key")
    return insert_if_absent(j.drop("o_orderdate"), store, "dedup_key", "ord").select("dedup_key", "o_orderkey")


_STORE_SQL = """
WITH k AS (SELECT event_id, ts, sha256('news:https://news.example.com/u/' || user_id || '/' || (event_id % 100)) AS dedup_key
           FROM events),
a AS (SELECT dedup_key, min(event_id) AS event_id, 'first' AS batch_id FROM k WHERE ts < TIMESTAMP '2024-01-16' GROUP BY dedup_key),
b AS (SELECT dedup_key, min(event_id) AS event_id, 'second' AS batch_id FROM k WHERE ts >= TIMESTAMP '2024-01-10'
      AND dedup_key NOT IN (SELECT dedup_key FROM a) GROUP BY dedup_key)
SELECT dedup_key, event_id, batch_id, (SELECT count(*) FROM a) AS saved_first, CAST(0 AS BIGINT) AS saved_again,
       (SELECT count(*) FROM b) AS saved_second FROM (SELECT * FROM a UNION ALL SELECT * FROM b)"""


@register("insert_if_absent_store", _STORE_SQL)
def q_insert_if_absent_store(spark, sf):
    """A store that gets one batch twice and an overlapping one: its rows, and what each write saved."""
    store = scratch_path(spark, f"store_{uuid.uuid4().hex}")
    news = _event_news(spark, sf).withColumn("ord", F.col("event_id"))
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    first = news.filter(F.col("ts") < day("2024-01-16")).withColumn("batch_id", F.lit("first"))
    second = news.filter(F.col("ts") >= day("2024-01-10")).withColumn("batch_id", F.lit("second"))
    saved = [commit_batch(first, store, "first"), commit_batch(first, store, "first"), commit_batch(second, store, "second")]
    return read_store(spark, store).select("dedup_key", "event_id", "batch_id", *(
        F.lit(n).cast("long").alias(f"saved_{name}") for n, name in zip(saved, ("first", "again", "second"))))


def _event_news(spark, sf):
    e = table(spark, sf, "events")
    url = F.concat(F.lit("https://news.example.com/u/"), F.col("user_id").cast("string"), F.lit("/"),
                   (F.col("event_id") % 100).cast("string"))
    return e.select("event_id", "ts", dedup_key("news", article_url=url).alias("dedup_key"))


@register("dedup_seen", """
WITH k AS (SELECT event_id, ts, sha256('news:https://news.example.com/u/' || user_id || '/' || (event_id % 100))
                  AS dedup_key FROM events)
SELECT event_id, dedup_key FROM k
WHERE dedup_key NOT IN (SELECT dedup_key FROM k WHERE ts < TIMESTAMP '2024-01-08')""")
def q_dedup_seen(spark, sf):
    e = _event_news(spark, sf)
    store = e.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")).select("dedup_key")
    return dedup_seen(e.select("event_id", "dedup_key"), store, "dedup_key")


def _part_products(spark, sf):
    p = table(spark, sf, "part")
    url = F.concat(F.lit("https://huggingface.co/spaces/"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))))
    return p.select("p_partkey", "p_size",
                    dedup_key("product", name=F.col("p_name"), canonical_name=F.lit(None), product_url=url,
                              source_url=url).alias("dedup_key"))


@register("anti_join_store", """
WITH k AS (SELECT p_partkey, p_size, sha256('product:' || lower(p_name) || ':https://huggingface.co/spaces/' ||
                                               lower(replace(p_brand, '#', ''))) AS dedup_key FROM part)
SELECT p_partkey, dedup_key FROM k WHERE dedup_key NOT IN (SELECT dedup_key FROM k WHERE p_size <= 25)""")
def q_anti_join_store(spark, sf):
    p = _part_products(spark, sf)
    return anti_join_store(p.select("p_partkey", "dedup_key"), p.filter(F.col("p_size") <= 25), "dedup_key")


@register("dedup_name_priority", """
WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal,
                  CASE c_custkey % 3 WHEN 0 THEN upper(c_mktsegment || ' ' || (c_custkey % 37))
                                     WHEN 1 THEN ' ' || c_mktsegment || ' ' || (c_custkey % 37) || ' '
                                     ELSE c_mktsegment || ' ' || (c_custkey % 37) END AS name FROM customer)
SELECT lower(trim(name)) AS name_key, c_custkey FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY c_nationkey, c_custkey) AS rn
  FROM c WHERE c_acctbal >= 0) WHERE rn = 1""")
def q_dedup_name_priority(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    base = F.concat(F.col("c_mktsegment"), F.lit(" "), (k % 37).cast("string"))
    name = F.when(k % 3 == 0, F.upper(base)).when(k % 3 == 1, F.concat(F.lit(" "), base, F.lit(" "))).otherwise(base)
    d = c.select(name.alias("name"), F.struct("c_nationkey", "c_custkey").alias("ord"), "c_custkey",
                 (F.col("c_acctbal") >= 0).alias("is_valid"))
    r = dedup_name_priority(d, "name", "ord", "is_valid")
    from ..functions.strings import py_strip
    return r.select(F.lower(py_strip("name")).alias("name_key"), "c_custkey")


@register("dedup_listing_id", """
SELECT listing_id, p_partkey FROM (
  SELECT p_brand || '/' || p_type AS listing_id, p_partkey,
         row_number() OVER (PARTITION BY p_brand || '/' || p_type ORDER BY p_partkey) AS rn
  FROM part WHERE p_size >= 3) WHERE rn = 1""")
def q_dedup_listing_id(spark, sf):
    p = table(spark, sf, "part").filter(F.col("p_size") >= 3)
    d = p.select(F.concat("p_brand", F.lit("/"), "p_type").alias("listing_id"), "p_partkey",
                 F.col("p_partkey").alias("ord"))
    return dedup_listing_id(d, "listing_id", "ord").select("listing_id", "p_partkey")


@register("provenance_check", """
SELECT 'pages' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE regexp_matches(url, '^https?://')) AS n_valid,
       coalesce(bool_and(coalesce(regexp_matches(url, '^https?://'), false)), true) AS provenance_valid FROM pages
UNION ALL
SELECT 'startups', count(*), count(*) FILTER (WHERE regexp_matches(u, '^https?://')),
       coalesce(bool_and(coalesce(regexp_matches(u, '^https?://'), false)), true)
FROM (SELECT CASE c_custkey % 10 WHEN 0 THEN 'ftp://x/' || c_custkey WHEN 1 THEN ''
                 ELSE 'https://c/' || c_custkey END AS u FROM customer)
UNION ALL
SELECT 'papers', count(*), count(*), true FROM orders""")
def q_provenance_check(spark, sf):
    pg = provenance_check(table(spark, sf, "pages"), "pages", "url")
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    u = F.when(k % 10 == 0, F.concat(F.lit("ftp://x/"), k.cast("string"))).when(k % 10 == 1, F.lit("")) \
         .otherwise(F.concat(F.lit("https://c/"), k.cast("string")))
    st = provenance_check(c.select(u.alias("source_url")), "startups")
    o = table(spark, sf, "orders").select(F.concat(F.lit("http://arxiv.example.org/abs/"),
                                                   F.col("o_orderkey").cast("string")).alias("source_url"))
    return pg.unionByName(st).unionByName(provenance_check(o, "papers"))
