"""Payload scans over bodies that Spark renders from the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.payloads import (multi_source_union, paged_limit, scan_jobs_feed, scan_jobs_json,
                                scan_news_feed, scan_papers_atom, scan_products_json, scan_stars_json,
                                scan_startups_json)
from .catalog import register
from .derive import (atom_paper_payloads, job_feed_payloads, job_json_payloads, news_feed_payloads,
                     news_registry, product_payloads, star_payloads, startup_payloads)
from .sqlfrag import company_sql, note_sql, role_family_sql, role_sql

PAPERS_SQL = """
SELECT 'http://arxiv.example.org/abs/' || o_orderkey AS paper_url,
       'Paper ' || o_orderpriority || ' on ' || o_orderstatus AS title,
       'Author ' || o_custkey || '|Clerk ' || (o_orderkey % 7) AS authors,
       'Abstract for order ' || o_orderkey ||
         CASE WHEN o_orderkey % 3 = 0 THEN ' Code at https://github.com/c' || o_custkey || '/r' || o_orderkey || '.'
              ELSE '' END AS abstract,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS publication_date,
       CASE WHEN o_orderkey % 3 = 0 THEN 'https://github.com/c' || o_custkey || '/r' || o_orderkey
            WHEN o_orderkey % 5 = 1 THEN 'https://github.com/x/y' || o_orderkey END AS github_repository_url
FROM orders WHERE o_orderkey % 11 <> 0"""
#: All orders: the payloads of the column queries.
ALL_PAPERS_SQL = PAPERS_SQL.replace("'http://arxiv.example.org/abs/' ||", "CASE WHEN o_orderkey % 11 = 0 THEN 'urn:paper:' "
                                    "ELSE 'http://arxiv.example.org/abs/' END ||").replace(" WHERE o_orderkey % 11 <> 0", "")


@register("scan_papers_atom", PAPERS_SQL)
def q_scan_papers_atom(spark, sf):
    p = scan_papers_atom(atom_paper_payloads(spark, sf))
    return p.select("paper_url", "title", F.array_join("authors", "|").alias("authors"), "abstract",
                    "publication_date", "github_repository_url")


@register("collapse_ws", "SELECT paper_url, title, abstract FROM (" + ALL_PAPERS_SQL + ")")
def q_collapse_ws(spark, sf):
    return scan_papers_atom(atom_paper_payloads(spark, sf, complete=True)).select("paper_url", "title", "abstract")


@register("extract_repo_url", "SELECT paper_url, github_repository_url FROM (" + ALL_PAPERS_SQL + ")")
def q_extract_repo_url(spark, sf):
    return scan_papers_atom(atom_paper_payloads(spark, sf, complete=True)).select("paper_url", "github_repository_url")


@register("paged_limit", "SELECT paper_url, title FROM (" + PAPERS_SQL.replace(
    "FROM orders WHERE", ", o_orderkey AS k FROM orders WHERE") + ") ORDER BY k LIMIT 100")
def q_paged_limit(spark, sf):
    p = scan_papers_atom(atom_paper_payloads(spark, sf))
    return paged_limit(p, 100, "ord").select("paper_url", "title")


NEWS_SQL = """
SELECT 'Story ' || event_id AS title,
       'https://news.example.com/' || event_type || '/' || user_id AS article_url,
       'user ' || user_id AS author,
       'Event' || event_id || event_type AS summary,
       event_type AS source_name,
       'https://news.example.com/' || event_type || '/feed?page=' || (event_id // 16) AS source_url
FROM events WHERE (event_id // 16) % 7 <> 3"""
ALL_NEWS_SQL = NEWS_SQL.replace(" WHERE (event_id // 16) % 7 <> 3", "")


@register("scan_news_feed", NEWS_SQL)
def q_scan_news_feed(spark, sf):
    p = news_feed_payloads(spark, sf)
    return scan_news_feed(p).select("title", "article_url", "author", "summary", "source_name", "source_url")


@register("strip_html", "SELECT title, summary FROM (" + ALL_NEWS_SQL + ")")
def q_strip_html(spark, sf):
    return scan_news_feed(news_feed_payloads(spark, sf, complete=True)).select("title", "summary")


@register("multi_source_union", "SELECT source_name, count(*) AS records FROM (" + NEWS_SQL + ") GROUP BY source_name")
def q_multi_source_union(spark, sf):
    u = multi_source_union(news_feed_payloads(spark, sf), news_registry(spark), {"news_feed": scan_news_feed})
    return u.groupBy("source_name").agg(F.count(F.lit(1)).alias("records"))


JOBS_JSON_SQL = f"""
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT 'https://jobs.example.com/o/' || k AS job_url, {company_sql('c')} AS company_name,
       {role_sql('k')} AS role_title,
       CASE WHEN k % 3 = 0 THEN 'Berlin' ELSE 'Remote' END AS location,
       {role_family_sql(role_sql('k') + " || ' ' || coalesce(" + note_sql('k') + ", '')")} AS role_family,
       'JobBoardAPI' AS source_name
FROM o WHERE k % 13 <> 0"""
ALL_JOBS_JSON_SQL = JOBS_JSON_SQL.replace(" WHERE k % 13 <> 0", "")


@register("scan_jobs_json", JOBS_JSON_SQL)
def q_scan_jobs_json(spark, sf):
    j = scan_jobs_json(job_json_payloads(spark, sf))
    return j.select("job_url", "company_name", "role_title", "location", "role_family", "source_name")


@register("filter_required", "SELECT job_url FROM (" + JOBS_JSON_SQL + ")")
def q_filter_required(spark, sf):
    return scan_jobs_json(job_json_payloads(spark, sf)).select("job_url")


@register("default_location", "SELECT job_url, location FROM (" + ALL_JOBS_JSON_SQL + ")")
def q_default_location(spark, sf):
    return scan_jobs_json(job_json_payloads(spark, sf, complete=True)).select("job_url", "location")


@register("role_family", "SELECT job_url, role_family FROM (" + ALL_JOBS_JSON_SQL + ")")
def q_role_family(spark, sf):
    return scan_jobs_json(job_json_payloads(spark, sf, complete=True)).select("job_url", "role_family")


_LI_ROLE = role_sql("l_partkey")
JOBS_FEED_SQL = f"""
WITH l AS (SELECT *, 'Supplier ' || l_suppkey AS comp, {_LI_ROLE} AS role FROM lineitem)
SELECT 'https://jobs.example.com/l/' || l_orderkey || '/' || l_linenumber AS job_url,
       CASE WHEN l_linenumber <= 5 THEN comp ELSE 'JobFeed' END AS company_name,
       role AS role_title,
       {role_family_sql("role || ' <b>' || l_returnflag || '</b> role'")} AS role_family,
       l_returnflag || 'role' AS description, 'Remote' AS location, true AS is_remote
FROM l"""


@register("scan_jobs_feed", JOBS_FEED_SQL)
def q_scan_jobs_feed(spark, sf):
    j = scan_jobs_feed(job_feed_payloads(spark, sf))
    return j.select("job_url", "company_name", "role_title", "role_family", "description", "location", "is_remote")


@register("split_job_title", "SELECT job_url, company_name, role_title FROM (" + JOBS_FEED_SQL + ")")
def q_split_job_title(spark, sf):
    return scan_jobs_feed(job_feed_payloads(spark, sf)).select("job_url", "company_name", "role_title")


STARTUPS_SQL = f"""
WITH c AS (SELECT *, c_custkey AS k, 1000000000 + c_custkey * 604800 AS secs FROM customer)
SELECT k AS custkey, {company_sql('k')} AS name,
  CASE WHEN k % 4 = 0 THEN 'One liner ' || c_mktsegment
       WHEN k % 5 = 0 THEN repeat('Long text ' || c_name || ' ', 20)
       WHEN k % 5 = 1 THEN 'Short long' END AS description,
  CASE WHEN k % 3 = 0 THEN 'https://c' || k || '.example.com' END AS website_url,
  CASE WHEN k % 2 = 0 THEN 'https://directory.example.com/companies/' || k
       ELSE 'https://directory.example.com/api/tag?page=' || (k // 8) END AS source_url,
  CASE WHEN k % 6 = 0 AND k % 300 > 0 THEN CAST(k % 300 AS INTEGER) END AS employee_count,
  CASE WHEN k % 5 IN (0, 1) THEN CAST(year(make_timestamp(secs * 1000000)) AS INTEGER) END AS founding_year,
  CASE WHEN k % 2 = 0 THEN 'Nation ' || c_nationkey END AS headquarters,
  CASE WHEN k % 7 = 0 THEN 'AI' ELSE 'tag' || (k % 3) || '|ai|' || c_mktsegment END AS categories,
  CASE WHEN k % 2 = 0 THEN c_mktsegment END AS funding_stage
FROM c WHERE k % 17 <> 0"""
ALL_STARTUPS_SQL = STARTUPS_SQL.replace(" WHERE k % 17 <> 0", "")


def _startups(spark, sf, complete=False):
    s = scan_startups_json(startup_payloads(spark, sf, complete))
    return s.withColumn("custkey", F.col("ord.page") * 8 + F.col("ord.pos")) \
            .withColumn("categories", F.array_join("categories", "|"))


@register("scan_startups_json", STARTUPS_SQL)
def q_scan_startups_json(spark, sf):
    return _startups(spark, sf).select("custkey", "name", "description", "website_url", "source_url",
                                       "employee_count", "founding_year", "headquarters", "categories",
                                       "funding_stage")


for _rid, _cols in [("employee_count", ["employee_count"]), ("founding_year", ["founding_year"]),
                    ("startup_categories", ["categories"]), ("startup_description", ["description"]),
                    ("startup_provenance", ["source_url", "website_url", "headquarters", "funding_stage"])]:
    def _mk(cols):
        def q(spark, sf):
            return _startups(spark, sf, complete=True).select("custkey", *cols)
        return q
    register(_rid, f"SELECT custkey, {', '.join(_cols)} FROM (" + ALL_STARTUPS_SQL + ")")(_mk(_cols))


PRODUCTS_SQL = """
WITH p AS (SELECT *, p_partkey AS k,
                  lower(replace(p_brand, '#', '')) AS owner,
                  replace(p_name, ' ', '-') || '-' || (p_partkey % 97) AS lname,
                  CASE p_partkey % 3 WHEN 0 THEN 'gradio' WHEN 1 THEN 'streamlit' ELSE 'unknown' END AS sdk
           FROM part)
SELECT k AS partkey, owner || '/' || lname AS listing_id, CAST(p_size AS BIGINT) AS likes, lname AS name,
  CASE WHEN k % 6 = 2 THEN 'Desc ' || p_type
       WHEN k % 6 = 4 THEN 'T ' || p_name || ' — AI application built with ' || sdk END AS description,
  'https://huggingface.co/spaces/' || owner || '/' || lname AS product_url,
  CASE WHEN k % 6 IN (2, 3) THEN 'FREE' ELSE 'UNKNOWN' END AS pricing_type,
  owner AS company_name,
  CASE WHEN k % 5 IN (0, 1) THEN sdk || '|AI' ELSE p_type || '|t1|t2|t3|t4|t5' END AS categories
FROM p WHERE k % 10 <> 0 AND k % 4 <> 0 AND p_size >= 3"""
ALL_PRODUCTS_SQL = PRODUCTS_SQL.replace(" WHERE k % 10 <> 0 AND k % 4 <> 0 AND p_size >= 3", "")


def _products(spark, sf, complete=False):
    p = scan_products_json(product_payloads(spark, sf, complete))
    return p.withColumn("partkey", F.col("ord.page") * 8 + F.col("ord.pos")) \
            .withColumn("categories", F.array_join("categories", "|"))


@register("scan_products_json", PRODUCTS_SQL)
def q_scan_products_json(spark, sf):
    return _products(spark, sf).select("partkey", "listing_id", "likes", "name", "description", "product_url",
                                       "pricing_type", "company_name", "categories")


for _rid, _cols in [("pricing_from_license", ["pricing_type"]), ("product_description", ["description"]),
                    ("product_categories", ["categories"]), ("filter_engagement", ["likes"])]:
    def _mk2(cols, complete):
        def q(spark, sf):
            return _products(spark, sf, complete).select("partkey", *cols)
        return q
    _all = _rid != "filter_engagement"
    register(_rid, f"SELECT partkey, {', '.join(_cols)} FROM (" + (ALL_PRODUCTS_SQL if _all else PRODUCTS_SQL) + ")")(_mk2(_cols, _all))


@register("scan_stars_json", """
SELECT 'c' || o_custkey AS owner, 'r' || o_orderkey AS repo,
       CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 5000 END AS stars
FROM orders""")
def q_scan_stars_json(spark, sf):
    return scan_stars_json(star_payloads(spark, sf))
