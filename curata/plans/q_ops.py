"""Fetch-log analytics, reports and sinks."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.dedup import dedup_key
from ..operators.fetchlog import backoff_compliance, classify_fetch, fetch_report, final_outcome
from ..operators.reports import (coverage_report, pricing_breakdown, source_breakdown, source_samples,
                                 table_counts)
from ..operators.sinks import append_mapping_log, export_tab
from ..session import scratch_path
from ..operators.enrich import enrich_stars
from ..operators.validate import with_violations
from ..sources.payloads import (scan_jobs_json, scan_news_feed, scan_papers_atom, scan_products_json, scan_stars_json,
                                scan_table)
from .catalog import register
from .derive import (atom_paper_payloads, job_json_payloads, news_feed_payloads, product_payloads,
                     star_payloads)
from .q_resolve import JOINED as RESOLVED_SQL, _resolved, LOG_TS
from .q_scans import ALL_JOBS_JSON_SQL, ALL_NEWS_SQL, ALL_PAPERS_SQL, ALL_PRODUCTS_SQL, ALL_STARTUPS_SQL
from .tables import TABLES, table


def attempt_log(spark, sf):
    """events -> crawl attempt log: one URL per user, crawled again after every four attempts;
    the URLs of even users lack attempt 2 of each crawl (numbers 0, 1, 3, 4)."""
    e = table(spark, sf, "events")
    url = F.concat(F.lit("https://feed.example.com/u/"), F.col("user_id").cast("string"))
    t = F.col("event_type")
    status = (F.when(t == "purchase", F.lit(200)).when(t == "click", F.lit(404)).when(t == "signup", F.lit(403))
               .when(t == "view", F.lit(429)))
    a = e.select("event_id", (F.col("user_id") % 2 == 0).alias("_gap"), url.alias("url"), F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string")).alias("source_name"),
                 status.cast("int").alias("status_code"),
                 F.when(t == "error", F.lit("ConnectTimeout")).alias("error"),
                 F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("latency_ms"))
    w = Window.partitionBy("url").orderBy("ts", "event_id")
    n = (F.row_number().over(w) - 1) % 4
    return a.withColumn("_n", n).withColumn(
        "attempt", (F.col("_n") + F.when(F.col("_gap") & (F.col("_n") >= 2), 1).otherwise(0)).cast("int")).drop("_n", "_gap")


_ATTEMPTS_SQL = """
WITH a AS (
  SELECT event_id, user_id, 'https://feed.example.com/u/' || user_id AS url,
         'src' || (user_id % 5) AS source_name,
         CASE event_type WHEN 'purchase' THEN 200 WHEN 'click' THEN 404 WHEN 'signup' THEN 403 WHEN 'view' THEN 429 END
           AS status_code,
         CASE WHEN event_type = 'error' THEN 'ConnectTimeout' END AS error, ts, value AS latency_ms
  FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, event_id) - 1 AS r FROM a),
l AS (SELECT *, CAST(r % 4 + CASE WHEN user_id % 2 = 0 AND r % 4 >= 2 THEN 1 ELSE 0 END AS INTEGER) AS attempt,
             min(epoch_us(ts)) OVER (PARTITION BY url, r // 4) AS crawl FROM n),
c AS (SELECT *, CASE WHEN status_code = 200 THEN 'success' WHEN status_code IN (404, 403) THEN 'terminal'
                     ELSE 'retryable' END AS cls FROM l)"""


@register("classify_fetch", _ATTEMPTS_SQL + " SELECT event_id, cls AS fetch_class FROM c")
def q_classify_fetch(spark, sf):
    return attempt_log(spark, sf).select("event_id", classify_fetch("status_code").alias("fetch_class"))


@register("final_outcome", _ATTEMPTS_SQL + """,
last AS (SELECT url, crawl, n_attempts, attempt AS retries, status_code AS st, error AS er, cls AS cl FROM (
           SELECT *, row_number() OVER (PARTITION BY url, crawl ORDER BY attempt DESC) AS rn,
                  count(*) OVER (PARTITION BY url, crawl) AS n_attempts FROM c) WHERE rn = 1)
SELECT url, crawl, n_attempts, retries,
  CASE WHEN cl = 'retryable' AND retries >= 4 THEN 500 ELSE st END AS final_status,
  CASE WHEN cl = 'retryable' AND retries >= 4 THEN 'Failed after 4 retries' ELSE er END AS final_error,
  CASE WHEN cl = 'success' THEN 'success' WHEN cl = 'terminal' THEN 'rejected'
       WHEN retries >= 4 THEN 'failed' ELSE 'pending' END AS outcome
FROM last""")
def q_final_outcome(spark, sf):
    return final_outcome(attempt_log(spark, sf))


@register("backoff_compliance", _ATTEMPTS_SQL + """,
g AS (SELECT url, crawl, attempt, ts, lag(ts) OVER w AS pts, lag(latency_ms) OVER w AS plat, lag(attempt) OVER w AS pat
      FROM c WINDOW w AS (PARTITION BY url, crawl ORDER BY attempt))
SELECT url, crawl, attempt, CAST(attempt - pat - 1 AS BIGINT) AS missing, epoch_us(ts) - epoch_us(pts) AS gap_us,
       least(1.0 * pow(2.0, CAST(pat AS DOUBLE)), 30.0) * 1000.0 AS policy_wait_ms,
       CASE WHEN attempt - pat = 1 THEN (CAST(epoch_us(ts) - epoch_us(pts) AS DOUBLE) / 1000.0 - coalesce(plat, 0.0))
         < least(1.0 * pow(2.0, CAST(pat AS DOUBLE)), 30.0) * 500.0 END AS too_early,
       CASE WHEN attempt - pat = 1 THEN (CAST(epoch_us(ts) - epoch_us(pts) AS DOUBLE) / 1000.0 - coalesce(plat, 0.0))
         > least(1.0 * pow(2.0, CAST(pat AS DOUBLE)), 30.0) * 1500.0 END AS too_late
FROM g WHERE pts IS NOT NULL""")
def q_backoff_compliance(spark, sf):
    return backoff_compliance(attempt_log(spark, sf))


@register("fetch_report", _ATTEMPTS_SQL + """
SELECT source_name, count(*) AS attempts, count(DISTINCT url) AS urls,
       count(*) FILTER (WHERE cls = 'success') AS successes, count(*) FILTER (WHERE attempt > 0) AS retries,
       quantile_disc(latency_ms, 0.5) AS latency_p50, max(latency_ms) AS latency_max
FROM c GROUP BY source_name""")
def q_fetch_report(spark, sf):
    return fetch_report(attempt_log(spark, sf))


@register("source_breakdown", """
SELECT source AS source_name, count(*) AS records, avg(CAST(length(text) AS BIGINT)) AS avg_text_len
FROM documents GROUP BY source""")
def q_source_breakdown(spark, sf):
    d = table(spark, sf, "documents").withColumnRenamed("source", "source_name")
    return source_breakdown(d, "source_name", "text")


@register("source_samples", """
SELECT source AS source_name, rank, substr(text, 1, 60) AS title_sample, CAST(length(text) AS BIGINT) AS text_len
FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 3""")
def q_source_samples(spark, sf):
    d = table(spark, sf, "documents").withColumnRenamed("source", "source_name")
    return source_samples(d, 3, "source_name", "doc_id", "text", "text").withColumn("rank", F.col("rank").cast("long"))


@register("pricing_breakdown", """
WITH e AS (SELECT * FROM (VALUES ('FREE'), ('FREEMIUM'), ('PAID'), ('ENTERPRISE'), ('UNKNOWN')) t(pricing_type)),
p AS (""" + ALL_PRODUCTS_SQL + """)
SELECT e.pricing_type, CAST(count(p.partkey) AS BIGINT) AS records FROM e LEFT JOIN p ON e.pricing_type = p.pricing_type
GROUP BY e.pricing_type""")
def q_pricing_breakdown(spark, sf):
    return pricing_breakdown(scan_products_json(product_payloads(spark, sf, complete=True)))


@register("coverage_report", """
WITH p AS (""" + ALL_PAPERS_SQL.replace("SELECT CASE", "SELECT o_orderkey, CASE", 1) + """)
SELECT count(*) AS discovered, count(*) FILTER (WHERE paper_url LIKE 'http://%') AS valid,
       count(DISTINCT sha256('paper:' || lower(paper_url))) AS unique_keys,
       count(*) FILTER (WHERE github_repository_url IS NOT NULL) AS with_repo,
       count(*) FILTER (WHERE github_repository_url IS NULL) AS without_repo,
       count(*) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderkey % 4 = 0) AS stars_enriched FROM p""")
def q_coverage_report(spark, sf):
    """Papers of all orders after validation and star enrichment; some have an id that is no web address."""
    p = with_violations(scan_papers_atom(atom_paper_payloads(spark, sf, complete=True)), "paper")
    p = p.withColumns({"dedup_key": dedup_key("paper", paper_url=F.col("paper_url")), "is_valid": F.size("violations") == 0})
    p = enrich_stars(p, scan_stars_json(star_payloads(spark, sf)))
    return coverage_report(p, "dedup_key", "is_valid", "github_repository_url", "github_stars")


@register("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES) +
    " UNION ALL SELECT 'total', (" + " + ".join(f"(SELECT count(*) FROM {t})" for t in TABLES) + ")")
def q_table_counts(spark, sf):
    return table_counts({t: table(spark, sf, t) for t in TABLES})


@register("export_tabs", """
WITH p AS (""" + ALL_PAPERS_SQL.replace("SELECT CASE", "SELECT o_custkey, o_orderkey, CASE", 1) + """)
SELECT sha256('paper:' || lower(paper_url)) AS "ID", title AS "Title",
       '["Author ' || o_custkey || '", "Clerk ' || (o_orderkey % 7) || '"]' AS "Authors",
       paper_url AS "Paper URL", paper_url AS "Source URL", abstract AS "Abstract",
       publication_date AS "Publication Date", coalesce(github_repository_url, '') AS "GitHub Repo URL",
       '' AS "GitHub Stars", 'arxiv' AS "Source", '""" + LOG_TS + """' AS "Collected At"
FROM p""")
def q_export_tabs(spark, sf):
    p = scan_papers_atom(atom_paper_payloads(spark, sf, complete=True))
    p = (p.withColumn("id", dedup_key("paper", paper_url=F.col("paper_url")))
          .withColumn("collected_at", F.lit(LOG_TS)))
    return export_tab(p, "Research Papers")


def _joined(values: str, by: str = ", ") -> str:
    """JSON list of strings that the SQL of a scan keeps joined by a bar."""
    return f"""'["' || replace({values}, '|', '"{by}"') || '"]'"""


_EXPORT_SQL = f"""
SELECT 'Startups' AS tab, concat_ws('|', sha256('startup:' || custkey), name, '', coalesce(description, ''), coalesce(website_url, ''),
  source_url, coalesce(CAST(employee_count AS VARCHAR), ''), coalesce(CAST(founding_year AS VARCHAR), ''),
  coalesce(headquarters, ''), {_joined('categories')}, coalesce(funding_stage, ''), '{LOG_TS}') AS line FROM ({ALL_STARTUPS_SQL})
UNION ALL
SELECT 'Products', concat_ws('|', sha256('product:' || partkey), name, '', coalesce(description, ''), product_url, product_url,
  pricing_type, '', company_name, {_joined('categories')}, '{LOG_TS}') FROM ({ALL_PRODUCTS_SQL})
UNION ALL
SELECT 'Research Papers', concat_ws('|', sha256('paper:' || paper_url), title, {_joined('authors')}, paper_url, paper_url, abstract,
  publication_date, coalesce(github_repository_url, ''), '', 'arxiv', '{LOG_TS}') FROM ({ALL_PAPERS_SQL})
UNION ALL
SELECT 'Jobs', concat_ws('|', sha256('job:' || job_url), company_name, '', role_title, job_url,
  'https://jobs.example.com/api?page=' || (CAST(split_part(job_url, '/', 5) AS BIGINT) // 8), location, 'True', role_family, '',
  'None', source_name, '{LOG_TS}') FROM ({ALL_JOBS_JSON_SQL})
UNION ALL
SELECT 'News', concat_ws('|', sha256('news:' || title), title, article_url, source_url, author, summary, '', 'None', source_name,
  '{LOG_TS}') FROM ({ALL_NEWS_SQL})
UNION ALL
SELECT 'Entity Mapping Log', concat_ws('|', '', raw_name, canonical_name, match_method, CAST(confidence AS VARCHAR), source_url,
  '{LOG_TS}') FROM ({RESOLVED_SQL})"""


@register("export_all_tabs", _EXPORT_SQL)
def q_export_all_tabs(spark, sf):
    """All six tabs written as one version over an older one, and read back from it line by line."""
    from ..operators.resolve import mapping_log
    from ..operators.sinks import publish_tabs, read_export
    from .q_scans import _products, _startups
    path = scratch_path(spark, f"export_{uuid.uuid4().hex}")
    listed = F.split("categories", r"\|")

    def tab(df, kind, key):
        return df.withColumns({"id": F.sha2(F.concat(F.lit(f"{kind}:"), F.col(key).cast("string")), 256), "collected_at": F.lit(LOG_TS)})
    tables = {
        "Startups": tab(_startups(spark, sf, complete=True).withColumn("categories", listed), "startup", "custkey"),
        "Products": tab(_products(spark, sf, complete=True).withColumn("categories", listed), "product", "partkey"),
        "Research Papers": tab(scan_papers_atom(atom_paper_payloads(spark, sf, complete=True)), "paper", "paper_url"),
        "Jobs": tab(scan_jobs_json(job_json_payloads(spark, sf, complete=True)), "job", "job_url"),
        "News": tab(scan_news_feed(news_feed_payloads(spark, sf, complete=True)), "news", "title"),
        "Entity Mapping Log": mapping_log(_resolved(spark, sf), "raw_name", "source_url", LOG_TS)}
    publish_tabs({"Startups": tables["Startups"]}, path)
    publish_tabs(tables, path)
    lines = [df.select(F.lit(name).alias("tab"), F.concat_ws("|", *(F.col(f"`{c}`") for c in df.columns)).alias("line"))
             for name, df in read_export(spark, path).items()]
    return reduce(lambda a, b: a.unionAll(b), lines)


@register("append_mapping_log", RESOLVED_SQL.replace("SELECT names.custkey, names.raw_name", "SELECT names.raw_name", 1)
          .replace("CAST(res.confidence AS DOUBLE) AS confidence FROM names", f"CAST(res.confidence AS DOUBLE) AS confidence, '{LOG_TS}' AS timestamp FROM names"))
def q_append_mapping_log(spark, sf):
    """Appends the resolution audit rows to a log table in the shared folder and reads it back."""
    from ..operators.resolve import mapping_log
    path = scratch_path(spark, f"mapping_log_{uuid.uuid4().hex}")
    append_mapping_log(mapping_log(_resolved(spark, sf), "raw_name", "source_url", LOG_TS), path)
    return scan_table(spark, path).select("raw_name", "source_url", "canonical_name", "match_method", "confidence",
                                          "timestamp")


@register("scan_tables", "SELECT paper_url, title FROM (" + ALL_PAPERS_SQL + ")")
def q_scan_tables(spark, sf):
    """Writes the paper table to the shared folder, then full-scans the stored table."""
    path = scratch_path(spark, f"papers_{uuid.uuid4().hex}")
    scan_papers_atom(atom_paper_payloads(spark, sf, complete=True)).write.parquet(path)
    return scan_table(spark, path).select("paper_url", "title")
