"""End-to-end jobs over payloads derived from the driver tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import register
from .derive import (REFERENCE_TIME, atom_paper_payloads, job_feed_payloads, job_json_payloads, news_feed_payloads,
                     product_payloads, star_payloads, startup_payloads)
from .jobs import job_export, job_jobs, job_metrics, job_news, job_papers, job_products, job_startups
from .q_dates import _EXPECTED
from .q_extract import _chunk_of, first_provider, second_provider
from .q_resolve import LOG_TS, resolve_sql
from .q_scans import PAPERS_SQL, PRODUCTS_SQL, STARTUPS_SQL
from .sqlfrag import company_sql, role_sql
from .tables import table

JOBS_REFERENCE_TIME = "1996-06-15 12:00:00"


@register("job_papers", """
SELECT paper_url, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 = 0 THEN CAST(o_orderkey % 5000 AS INTEGER) END
       AS github_stars, sha256('paper:' || lower(paper_url)) AS dedup_key
FROM (""" + PAPERS_SQL.replace("SELECT 'http", "SELECT o_orderkey, 'http") + ")")
def q_job_papers(spark, sf):
    j = job_papers(atom_paper_payloads(spark, sf), star_payloads(spark, sf), None, LOG_TS)
    return j.select("paper_url", "github_stars", "dedup_key")


_ST = f"""
WITH s AS ({STARTUPS_SQL}),
v AS (SELECT * FROM s WHERE founding_year IS NULL OR founding_year BETWEEN 1800 AND 2026),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY custkey) AS rn FROM v)
      WHERE rn = 1)"""


@register("job_startups", resolve_sql("SELECT custkey, name AS raw_name FROM (" + _ST + " SELECT * FROM p)") + """,
k AS (SELECT p.custkey, p.name, res.canonical_name,
             sha256('startup:' || coalesce(nullif(res.canonical_name, ''), lower(p.name)) || ':' ||
                    coalesce(nullif(p.website_url, ''), p.source_url)) AS dedup_key,
             CASE WHEN coalesce(p.description, '') <> '' THEN 'skipped' ELSE 'deterministic' END AS extraction_status
      FROM (""" + _ST + """ SELECT * FROM p) p JOIN res ON p.name = res.raw_name)
SELECT custkey, name, canonical_name, dedup_key, extraction_status FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY custkey) AS rn2 FROM k) WHERE rn2 = 1""")
def q_job_startups(spark, sf):
    j = job_startups(startup_payloads(spark, sf), None, None, LOG_TS)
    return j.select((F.col("ord.page") * 8 + F.col("ord.pos")).alias("custkey"), "name", "canonical_name",
                    "dedup_key", "extraction_status")


@register("job_products", """
WITH p AS (""" + PRODUCTS_SQL + """),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY partkey) AS rn FROM p) WHERE rn = 1),
k AS (SELECT partkey, name, name AS canonical_name, sha256('product:' || name || ':' || product_url) AS dedup_key,
             CASE WHEN coalesce(description, '') <> '' THEN 'skipped' ELSE 'deterministic' END AS extraction_status
      FROM l)
SELECT partkey, name, canonical_name, dedup_key, extraction_status FROM (
  SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY partkey) AS rn2 FROM k) WHERE rn2 = 1""")
def q_job_products(spark, sf):
    j = job_products(product_payloads(spark, sf), None, None, None, LOG_TS)
    return j.select((F.col("ord.page") * 8 + F.col("ord.pos")).alias("partkey"), "name", "canonical_name",
                    "dedup_key", "extraction_status")


class LimitedAtFirst:
    """Offline tier 0 whose first call for a prompt meets a rate limit on every fifth length."""

    def __init__(self):
        self.met = set()

    def __call__(self, prompt: str, entity: str) -> str:
        if len(_chunk_of(prompt)) % 5 == 0 and prompt not in self.met:
            self.met.add(prompt)
            raise RuntimeError("429 rate limit exceeded, try again")
        return first_provider(prompt, entity)


def _listing(p):
    """listing_id, name and url columns of ``part`` as in the listing payloads."""
    owner = F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")))
    name = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), (F.col("p_partkey") % 97).cast("string"))
    lid = F.concat(owner, F.lit("/"), name)
    return p.select("*", lid.alias("listing_id"), name.alias("lname"), F.concat(F.lit("https://huggingface.co/spaces/"), lid).alias("url"))


def _products_run(spark, sf, stages=None):
    """The whole job: readmes for six parts in seven, two provider tiers, a store that has the large parts."""
    p = _listing(table(spark, sf, "part"))
    readmes = p.filter("p_partkey % 7 <> 0").select("listing_id", F.concat(
        F.lit("Readme of "), "listing_id", F.lit(", part "), F.col("p_partkey").cast("string"), F.lit(": "), "p_type",
        F.lit(" application with everything that it needs")).alias("readme"))
    store = p.filter("p_size > 40").select(F.sha2(F.concat(F.lit("product:"), "lname", F.lit(":"), "url"), 256).alias("dedup_key"))
    return job_products(product_payloads(spark, sf), readmes, store, [LimitedAtFirst(), second_provider], LOG_TS,
                        stages=stages, checkpoint=stages is not None)


_RUN_SQL = """
WITH p AS (""" + PRODUCTS_SQL + """),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY partkey) AS rn FROM p) WHERE rn = 1),
k AS (SELECT *, sha256('product:' || name || ':' || product_url) AS dedup_key FROM l),
q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY partkey) AS rn2 FROM k) WHERE rn2 = 1),
n AS (SELECT *, lower(replace(p_brand, '#', '')) || '/' || replace(p_name, ' ', '-') || '-' || (p_partkey % 97) AS lid FROM part),
r AS (SELECT lid, max('Readme of ' || lid || ', part ' || p_partkey || ': ' || p_type ||
                      ' application with everything that it needs') AS readme FROM n WHERE p_partkey % 7 <> 0 GROUP BY lid),
s AS (SELECT sha256('product:' || split_part(lid, '/', 2) || ':https://huggingface.co/spaces/' || lid) AS dedup_key FROM n
      WHERE p_size > 40),
new AS (SELECT q.*, readme, length(readme) AS len, CASE WHEN coalesce(description, '') <> '' THEN 'skipped'
               WHEN readme IS NOT NULL THEN 'attempt' ELSE 'deterministic' END AS status
        FROM q LEFT JOIN r ON q.listing_id = r.lid AND coalesce(description, '') = ''
        WHERE q.dedup_key NOT IN (SELECT dedup_key FROM s)),
out AS (SELECT *, CASE WHEN status = 'attempt' AND len % 4 >= 2 THEN 0 WHEN status = 'attempt' AND len % 8 <> 0 THEN 1 END AS tier
        FROM new)"""


@register("job_products_run", _RUN_SQL + """
SELECT partkey, name, dedup_key, status AS extraction_status,
       CASE WHEN tier IS NOT NULL THEN sha256(readme) ELSE description END AS description, categories FROM out""")
def q_job_products_run(spark, sf):
    """Listings as one run: readmes joined, two provider tiers asked, only rows that the store lacks."""
    j = _products_run(spark, sf)
    return j.select((F.col("ord.page") * 8 + F.col("ord.pos")).alias("partkey"), "name", "dedup_key", "extraction_status",
                    "description", F.array_join("categories", "|").alias("categories"))


@register("run_metrics_products", _RUN_SQL + """
SELECT (SELECT count(*) FROM l) AS records_discovered, (SELECT count(*) FROM out) AS records_processed,
       CAST(0 AS BIGINT) AS records_rejected, (SELECT count(*) FROM l) - (SELECT count(*) FROM q) AS duplicates,
       CAST(0 AS BIGINT) AS fresh_records, CAST(0 AS BIGINT) AS stale_records,
       CAST(0 AS BIGINT) AS github_stars_enriched,
       (SELECT count(*) FROM out WHERE status <> 'attempt') AS deterministic_extractions,
       (SELECT count(*) FROM out WHERE status = 'attempt') AS llm_extractions_attempted,
       (SELECT count(*) FROM out WHERE status = 'skipped') AS llm_extractions_skipped,
       (SELECT count(*) FROM out WHERE status = 'attempt' AND len % 5 = 0) AS gemini_429s,
       (SELECT count(*) FROM out WHERE tier = 1) AS llm_fallbacks""")
def q_run_metrics_products(spark, sf):
    """Counters of a run with readmes, provider tiers and a store: rate limits, fallbacks, in-run
    duplicates apart from rows that the store had (entity matches are in run_metrics)."""
    stages: dict = {}
    out = _products_run(spark, sf, stages)
    return job_metrics({"product": out}, {"product": stages}).drop("entity_matches")


@register("job_news", _EXPECTED + """,
n AS (SELECT event_id, 'Story ' || event_id AS title,
             'https://news.example.com/' || event_type || '/' || user_id AS article_url, pub_us
      FROM g WHERE verdict = 'FRESH' AND (event_id // 16) % 7 <> 3),
k AS (SELECT *, sha256('news:' || lower(article_url)) AS dedup_key,
             row_number() OVER (PARTITION BY lower(article_url) ORDER BY event_id) AS rn FROM n)
SELECT article_url, title, pub_us AS published_us, dedup_key FROM k WHERE rn = 1""")
def q_job_news(spark, sf):
    j = job_news(news_feed_payloads(spark, sf), REFERENCE_TIME, None, None, None, 24.0, LOG_TS)
    return j.select("article_url", "title", F.unix_micros("published_at").alias("published_us"), "dedup_key")


_JOBS_ROWS = f"""
SELECT 'https://jobs.example.com/o/' || o_orderkey AS job_url, {company_sql('o_custkey')} AS company_name,
       {role_sql('o_orderkey')} AS role_title, o_orderdate AS ts
FROM orders WHERE o_orderkey % 13 <> 0
UNION ALL
SELECT 'https://jobs.example.com/l/' || l_orderkey || '/' || l_linenumber,
       CASE WHEN l_linenumber <= 5 THEN 'Supplier ' || l_suppkey ELSE 'JobFeed' END,
       {role_sql('l_partkey')}, l_shipdate FROM lineitem"""
_FRESH_JOBS = f"""SELECT * FROM ({_JOBS_ROWS}) WHERE
  (epoch_us(TIMESTAMP '{JOBS_REFERENCE_TIME}') - epoch_us(ts)) / 1000000.0 >= -300
  AND (epoch_us(TIMESTAMP '{JOBS_REFERENCE_TIME}') - epoch_us(ts)) / 3600000000.0 <= 24"""


@register("job_jobs", resolve_sql("SELECT DISTINCT company_name AS raw_name FROM (" + _FRESH_JOBS + ")") + f"""
SELECT f.job_url, f.company_name, res.canonical_name AS canonical_company_name, epoch_us(f.ts) AS published_us,
       sha256('job:' || lower(f.company_name) || ':' || lower(f.role_title) || ':' || f.job_url) AS dedup_key
FROM ({_FRESH_JOBS}) f JOIN res ON f.company_name = res.raw_name""")
def q_job_jobs(spark, sf):
    j = job_jobs(job_json_payloads(spark, sf), job_feed_payloads(spark, sf), JOBS_REFERENCE_TIME, None, 24.0, LOG_TS)
    return j.select("job_url", "company_name", "canonical_company_name",
                    F.unix_micros("published_at").alias("published_us"), "dedup_key")


def _all_jobs(spark, sf, stages=None):
    st = stages if stages is not None else {}
    for e in ("paper", "startup", "product", "news", "job"):
        st.setdefault(e, {})
    # each job's parsed records are checkpointed once: the counters branch off them
    papers = job_papers(atom_paper_payloads(spark, sf), star_payloads(spark, sf), None, LOG_TS, stages=st["paper"],
                        checkpoint=True)
    startups = job_startups(startup_payloads(spark, sf), None, None, LOG_TS, stages=st["startup"], checkpoint=True)
    products = job_products(product_payloads(spark, sf), None, None, None, LOG_TS, stages=st["product"],
                            checkpoint=True)
    news = job_news(news_feed_payloads(spark, sf), REFERENCE_TIME, None, None, None, 24.0, LOG_TS, stages=st["news"],
                    checkpoint=True)
    jobs = job_jobs(job_json_payloads(spark, sf), job_feed_payloads(spark, sf), JOBS_REFERENCE_TIME, None, 24.0, LOG_TS,
                    stages=st["job"], checkpoint=True)
    return papers, startups, products, news, jobs


@register("job_export")
def q_job_export(spark, sf):
    """Six tab projections over the five jobs and the mapping log: (tab, rows)."""
    from ..operators.resolve import mapping_log
    from .q_resolve import _resolved
    papers, startups, products, news, jobs = _all_jobs(spark, sf)
    log = mapping_log(_resolved(spark, sf), "raw_name", "source_url", LOG_TS).withColumn("id", F.sha2(
        F.concat_ws("|", "raw_name", "source_url"), 256))
    return job_export({"Startups": startups, "Products": products, "Research Papers": papers, "Jobs": jobs,
                       "News": news, "Entity Mapping Log": log})


@register("run_metrics")
def q_run_metrics(spark, sf):
    """The 13 run counters over the five jobs (one row); no provider is asked, so its two counters are 0."""
    stages: dict = {}
    papers, startups, products, news, jobs = _all_jobs(spark, sf, stages)
    return job_metrics({"paper": papers, "startup": startups, "product": products, "news": news, "job": jobs},
                       stages)


def _count_oracles():
    """Exact oracles for the composite counts, built from the five job oracles."""
    from .catalog import ORACLES
    need = ["job_papers", "job_startups", "job_products", "job_news", "job_jobs"]
    if not all(n in ORACLES for n in need):
        return
    sub = {n: f"(SELECT count(*) FROM ({ORACLES[n]}))" for n in need}
    stars = f"(SELECT count(*) FROM ({ORACLES['job_papers']}) WHERE github_stars IS NOT NULL)"
    skipped = " + ".join(f"(SELECT count(*) FROM ({ORACLES[n]}) WHERE extraction_status = 'skipped')"
                         for n in ("job_startups", "job_products"))
    total = " + ".join(sub.values())
    from ..operators.reports import METRIC_NAMES
    cnt = lambda sql: f"(SELECT count(*) FROM ({sql}))"
    startups_p = _ST + " SELECT * FROM p"
    startups_bad = (f"SELECT * FROM ({STARTUPS_SQL}) WHERE founding_year IS NOT NULL "
                    f"AND founding_year NOT BETWEEN 1800 AND 2026")
    listings = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY partkey) AS rn "
                f"FROM ({PRODUCTS_SQL})) WHERE rn = 1")
    fresh_news = _EXPECTED + " SELECT * FROM g WHERE verdict = 'FRESH' AND (event_id // 16) % 7 <> 3"
    stale_news = _EXPECTED + " SELECT * FROM g WHERE verdict = 'STALE' AND (event_id // 16) % 7 <> 3"
    stale_jobs = (f"SELECT * FROM ({_JOBS_ROWS}) WHERE "
                  f"(epoch_us(TIMESTAMP '{JOBS_REFERENCE_TIME}') - epoch_us(ts)) / 3600000000.0 > 24")

    def matches(names_sql):
        return (f"(SELECT count(*) FROM ({resolve_sql(names_sql)} SELECT 1 FROM names JOIN res "
                f"ON names.raw_name = res.raw_name WHERE res.match_method <> 'UNRESOLVED'))")
    discovered = " + ".join([sub["job_papers"], cnt(startups_p), cnt(listings), cnt(fresh_news), cnt(_FRESH_JOBS)])
    vals = {"records_discovered": discovered,
            "records_processed": total,
            "records_rejected": cnt(startups_bad),
            "duplicates": f"({discovered}) - ({total})",
            "fresh_records": f"{sub['job_news']} + {sub['job_jobs']}",
            "stale_records": f"{cnt(stale_news)} + {cnt(stale_jobs)}",
            "entity_matches": " + ".join([
                matches(f"SELECT name AS raw_name FROM ({startups_p})"),
                matches(f"SELECT company_name AS raw_name FROM ({listings}) WHERE company_name <> ''"),
                matches(f"SELECT company_name AS raw_name FROM ({_FRESH_JOBS})")]),
            "github_stars_enriched": stars, "deterministic_extractions": total,
            "llm_extractions_attempted": "0",
            "llm_extractions_skipped": f"{sub['job_papers']} + {sub['job_news']} + {sub['job_jobs']} + {skipped}"}
    ORACLES["run_metrics"] = "SELECT " + ", ".join(
        f"CAST({vals.get(n, '0')} AS BIGINT) AS {n}" for n in METRIC_NAMES)
    tabs = [("Startups", sub["job_startups"]), ("Products", sub["job_products"]),
            ("Research Papers", sub["job_papers"]), ("Jobs", sub["job_jobs"]), ("News", sub["job_news"]),
            ("Entity Mapping Log", "(SELECT count(*) FROM customer)")]
    ORACLES["job_export"] = " UNION ALL ".join(f"SELECT '{t}' AS tab, CAST({c} AS BIGINT) AS rows" for t, c in tabs)


_count_oracles()
