"""HTML text, page dates, chunking, validation gates and enrichment joins."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.chunking import chunk_udf, estimate_tokens
from ..functions.html import article_text, html_date
from ..operators.enrich import enrich_article, enrich_readme, enrich_stars, filter_content
from ..operators.extract import needs_extraction
from ..operators.validate import with_violations
from ..sources.payloads import scan_papers_atom, scan_stars_json
from .catalog import register
from .derive import REFERENCE_TIME, atom_paper_payloads, pages_with_dates, star_payloads
from .tables import table


@register("html_date", f"""
SELECT page_id, CASE page_id % 6
  WHEN 0 THEN epoch_us(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 HOUR)
  WHEN 1 THEN epoch_us(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 HOUR)
  WHEN 2 THEN epoch_us(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 HOUR)
  WHEN 3 THEN epoch_us(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 HOUR)
  WHEN 4 THEN epoch_us(TIMESTAMP '{REFERENCE_TIME}') - (page_id % 48) * 3600000000
  END AS published_us
FROM pages""")
def q_html_date(spark, sf):
    p = pages_with_dates(spark, sf)
    return p.select("page_id", F.unix_micros(html_date(F.col("html"), REFERENCE_TIME)).alias("published_us"))


def _pages_with_articles(spark, sf):
    """pages with an article put before their markup: boilerplate and short paragraphs to leave
    out, an entity to decode, and for every fifth page a text of over 9,000 characters."""
    n = F.col("page_id").cast("string")
    long = F.repeat(F.concat(F.lit("Paragraph about page "), n, F.lit(". ")), F.when(F.col("page_id") % 5 == 0, 400).otherwise(10))
    body = F.concat(F.lit("<html><body><article><nav><p>Links that are long enough to count elsewhere</p></nav><p>"), long,
                    F.lit("</p><p>short</p><p>Second &amp; last paragraph of page "), n, F.lit(".</p></article>"))
    return table(spark, sf, "pages").withColumn("html", F.concat(body, F.coalesce("html", F.lit(""))))


_ARTICLE_SQL = """
WITH a AS (SELECT page_id, url, rtrim(repeat('Paragraph about page ' || page_id || '. ', CASE WHEN page_id % 5 = 0 THEN 400 ELSE 10 END))
             || chr(10) || chr(10) || 'Second & last paragraph of page ' || page_id || '.' AS text FROM pages)"""


@register("article_text", _ARTICLE_SQL + """
SELECT page_id, CAST(length(text) AS BIGINT) AS text_len, sha256(text) AS text_sha256 FROM a""")
def q_article_text(spark, sf):
    p = _pages_with_articles(spark, sf)
    t = p.select("page_id", article_text(F.col("html")).alias("text"))
    return t.select("page_id", F.length("text").cast("long").alias("text_len"),
                    F.sha2(F.col("text"), 256).alias("text_sha256"))


@register("article_text_pages")
def q_article_text_pages(spark, sf):
    """The article text of every page from its own markup."""
    t = table(spark, sf, "pages").select("page_id", article_text(F.col("html")).alias("text"))
    return t.select("page_id", F.length("text").cast("long").alias("text_len"),
                    F.sha2(F.col("text"), 256).alias("text_sha256"))


@register("filter_content", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE length(text) > 100""")
def q_filter_content(spark, sf):
    d = table(spark, sf, "documents")
    return filter_content(d, "text").select("doc_id", F.length("text").cast("long").alias("n_chars"))


@register("estimate_tokens", """
SELECT doc_id, CASE WHEN text IS NULL OR length(text) = 0 THEN 0 ELSE length(text) // 4 + 1 END AS est_tokens
FROM documents""")
def q_estimate_tokens(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", estimate_tokens("text").alias("est_tokens"))


def _chunks(spark, sf):
    d = table(spark, sf, "documents")
    c = d.select("doc_id", chunk_udf()(F.col("text")).alias("chunks"))
    return c.select("doc_id", F.posexplode("chunks").alias("chunk_no", "chunk"))


def _ws_class() -> str:
    """Python's whitespace set as an RE2 character class body."""
    from ..functions.strings import PY_WHITESPACE
    return "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE)


def _chunks_sql(budget: int = 2000, overlap_chars: int = 600) -> str:
    """Greedy paragraph packing stated in DuckDB: pieces = text and separators
    interleaved, folded left with a struct accumulator (chunks, current, used)."""
    ws = _ws_class()
    sep = f"(\\n[{ws}]*\\n|\\n)"
    strip = lambda x: f"regexp_replace({x}, '^[{ws}]+|[{ws}]+$', '', 'g')"
    est = lambda x: f"(CASE WHEN {x} = '' THEN 0 ELSE length({x}) // 4 + 1 END)"
    done = strip("acc.cur")
    tail = f"(CASE WHEN length({done}) > {overlap_chars} THEN right({done}, {overlap_chars}) ELSE '' END)"
    step = (f"CASE WHEN acc.has AND acc.used + {est('x')} > {budget} THEN "
            f"{{'out': CASE WHEN {done} <> '' THEN list_append(acc.out, {done}) ELSE acc.out END, "
            f"'cur': {tail} || x, 'has': true, 'used': {est(tail + ' || x')}}} "
            f"ELSE {{'out': acc.out, 'cur': acc.cur || x, 'has': true, 'used': acc.used + {est('x')}}} END")
    return f"""
WITH p AS (SELECT doc_id, text, regexp_split_to_array(text, '{sep}') AS t, regexp_extract_all(text, '{sep}') AS s
           FROM documents),
q AS (SELECT doc_id, text, flatten(list_transform(range(1, len(t) + 1),
        lambda i: CASE WHEN i <= len(s) THEN [t[i], s[i]] ELSE [t[i]] END)) AS parts FROM p),
r AS (SELECT doc_id, text, list_reduce(parts, lambda acc, x: {step},
        {{'out': []::VARCHAR[], 'cur': '', 'has': false, 'used': 0::BIGINT}}) AS st FROM q),
c AS (SELECT doc_id, CASE WHEN text IS NULL OR {strip('text')} = '' THEN []::VARCHAR[]
                          WHEN {est('text')} <= {budget} THEN [{strip('text')}]
                          WHEN {strip('st.cur')} <> '' THEN list_append(st.out, {strip('st.cur')})
                          ELSE st.out END AS chunks FROM r),
u AS (SELECT doc_id, generate_subscripts(chunks, 1) AS i, unnest(chunks) AS ch FROM c)
"""


@register("chunk_text", _chunks_sql() + """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, CAST(length(ch) AS BIGINT) AS chars,
       CAST(CASE WHEN ch = '' THEN 0 ELSE length(ch) // 4 + 1 END AS BIGINT) AS est_tokens FROM u""")
def q_chunk_text(spark, sf):
    """(doc_id, chunk_no, chars, est_tokens) for every chunk of every document."""
    c = _chunks(spark, sf)
    return c.select("doc_id", F.col("chunk_no").cast("int").alias("chunk_no"),
                    F.length("chunk").cast("long").alias("chars"), estimate_tokens("chunk").alias("est_tokens"))


@register("first_chunk", _chunks_sql() + " SELECT doc_id, CAST(length(ch) AS BIGINT) AS chars FROM u WHERE i = 1")
def q_first_chunk(spark, sf):
    """Only chunk 0 of each document goes to extraction (the chunker stops there)."""
    d = table(spark, sf, "documents")
    c = d.select("doc_id", F.get(chunk_udf(first_only=True)(F.col("text")), 0).alias("chunk"))
    return c.filter(F.col("chunk").isNotNull()).select("doc_id", F.length("chunk").cast("long").alias("chars"))


_STARTUP_ROWS_SQL = """
SELECT c_custkey AS custkey,
  concat_ws(',',
    CASE WHEN c_custkey % 10 IN (0, 1) THEN 'source_url_http' END,
    CASE WHEN c_custkey % 19 = 0 THEN 'name_required' END,
    CASE WHEN c_acctbal < 0 THEN 'employee_count_nonnegative' END,
    CASE WHEN 1700 + c_custkey % 400 NOT BETWEEN 1800 AND 2026 THEN 'founding_year_range' END) AS violations
FROM customer"""


@register("validate_entities", _STARTUP_ROWS_SQL)
def q_validate_entities(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    rows = c.select(
        k.alias("custkey"),
        F.when(k % 10 == 0, F.concat(F.lit("ftp://x/"), k.cast("string"))).when(k % 10 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("https://c/"), k.cast("string"))).alias("source_url"),
        F.when(k % 19 == 0, F.lit("")).otherwise(F.col("c_name")).alias("name"),
        F.floor("c_acctbal").cast("int").alias("employee_count"),
        (F.lit(1700) + k % 400).cast("int").alias("founding_year"))
    v = with_violations(rows, "startup")
    return v.select("custkey", F.array_join("violations", ",").alias("violations"))


@register("needs_extraction", """
SELECT doc_id,
  CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'skipped'
       WHEN length(text) >= 50 THEN 'attempt' ELSE 'deterministic' END AS startup_status,
  CASE WHEN length(text) >= 200 THEN 'attempt' ELSE 'skipped' END AS news_status
FROM documents""")
def q_needs_extraction(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    rows = d.select("doc_id", F.col("text").alias("raw_text"),
                    F.when(k % 3 == 0, F.col("lang")).alias("description"),
                    F.when(k % 2 == 0, F.array(F.col("source"))).otherwise(F.array().cast("array<string>"))
                     .alias("categories"))
    return rows.select("doc_id", needs_extraction("startup").alias("startup_status"),
                       needs_extraction("news").alias("news_status"))


@register("enrich_stars", """
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'urn:paper:' ELSE 'http://arxiv.example.org/abs/' END || o_orderkey AS paper_url,
       CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 = 0 THEN CAST(o_orderkey % 5000 AS INTEGER) END AS github_stars
FROM orders""")
def q_enrich_stars(spark, sf):
    papers = scan_papers_atom(atom_paper_payloads(spark, sf, complete=True))
    stars = scan_stars_json(star_payloads(spark, sf))
    return enrich_stars(papers, stars).select("paper_url", "github_stars")


@register("enrich_readme", """
SELECT doc_id, CASE WHEN doc_id % 4 <> 0 AND length(text) > 50 THEN length(text) END AS readme_chars
FROM documents""")
def q_enrich_readme(spark, sf):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    products = d.select("doc_id", F.concat(F.lit("https://huggingface.co/spaces/"), F.col("source"), F.lit("/d"),
                                          k.cast("string")).alias("source_url"),
                        (k % 4 != 0).alias("needs_extraction"))
    copy = F.explode(F.array(F.lit(1), F.lit(2)))       # every readme was landed twice; the later copy counts
    readmes = d.select(F.concat(F.col("source"), F.lit("/d"), k.cast("string")).alias("listing_id"), "text",
                       copy.alias("fetched_at")).withColumn(
        "readme", F.when(F.col("fetched_at") == 2, F.col("text")).otherwise(F.lit("~ an older copy " * 9)))
    e = enrich_readme(products, readmes)
    return e.select("doc_id", F.length("readme").cast("long").alias("readme_chars"))


@register("enrich_article", _ARTICLE_SQL + """,
last AS (SELECT url, arg_max(text, page_id) AS text FROM a GROUP BY url)
SELECT 'Story ' || page_id AS title, url AS article_url,
       CASE WHEN page_id % 4 = 3 THEN 'Short summary.' ELSE last.text END AS content, page_id % 4 <> 3 AS content_enriched
FROM a JOIN last USING (url)""")
def q_enrich_article(spark, sf):
    """One story per page; pages landed twice, the later copy counts; every fourth story's page is missing."""
    p = _pages_with_articles(spark, sf)
    at = F.when(F.col("copy") == 2, F.col("page_id")).otherwise(-1)
    pages = p.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "url", F.when(F.col("copy") == 2, F.col("html")).otherwise(F.lit("<p>An older copy without a story.</p>")).alias("html"),
        at.alias("fetched_at"))
    n = F.col("page_id")
    news = table(spark, sf, "pages").select(
        F.concat(F.lit("Story "), n.cast("string")).alias("title"), F.col("url").alias("article_url"),
        F.when(n % 4 == 3, F.concat(F.lit("gone:"), F.col("url"))).otherwise(F.col("url")).alias("link"),
        F.lit("Short summary.").alias("summary"), F.lit(None).cast("string").alias("content"))
    return enrich_article(news, pages, "link").select("title", "article_url", "content", "content_enriched")


@register("enrich_article_pages")
def q_enrich_article_pages(spark, sf):
    """One story per page, its url's pages as they are; of several pages of a url the last page_id counts."""
    p = table(spark, sf, "pages")
    news = p.select(F.concat(F.lit("Story "), F.col("page_id").cast("string")).alias("title"),
                    F.col("url").alias("article_url"), F.lit("Short summary.").alias("summary"),
                    F.lit(None).cast("string").alias("content"))
    pages = p.select("url", "html", F.col("page_id").alias("fetched_at"))
    return enrich_article(news, pages).select("title", "article_url", "content", "content_enriched")


@register("parse_owner_repo", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN 'c' || o_custkey END AS owner,
       CASE WHEN o_orderkey % 5 <> 4 THEN 'r' || o_orderkey END AS repo
FROM orders""")
def q_parse_owner_repo(spark, sf):
    from ..functions.rules import parse_owner_repo
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    suffix = (F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("/")).when(k % 5 == 2, F.lit(".git"))
               .otherwise(F.lit(".git/")))
    url = F.when(k % 5 == 4, F.lit("not_a_github_url")).otherwise(
        F.concat(F.lit("https://github.com/c"), F.col("o_custkey").cast("string"), F.lit("/r"), k.cast("string"), suffix))
    r = o.select("o_orderkey", parse_owner_repo(url).alias("r"))
    return r.select("o_orderkey", F.col("r.owner").alias("owner"), F.col("r.repo").alias("repo"))
