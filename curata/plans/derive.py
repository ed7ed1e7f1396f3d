"""Inputs for the curation operators, derived by Spark from the driver tables.

Each derivation is deterministic in the row ids, so an oracle can state the
expected answer from the original columns without re-implementing a parser.
Formats are *chosen* by id arithmetic, and so are missing ids and names and failed pages,
whose rows the scans drop.  Those are for the queries about scans, filters and jobs; with
``complete`` every row of the table gets a record that its scan keeps, for the queries
about columns.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# --- fixed values -----------------------------------------------------------
REFERENCE_TIME = "2024-01-16 00:00:00"      # inside the events month, UTC
DATE_FORMATS = 12                           # raw date shapes rendered from events.ts
RELATIVE_UNITS = ["secs", "minutes", "hrs", "d"]
KEYWORDS = ["just now", "Today", "yesterday", "2 weeks ago", "", None]
# ---------------------------------------------------------------------------


def _ts(c):
    return F.col(c).cast("timestamp")


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, user_id, event_type, value, ts, fmt, raw_date)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", _ts("ts").alias("ts"))
    fmt = (F.col("event_id") % DATE_FORMATS)
    sub = ((F.col("event_id") / DATE_FORMATS).cast("long") % 4)
    sub6 = ((F.col("event_id") / DATE_FORMATS).cast("long") % len(KEYWORDS))
    ts = F.col("ts")
    shift = lambda minutes: F.timestamp_micros(F.unix_micros(ts) + F.lit(minutes * 60_000_000))
    n = (F.col("user_id") % 40)
    rel = F.concat(n.cast("string"),
                   F.when(sub == 0, F.lit(" secs ago")).when(sub == 1, F.lit(" minutes ago"))
                    .when(sub == 2, F.lit(" hrs ago")).otherwise(F.lit("d ago")))
    kw = F.lit(None).cast("string")
    for i, k in enumerate(KEYWORDS):
        kw = F.when(sub6 == i, F.lit(k).cast("string")).otherwise(kw)
    raw = (F.when(fmt == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(fmt == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(fmt == 2, F.concat(F.date_format(shift(330), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
            .when(fmt == 3, F.concat(F.date_format(shift(-480), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-0800")))
            .when(fmt == 4, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
            .when(fmt == 5, F.concat(F.date_format(shift(-300), "d MMM yyyy HH:mm:ss"), F.lit(" -0500")))
            .when(fmt == 6, F.concat(F.date_format(shift(-300), "dd MMM yyyy HH:mm"), F.lit(" EST")))
            .when(fmt == 7, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(fmt == 8, F.date_format(ts, "yyyy-MM-dd"))
            .when(fmt == 9, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(fmt == 10, rel)
            .otherwise(kw))
    return ev.withColumn("fmt", fmt).withColumn("raw_date", raw)


# --- payload bodies ----------------------------------------------------------
ENTRIES_PER_PAGE = 8
FEED_ITEMS_PER_PAGE = 16
NEWS_SOURCES = ["click", "error", "purchase", "signup", "view"]   # events.event_type, registry order


def _grouped(df: DataFrame, keys: dict, order, fields: list, render, sep: str = "") -> DataFrame:
    """The rows of every page (``keys``: name -> column) as one text ``inner``: what ``render`` makes
    of a row's ``fields``, in the order of ``order``, then of the text.

    The table's own columns are shuffled and rendered page by page afterwards: the texts are several
    times as long, and so long an expression over single rows makes a method too large to be compiled."""
    g = df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.collect_list(F.struct(order.alias("_o"), *fields)).alias("_rs"))
    pieces = F.sort_array(F.transform("_rs", lambda r: F.struct(r["_o"].alias("o"), render(lambda f: r[f]).alias("piece"))))
    return g.select(*keys, F.array_join(F.transform(pieces, lambda s: s["piece"]), sep).alias("inner"))


def _pages(df: DataFrame, page, order, fields: list, render, head: str, tail: str, sep: str = "") -> DataFrame:
    """Group rows into payload pages of bounded size; pieces concatenated in id order."""
    g = _grouped(df, {"page": page}, order, fields, render, sep)
    return g.select("page", F.concat(F.lit(head), F.col("inner"), F.lit(tail)).alias("body"))


def _payload(df: DataFrame, kind: str, source_name, url, status=None, rank=None) -> DataFrame:
    status = F.lit(200) if status is None else status
    rank = F.lit(0) if rank is None else rank
    src = source_name if not isinstance(source_name, str) else F.lit(source_name)
    u = url if not isinstance(url, str) else F.lit(url)
    return df.select(u.alias("url"), src.alias("source_name"), F.lit(kind).alias("kind"),
                     status.cast("int").alias("status_code"), "body",
                     F.lit(None).cast("string").alias("error"), rank.cast("int").alias("source_rank"),
                     F.col("page").cast("long").alias("page"))


def atom_paper_payloads(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """orders -> Atom pages of 8 entries.  Orders with key % 11 == 0 lack <id> (``complete``: have
    one that is no web address)."""
    o = table(spark, sf_dir, "orders")

    def entry(c):
        k = c("o_orderkey")
        ks = k.cast("string")
        repo_in_abstract = F.when(k % 3 == 0, F.concat(F.lit(" Code at https://github.com/c"), c("o_custkey").cast("string"),
                                                       F.lit("/r"), ks, F.lit(".")))
        comment = F.when(k % 5 == 1, F.concat(F.lit("<arxiv:comment>Repo: https://github.com/x/y"), ks,
                                              F.lit(")</arxiv:comment>"))).otherwise(F.lit(""))
        return F.concat(
            F.lit("<entry>"),
            F.when(k % 11 != 0, F.concat(F.lit("<id>http://arxiv.example.org/abs/"), ks, F.lit("</id>"))).otherwise(
                F.concat(F.lit("<id>urn:paper:"), ks, F.lit("</id>")) if complete else F.lit("")),
            F.lit("<title>  Paper "), c("o_orderpriority"), F.lit("\n   on\t "), c("o_orderstatus"), F.lit("  </title>"),
            F.lit("<published>"), F.date_format(c("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            F.lit("</published>"),
            F.lit("<summary>Abstract  for\n order "), ks, F.coalesce(repo_in_abstract, F.lit("")), F.lit("</summary>"),
            F.lit("<author><name>Author "), c("o_custkey").cast("string"), F.lit("</name></author>"),
            F.lit("<author><name> Clerk "), (k % 7).cast("string"), F.lit(" </name></author>"),
            comment, F.lit("</entry>"))
    k = F.col("o_orderkey")
    pages = _pages(o, (k / ENTRIES_PER_PAGE).cast("long"), k,
                   ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate"], entry,
                   '<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" '
                   'xmlns:arxiv="http://arxiv.org/schemas/atom">', "</feed>")
    return _payload(pages, "atom_papers", "arxiv",
                    F.concat(F.lit("https://export.arxiv.example.org/api/query?page="), F.col("page").cast("string")))


def news_feed_payloads(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """events -> RSS (even pages) / Atom (odd pages) feeds of 16 items, one source per
    event type.  Every 7th page of a source failed to fetch (status 503; ``complete``: none did)."""
    d = raw_dates(spark, sf_dir)
    page = (F.col("event_id") / FEED_ITEMS_PER_PAGE).cast("long")

    def item(c):
        eid, user = c("event_id").cast("string"), c("user_id").cast("string")
        link = F.concat(F.lit("https://news.example.com/"), c("event_type"), F.lit("/"), user)
        desc = F.concat(F.lit("&lt;p&gt;Event &lt;b&gt;"), eid, F.lit("&lt;/b&gt; "), c("event_type"), F.lit("&lt;/p&gt;"))
        pub = F.coalesce(c("raw_date"), F.lit(""))
        rss_item = F.concat(F.lit("<item><title>Story "), eid, F.lit("</title><link>"), link, F.lit("</link><pubDate>"), pub,
                            F.lit("</pubDate><dc:creator>user "), user,
                            F.lit("</dc:creator><description>"), desc, F.lit("</description></item>"))
        atom_entry = F.concat(F.lit("<entry><title>Story "), eid, F.lit("</title><link href=\""), link,
                              F.lit("\"/><updated>"), pub, F.lit("</updated><author><name>user "),
                              user, F.lit("</name></author><summary>"), desc, F.lit("</summary></entry>"))
        return F.when(c("pg") % 2 == 0, rss_item).otherwise(atom_entry)
    d = d.withColumn("pg", page)
    g = _grouped(d, {"event_type": F.col("event_type"), "pg": F.col("pg")}, F.col("event_id"),
                 ["event_id", "user_id", "event_type", "raw_date", "pg"], item)
    inner = F.col("inner")
    body = F.when(F.col("pg") % 2 == 0,
                  F.concat(F.lit('<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'
                                 '<title>feed</title>'), inner, F.lit("</channel></rss>"))) \
            .otherwise(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), inner, F.lit("</feed>")))
    rank = F.array_position(F.array(*[F.lit(s) for s in NEWS_SOURCES]), F.col("event_type")) - 1
    status = F.lit(200) if complete else F.when(F.col("page") % 7 == 3, F.lit(503)).otherwise(F.lit(200))
    out = g.select("event_type", F.col("pg").alias("page"), body.alias("body"))
    return _payload(out, "news_feed", F.col("event_type"),
                    F.concat(F.lit("https://news.example.com/"), F.col("event_type"), F.lit("/feed?page="),
                             F.col("page").cast("string")), status, rank)


def news_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(s, "news_feed", f"https://news.example.com/{s}/feed", i) for i, s in enumerate(NEWS_SOURCES)],
        "source_name string, kind string, url string, rank int")


# --- company names, roles ----------------------------------------------------
ROLE_TITLES = ["Senior Machine Learning Engineer", "AI Researcher", "Backend Developer", "Product Manager",
               "Growth Marketing Lead", "Office Coordinator", "Research Scientist, LLM", "Data Scientist"]
ROLE_NOTES = ["Software development role", "Fulfillment team", None, "Great team"]
NAME_VARIANTS = 6   # exact, suffixed upper, alias key, tokens reversed, one char dropped, unrelated


def company_name(k) -> "F.Column":
    """A company name rendered from a key: a seed entity in one of six spellings."""
    from ..operators.resolve import KNOWN_ALIASES, SEED_ENTITIES
    seeds = F.array(*[F.lit(s) for s in SEED_ENTITIES])
    alias_keys = F.array(*[F.lit(a) for a in KNOWN_ALIASES])
    seed = F.element_at(seeds, (k % len(SEED_ENTITIES) + 1).cast("int"))
    variant = (k / len(SEED_ENTITIES)).cast("long") % NAME_VARIANTS
    return (F.when(variant == 0, seed)
             .when(variant == 1, F.concat(F.upper(seed), F.lit(", Inc.")))
             .when(variant == 2, F.element_at(alias_keys, (k % len(KNOWN_ALIASES) + 1).cast("int")))
             .when(variant == 3, F.array_join(F.reverse(F.split(seed, " ")), " "))
             .when(variant == 4, F.concat(F.substring(seed, 1, 1), F.substring(seed, 3, 1000)))
             .otherwise(F.concat(F.lit("Company "), k.cast("string"))))


def _role(k) -> "F.Column":
    """A role title by key; a null key takes the last."""
    at = F.coalesce((k % len(ROLE_TITLES) + 1).cast("int"), F.lit(-1))
    return F.element_at(F.array(*[F.lit(r) for r in ROLE_TITLES]), at)


def _jstr(c) -> "F.Column":
    """JSON string literal of a column: backslash, quote and control characters escaped."""
    e = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for ch, rep in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        e = F.replace(e, F.lit(ch), F.lit(rep))
    return F.concat(F.lit('"'), e, F.lit('"'))


def _jplain(c) -> "F.Column":
    """JSON string literal of a text that our own pattern made: nothing in it needs an escape."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _jobj(*pairs) -> "F.Column":
    """JSON object text from (key, json-fragment-or-null) pairs; null fragments are omitted."""
    frags = [F.concat(F.lit(f'"{k}":'), v) for k, v in pairs]   # null with a null fragment, worked out once
    return F.concat(F.lit("{"), F.concat_ws(",", *frags), F.lit("}"))


def job_json_payloads(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """orders -> job API pages of 8 (list bodies on even pages, {"jobs": [...]} on odd).  Every 13th
    has no company (``complete``: none)."""
    o = table(spark, sf_dir, "orders")

    def item(c):
        k = c("o_orderkey")
        role = _role(k)
        note = F.element_at(F.array(*[F.lit(r) for r in ROLE_NOTES]), (k % len(ROLE_NOTES) + 1).cast("int"))
        company = company_name(c("o_custkey"))
        company = company if complete else F.when(k % 13 == 0, F.lit("")).otherwise(company)
        url = F.concat(F.lit("https://jobs.example.com/o/"), k.cast("string"))
        date = F.date_format(c("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        loc = F.when(k % 3 == 0, F.lit("Berlin")).when(k % 3 == 1, F.lit(""))
        return _jobj(("company", _jstr(company)),
                     ("position", F.when(k % 2 == 0, _jstr(role))),
                     ("title", F.when(k % 2 == 1, _jstr(role))),
                     ("url", F.when(k % 4 < 2, _jplain(url))),
                     ("apply_url", F.when(k % 4 >= 2, _jplain(url))),
                     ("date", F.when(k % 5 != 0, _jplain(date))),
                     ("publication_date", F.when(k % 5 == 0, _jplain(date))),
                     ("location", _jplain(loc)),
                     ("description", _jstr(note)))
    k = F.col("o_orderkey")
    g = _grouped(o, {"pg": (k / ENTRIES_PER_PAGE).cast("long")}, k, ["o_orderkey", "o_custkey", "o_orderdate"], item, ",")
    arr = F.concat(F.lit("["), F.col("inner"), F.lit("]"))
    body = F.when(F.col("pg") % 2 == 0, arr).otherwise(F.concat(F.lit('{"jobs":'), arr, F.lit("}")))
    out = g.select(F.col("pg").alias("page"), body.alias("body"))
    return _payload(out, "jobs_json", "JobBoardAPI",
                    F.concat(F.lit("https://jobs.example.com/api?page="), F.col("page").cast("string")))


def job_feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> RSS job feeds of 16 items (title shapes: 'R at C', 'C: R', 'R')."""
    li = table(spark, sf_dir, "lineitem")

    def item(c):
        ln = c("l_linenumber")
        role = _role(c("l_partkey"))
        comp = F.concat(F.lit("Supplier "), c("l_suppkey").cast("string"))
        title = (F.when(ln <= 3, F.concat(role, F.lit(" at "), comp))
                  .when(ln <= 5, F.concat(comp, F.lit(": "), role))
                  .otherwise(role))
        link = F.concat(F.lit("https://jobs.example.com/l/"), c("l_orderkey").cast("string"), F.lit("/"), ln.cast("string"))
        desc = F.concat(F.lit("&lt;b&gt;"), c("l_returnflag"), F.lit("&lt;/b&gt; role"))
        return F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), link, F.lit("</link><pubDate>"),
                        F.date_format(c("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                        F.lit("</pubDate><description>"), desc, F.lit("</description></item>"))
    seq = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    pages = _pages(li, (seq / FEED_ITEMS_PER_PAGE).cast("long"), seq,
                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"], item,
                   "<rss><channel><title>jobs</title>", "</channel></rss>")
    # some feeds are not well-formed: a bare ampersand, an HTML entity, a cut-off end
    broken = (F.when(F.col("page") % 17 == 2, F.replace("body", F.lit("<title>jobs<"), F.lit("<title>R & D jobs<")))
               .when(F.col("page") % 17 == 3, F.replace("body", F.lit("<title>jobs<"), F.lit("<title>jobs&nbsp;2024<")))
               .when(F.col("page") % 17 == 4, F.replace("body", F.lit("</channel></rss>"), F.lit("<item><title>cut"))))
    pages = pages.withColumn("body", F.coalesce(broken, F.col("body")))
    return _payload(pages, "jobs_feed", "JobFeed",
                    F.concat(F.lit("https://jobs.example.com/feed?page="), F.col("page").cast("string")))


def startup_payloads(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """customer -> company-directory JSON pages of 8 objects with mixed field types.  Every 17th
    has no name (``complete``: none)."""
    def item(c):
        k = c("c_custkey")
        ks = k.cast("string")
        name = company_name(k) if complete else F.when(k % 17 == 0, F.lit("")).otherwise(company_name(k))
        website = F.when(k % 3 == 0, F.concat(F.lit("https://c"), ks, F.lit(".example.com"))).when(k % 3 == 1, F.lit(""))
        one = F.when(k % 4 == 0, F.concat(F.lit("One liner "), c("c_mktsegment"))).when(k % 4 == 1, F.lit(""))
        long_d = F.when(k % 5 == 0, F.repeat(F.concat(F.lit("Long text "), c("c_name"), F.lit(" ")), 20)) \
                  .when(k % 5 == 1, F.lit("Short long"))
        team = (F.when(k % 6 == 0, (k % 300).cast("string")).when(k % 6 == 1, F.lit('"12"'))
                 .when(k % 6 == 2, F.lit("0")).when(k % 6 == 3, F.lit("-5")).when(k % 6 == 4, F.lit("3.5")))
        secs = (F.lit(1_000_000_000) + k * 86400 * 7)
        launched = (F.when(k % 5 == 0, secs.cast("string")).when(k % 5 == 1, F.concat(secs.cast("string"), F.lit(".5")))
                     .when(k % 5 == 2, F.lit("0")).when(k % 5 == 3, F.lit('"1451606400"')))
        tags = F.when(k % 7 == 0, F.lit("[]")).otherwise(
            F.concat(F.lit('["tag'), (k % 3).cast("string"), F.lit('","ai"]')))
        inds = F.when(k % 7 == 0, F.lit("[]")).otherwise(F.to_json(F.array(F.lit("ai"), c("c_mktsegment"))))
        return _jobj(("name", _jstr(name)), ("website", F.when(website.isNotNull(), _jstr(website))),
                     ("one_liner", F.when(one.isNotNull(), _jstr(one))),
                     ("long_description", F.when(long_d.isNotNull(), _jstr(long_d))),
                     ("all_locations", _jstr(F.when(k % 2 == 0, F.concat(F.lit("Nation "), c("c_nationkey").cast("string")))
                                              .otherwise(F.lit("")))),
                     ("team_size", team), ("launched_at", launched),
                     ("stage", _jstr(F.when(k % 2 == 0, c("c_mktsegment")).otherwise(F.lit("")))),
                     ("tags", tags), ("industries", inds),
                     ("url", F.when(k % 2 == 0, _jstr(F.concat(F.lit("https://directory.example.com/companies/"), ks)))))
    k = F.col("c_custkey")
    pages = _pages(table(spark, sf_dir, "customer"), (k / ENTRIES_PER_PAGE).cast("long"), k,
                   ["c_custkey", "c_mktsegment", "c_name", "c_nationkey"], item, "[", "]", ",")
    return _payload(pages, "startups_json", "CompanyDirectory",
                    F.concat(F.lit("https://directory.example.com/api/tag?page="), F.col("page").cast("string")))


def product_payloads(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """part -> app-listing JSON pages of 8 objects.  Some lack an owner or likes (``complete``: none)."""
    def item(c):
        k = c("p_partkey")
        ks = k.cast("string")
        owner = F.lower(F.replace(c("p_brand"), F.lit("#"), F.lit("")))
        lname = F.concat(F.replace(c("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), (k % 97).cast("string"))
        lid, likes = F.concat(owner, F.lit("/"), lname), c("p_size")
        if complete:
            likes = (likes + 3).cast("string")
        else:
            lid = F.when(k % 10 == 0, F.concat(F.lit("noslash"), ks)).otherwise(lid)
            likes = F.when(k % 4 != 0, likes.cast("string"))
        sdk = F.when(k % 3 == 0, F.lit("gradio")).when(k % 3 == 1, F.lit("streamlit"))
        tags = (F.when(k % 5 == 0, F.lit("[]")).when(k % 5 == 1, F.lit(None))
                 .otherwise(F.to_json(F.array(c("p_type"), F.lit("t1"), F.lit("t2"), F.lit("t3"), F.lit("t4"), F.lit("t5")))))
        card = (F.when(k % 6 == 1, F.lit("{}"))
                 .when(k % 6 == 2, _jobj(("title", _jstr(c("p_name"))),
                                         ("short_description", _jstr(F.concat(F.lit("Desc "), c("p_type")))),
                                         ("license", _jstr(F.lit("MIT")))))
                 .when(k % 6 == 3, _jobj(("title", _jstr(lname)), ("license", _jstr(F.lit("apache-2.0")))))
                 .when(k % 6 == 4, _jobj(("title", _jstr(F.concat(F.lit("T "), c("p_name")))),
                                         ("license", _jstr(F.lit("proprietary")))))
                 .when(k % 6 == 5, F.lit('{"license":null}')))
        return _jobj(("id", _jstr(lid)), ("likes", likes), ("sdk", F.when(sdk.isNotNull(), _jstr(sdk))),
                     ("tags", tags), ("cardData", card))
    k = F.col("p_partkey")
    pages = _pages(table(spark, sf_dir, "part"), (k / ENTRIES_PER_PAGE).cast("long"), k,
                   ["p_partkey", "p_brand", "p_name", "p_size", "p_type"], item, "[", "]", ",")
    return _payload(pages, "products_json", "AppListings",
                    F.concat(F.lit("https://listings.example.com/api/spaces?page="), F.col("page").cast("string")))


def star_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> one repo API body per order; star count typed by key % 4."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    body = (F.when(k % 4 == 0, F.concat(F.lit('{"stargazers_count":'), (k % 5000).cast("string"), F.lit("}")))
             .when(k % 4 == 1, F.lit('{"stargazers_count":"many"}'))
             .when(k % 4 == 2, F.lit('{"stargazers_count":12.5}'))
             .otherwise(F.lit('{"name":"x"}')))
    url = F.concat(F.lit("https://api.github.com/repos/c"), F.col("o_custkey").cast("string"), F.lit("/r"), k.cast("string"))
    return o.select(url.alias("url"), F.lit("GitHubAPI").alias("source_name"), F.lit("repo_json").alias("kind"),
                    F.lit(200).alias("status_code"), body.alias("body"), F.lit(None).cast("string").alias("error"),
                    F.lit(0).alias("source_rank"), k.alias("page"))


# --- pages with embedded dates ------------------------------------------------
HTML_DATE_KINDS = 6   # JSON-LD, meta property, meta name, <time datetime>, <time>relative</time>, none


def pages_with_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> html with one embedded publication date chosen by page_id (ts = 2024-01-01 + id hours)."""
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    ts = F.timestamp_micros(F.lit(1_704_067_200_000_000) + k * F.lit(3_600_000_000))
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = k % HTML_DATE_KINDS
    head_add = (F.when(kind == 0, F.concat(F.lit('<script type="application/ld+json">{"@type": "NewsArticle", '
                                                 '"datePublished": "'), iso, F.lit('"}</script>')))
                 .when(kind == 1, F.concat(F.lit('<meta property="article:published_time" content="'), iso, F.lit('">')))
                 .when(kind == 2, F.concat(F.lit('<meta name="date" content="'), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                                           F.lit('">')))
                 .otherwise(F.lit("")))
    body_add = (F.when(kind == 3, F.concat(F.lit('<time datetime="'), iso, F.lit('">later</time>')))
                 .when(kind == 4, F.concat(F.lit("<time> "), (k % 48).cast("string"), F.lit(" hours ago </time>")))
                 .otherwise(F.lit("")))
    html = F.replace(F.replace(F.col("html"), F.lit("</head>"), F.concat(head_add, F.lit("</head>"))),
                     F.lit("<article>"), F.concat(F.lit("<article>"), body_add))
    return p.select("page_id", "url", html.alias("html"))
