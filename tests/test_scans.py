import json

from curata.schemas import PAYLOAD
from curata.sources.payloads import (scan_jobs_feed, scan_jobs_json, scan_news_feed, scan_papers_atom,
                                     scan_products_json, scan_stars_json, scan_startups_json)
from curata.functions.dates import with_freshness

ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
  <entry>
    <id>http://arxiv.org/abs/2408.00001v1</id>
    <published>2026-08-10T00:00:00Z</published>
    <title>  An Awesome
       AI Paper </title>
    <summary> We release code at https://github.com/example/awesome-ai. Enjoy. </summary>
    <author><name>Alice</name></author>
    <author><name>Bob</name></author>
    <arxiv:comment>10 pages</arxiv:comment>
  </entry>
  <entry><title>No id here</title></entry>
</feed>"""


def payloads(spark, kind, *bodies, url="https://example.com/feed", source="src"):
    rows = [(url, source, kind, 200, b, None, None, None, 0, i) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, PAYLOAD)


def test_atom_paper(spark):
    rows = scan_papers_atom(payloads(spark, "atom_papers", ATOM, "<not xml")).collect()
    assert len(rows) == 1
    p = rows[0]
    assert p.title == "An Awesome AI Paper"
    assert p.authors == ["Alice", "Bob"]
    assert p.paper_url == p.source_url == "http://arxiv.org/abs/2408.00001v1"
    assert p.github_repository_url == "https://github.com/example/awesome-ai"
    assert p.github_stars is None


RSS = """<rss version="2.0"><channel><title>t</title>
<item><title>Fresh story</title><link>https://n.example.com/1</link><pubDate>Sat, 15 Aug 2026 10:00:00 GMT</pubDate>
<description>&lt;p&gt;Hello &lt;b&gt;world&lt;/b&gt;&lt;/p&gt;</description></item>
<item><title>Old story</title><link>https://n.example.com/2</link><pubDate>Mon, 03 Feb 2020 10:00:00 GMT</pubDate></item>
<item><link>https://n.example.com/3</link></item>
</channel></rss>"""


def test_rss_news_one_fresh(spark):
    n = scan_news_feed(payloads(spark, "news_feed", RSS))
    f = with_freshness(n, "pub_date_raw", "2026-08-15 12:00:00", 24.0, out="f").filter("f.is_fresh").collect()
    assert [r.title for r in f] == ["Fresh story"]
    assert f[0].summary == "Helloworld"


def test_jobs_json(spark):
    body = json.dumps([
        {"company": "Anthropic", "position": "AI Alignment Researcher", "url": "https://j.example.com/1",
         "date": "2026-08-15T10:00:00Z"},
        {"company": "Old Co", "title": "Engineer", "apply_url": "https://j.example.com/2", "date": "2020-01-01T00:00:00Z"},
        {"position": "No company", "url": "https://j.example.com/3"}, "not an object"])
    j = scan_jobs_json(payloads(spark, "jobs_json", body, json.dumps({"jobs": []})))
    rows = with_freshness(j, "pub_date_raw", "2026-08-15 12:00:00", 24.0, out="f").filter("f.is_fresh").collect()
    assert len(rows) == 1
    assert rows[0].role_family == "RESEARCH" and rows[0].location == "Remote" and rows[0].is_remote


def test_jobs_feed_title_split(spark):
    rss = ("<rss><channel><item><title>Backend Developer at Acme</title><link>https://j/1</link></item>"
           "<item><title>Acme: Product Manager</title><link>https://j/2</link></item>"
           "<item><title>Plain Role</title><link>https://j/3</link></item></channel></rss>")
    rows = scan_jobs_feed(payloads(spark, "jobs_feed", rss, source="Feed")).orderBy("job_url").collect()
    assert [(r.company_name, r.role_title, r.role_family) for r in rows] == [
        ("Acme", "Backend Developer", "ENGINEERING"), ("Acme", "Product Manager", "PRODUCT"), ("Feed", "Plain Role", "OTHER")]


def test_startup_fields(spark):
    item = {"name": "Acme AI", "website": "https://acme.ai", "one_liner": "", "long_description": "x" * 600,
            "all_locations": "", "team_size": 2000, "launched_at": 1451606400, "stage": "",
            "tags": ["ai", "b2b"], "industries": ["ai", "devtools"], "url": ""}
    bad = dict(item, name="Str", team_size="12", launched_at=0)
    rows = scan_startups_json(payloads(spark, "startups_json", json.dumps([item, bad, {"name": ""}]),
                                       url="https://dir.example.com/tag")).orderBy("ord").collect()
    a, b = rows
    assert a.employee_count == 2000 and a.founding_year == 2016
    assert a.description == "x" * 600 and a.headquarters is None and a.funding_stage is None
    assert a.categories == ["ai", "b2b", "devtools"] and a.source_url == "https://dir.example.com/tag"
    assert b.employee_count is None and b.founding_year is None


def test_product_pricing(spark):
    items = [{"id": "o/a", "likes": 5, "cardData": None}, {"id": "o/b", "likes": 5, "cardData": {}},
             {"id": "o/c", "likes": 5, "cardData": {"license": "MIT"}},
             {"id": "o/d", "likes": 5, "cardData": {"license": "apache-2.0"}},
             {"id": "o/e", "likes": 5, "cardData": {"license": "proprietary"}},
             {"id": "o/f", "likes": 2}, {"id": "noslash", "likes": 9}]
    rows = scan_products_json(payloads(spark, "products_json", json.dumps(items))).orderBy("ord").collect()
    assert [r.pricing_type for r in rows] == ["UNKNOWN", "UNKNOWN", "FREE", "FREE", "UNKNOWN"]
    assert rows[0].categories == ["unknown", "AI"] and rows[0].company_name == "o"


def test_stars(spark):
    p = spark.createDataFrame([("https://api.github.com/repos/o/r", "gh", "repo_json", 200, '{"stargazers_count": 4200}',
                                None, None, None, 0, 0),
                               ("https://api.github.com/repos/o/s", "gh", "repo_json", 200, '{"stargazers_count": "x"}',
                                None, None, None, 0, 1)], PAYLOAD)
    assert sorted((r.repo, r.stars) for r in scan_stars_json(p).collect()) == [("r", 4200), ("s", None)]


def test_first_tag_in_document_order_wins(spark):
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="https://n/a"/>'
            '<updated>2026-08-15T11:00:00Z</updated><published>2020-01-01T00:00:00Z</published>'
            '<content>full text</content><summary>short</summary></entry>'
            '<entry><title>B</title><link href="https://n/b"/><published>2026-08-15T09:00:00Z</published>'
            '<updated>2020-01-01T00:00:00Z</updated><summary>s &amp; t</summary></entry></feed>')
    rows = scan_news_feed(payloads(spark, "news_feed", atom)).orderBy("title").collect()
    assert [r.pub_date_raw for r in rows] == ["2026-08-15T11:00:00Z", "2026-08-15T09:00:00Z"]
    assert [r.summary for r in rows] == ["full text", "s & t"]


def test_feeds_that_are_not_well_formed_lose_only_the_bad_record(spark):
    from curata.sources.payloads import rejected_feed_records, scan_jobs_feed, scan_news_feed
    def item(i, title="T", tail=""):
        return f"<item><title>{title} {i}</title><link>https://x/{i}</link><dc:date>2026-08-15T10:00:00Z</dc:date>{tail}</item>"
    bodies = {"amp": f"<rss><channel><title>R & D</title>{item(1)}{item(2, 'A & B')}</channel></rss>",
              "nbsp": f"<rss><channel>{item(3, 'non&nbsp;breaking')}{item(4)}</channel></rss>",
              "cut": f"<rss><channel>{item(5)}{item(6)}<item><title>cut",
              "bad": f"<rss><channel>{item(7)}{item(8, tail='<b></c>')}{item(9)}</channel></rss>",
              "none": "plain words", "good": f"<rss><channel>{item(10)}</channel></rss>"}
    rows = [(f"https://f/{u}", u, "k", 200, b, None, 0, 0) for u, b in bodies.items()] + [("https://f/null", "null", "k", 200, None, None, 0, 0)]
    p = spark.createDataFrame(rows, "url string, source_name string, kind string, status_code int, body string, "
                                    "error string, source_rank int, page long")
    news = {r.article_url: r for r in scan_news_feed(p, "k").collect()}
    assert sorted(news) == sorted(f"https://x/{i}" for i in (1, 2, 3, 4, 5, 6, 7, 9, 10))
    assert news["https://x/2"].title == "A & B 2" and news["https://x/3"].title == "non\u00a0breaking 3"
    assert news["https://x/5"].pub_date_raw == "2026-08-15T10:00:00Z"
    assert scan_jobs_feed(p, "k").count() == 9
    lost = sorted((r.source_name, r.reason) for r in rejected_feed_records(p, "k").collect())
    assert lost == [("bad", "malformed record"), ("cut", "cut-off record"), ("none", "no records"), ("null", "no records")]
