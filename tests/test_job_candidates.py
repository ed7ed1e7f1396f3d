"""Job rows are dated first: only fresh records are worked out, and what they become does not change."""
import json

from pyspark.sql import functions as F

from curata.functions.dates import with_freshness
from curata.operators.store import read_store
from curata.plans.jobs import job_candidates, job_jobs
from curata.schemas import PAYLOAD
from curata.sources.payloads import scan_jobs_feed, scan_jobs_json
from curata.streaming.streams import stream_jobs

REF = "2026-08-15 12:00:00"
FRESH, STALE = "2026-08-15T10:00:00Z", "2020-01-01T00:00:00Z"


def _item(n, date=FRESH, title=None, tail=""):
    title = f"Backend Developer at Acme {n}" if title is None else title
    return f"<item><title>{title}</title><link> https://j/{n} </link><pubDate> {date} </pubDate>{tail}</item>"


FEEDS = [
    "<rss><channel>" + _item(1) + _item(2, STALE) + _item(3, title="Acme: Product Manager") + _item(4, title=" ") + "</channel></rss>",
    # broken feeds, and records with several candidate tags
    "<rss><channel><title>R & D</title>" + _item(5, title="A &amp; B & C") + _item(6, STALE) + "<item><title>cut",
    "<rss><channel>" + _item(7, tail=f"<updated>{STALE}</updated><summary>llm</summary><description>second</description>")
    + _item(8, "soon") + _item(9, "") + _item(1) + "</channel></rss>",
    f'<feed><entry><title>Sales</title><link href="https://j/10"/><updated>2 hrs ago</updated></entry>'
    f'<entry><title>No link</title><updated>{FRESH}</updated></entry></feed>', "no xml", None]
JSONS = [
    json.dumps([{"company": "Acme", "position": "Data Scientist", "url": "https://j/a", "date": FRESH, "description": "pm"},
                {"company": "", "position": "x", "url": "https://j/b", "date": FRESH},
                {"company": "Acme", "title": "Old", "apply_url": "https://j/c", "publication_date": STALE},
                {"company": "Acme", "position": "", "title": "Lead", "apply_url": "https://j/d", "publication_date": FRESH,
                 "location": "Berlin"}, {"company": "Acme", "position": "Undated", "url": "https://j/e"}, "text"]),
    json.dumps({"jobs": [{"company": 7, "position": "Clerk", "url": "https://j/f", "date": FRESH}]}), "{", None]


def _payloads(spark, kind, bodies):
    rows = [(f"https://s/{kind}?{i}", "Source", kind, 200, b, None, None, None, 0, i) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, PAYLOAD)


def _rows(df):
    return sorted(repr(r.asDict(recursive=True)) for r in df.select(*sorted(df.columns)).collect())


def test_scans_that_are_dated_give_the_rows_of_plain_scans(spark):
    def dated(records):
        return with_freshness(records, "pub_date_raw", REF, 24.0, out="fresh")
    for scan, p in ((lambda p, **k: scan_jobs_feed(p, html_text=False, **k), _payloads(spark, "jobs_feed", FEEDS)),
                    (scan_jobs_json, _payloads(spark, "jobs_json", JSONS))):
        whole = _rows(dated(scan(p)))
        assert whole and _rows(scan(p, dated=dated)) == whole


def test_counters_see_stale_and_rejected_rows(spark):
    stages = {}
    rows = job_candidates(_payloads(spark, "jobs_json", JSONS), _payloads(spark, "jobs_feed", FEEDS), REF, stages=stages)
    assert sorted(r.job_url for r in stages["stale"].collect()) == ["https://j/2", "https://j/6", "https://j/c"]
    urls = sorted(r.job_url for r in rows.collect())
    assert urls == sorted(f"https://j/{x}" for x in (1, 1, 3, 5, 7, 10, "a", "d", "f"))
    assert stages["discovered"].count() == len(urls) and stages["rejected"].count() == 0


def test_only_fresh_records_are_worked_out(spark):
    jobs = job_jobs(_payloads(spark, "jobs_json", JSONS), _payloads(spark, "jobs_feed", FEEDS), REF)
    plan = jobs._jdf.queryExecution().optimizedPlan().toString()
    # a verdict filter for each kind, with nothing of title, role and rules beneath it
    parts = plan.split("Filter fresh")[1:]
    assert len(parts) == 2
    for part in parts:
        beneath = part.split("+- Project [struct(source_rank")[0]
        assert "instr(" not in beneath and "machine learning" not in beneath and "$.company" not in beneath
    # and the rules read worked-out columns above it
    for line in plan.splitlines():
        if "Filter" in line and "company_required" in line:
            assert "instr(" not in line and "try_variant_get" not in line


def test_stream_stores_what_the_batch_job_finds(spark, tmp_path):
    base = str(tmp_path)
    feed, api = _payloads(spark, "jobs_feed", FEEDS), _payloads(spark, "jobs_json", JSONS)
    for part in (feed.filter("page < 2"), feed.filter("page >= 1").unionByName(api)):   # page 1 lands twice
        part.write.mode("append").parquet(f"{base}/payloads")
        stream_jobs(spark, f"{base}/payloads", f"{base}/store", f"{base}/checkpoint", REF, collected_at="now").awaitTermination()
    cols = ["job_url", "company_name", "role_title", "role_family", "description", "location", "canonical_company_name",
            F.unix_micros("published_at").alias("at"), "dedup_key", "id"]
    batch = job_jobs(api, feed, REF, collected_at="now")
    assert _rows(read_store(spark, f"{base}/store").select(*cols)) == _rows(batch.select(*cols))


def test_repair_numbers_every_entity_and_nothing_else(spark):
    from curata.sources.payloads import HTML_ENTITIES, repair_xml
    texts = {**{f"a&{name};b": f"a&#{code};b" for name, code in HTML_ENTITIES.items()}, "&nbsp;&copy;&nbsp;": "&#160;&#169;&#160;",
             "a & b &amp; &#7; &NBSP; &nbsp": "a &amp; b &amp; &#7; &amp;NBSP; &amp;nbsp", "a\x01b": "ab", "": "", None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.fixed for r in df.select("t", repair_xml(F.col("t")).alias("fixed")).collect()} == texts


def test_job_pages_keep_their_text(spark, tmp_path):
    from curata.plans.derive import job_json_payloads
    spark.sql("SELECT * FROM VALUES (1L, 60L, TIMESTAMP'2024-01-15 00:00:00'), (2L, NULL, NULL), (26L, 3L, TIMESTAMP'2024-01-16 00:00:00') "
              "AS t(o_orderkey, o_custkey, o_orderdate)").write.parquet(f"{tmp_path}/orders.parquet")
    payloads = job_json_payloads(spark, str(tmp_path))
    # url and apply_url are rendered once each
    assert payloads._jdf.queryExecution().optimizedPlan().toString().count("https://jobs.example.com/o/") == 2
    pages = {r.page: json.loads(r.body) for r in payloads.collect()}
    assert pages[0] == [
        {"company": "STABILITY AI, Inc.", "title": "AI Researcher", "url": "https://jobs.example.com/o/1", "date": "2024-01-15T00:00:00Z",
         "location": "", "description": "Fulfillment team"},
        {"position": "Backend Developer", "apply_url": "https://jobs.example.com/o/2"}]
    assert pages[3]["jobs"] == [{"company": "", "position": "Backend Developer", "apply_url": "https://jobs.example.com/o/26",
                                 "date": "2024-01-16T00:00:00Z"}]
