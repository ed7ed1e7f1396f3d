"""What the jobs shuffle, parse and hold at a time (the results are checked elsewhere)."""
import gc

from curata.functions import html
from curata.plans import derive
from curata.plans.tables import table
from curata.session import BATCH_BYTES
from curata.sources.payloads import scan_jobs_feed

SF = "/root/testdata/sf0.001"


def test_texts_are_not_shuffled(spark):
    for payloads, text in ((derive.job_feed_payloads, "</link>"), (derive.job_json_payloads, '"company":'),
                           (derive.atom_paper_payloads, "</entry>"), (derive.news_feed_payloads, "</link>"),
                           (derive.startup_payloads, '"name":'), (derive.product_payloads, '"id":')):
        # the lists that the aggregate collects hold columns of the table only
        plan = payloads(spark, SF)._jdf.queryExecution().analyzed()
        lines = plan.numberedTreeString().split("\n")
        at = next(i for i, line in enumerate(lines) if "Aggregate [" in line)
        assert text not in "".join(lines[at:]), payloads.__name__


def test_a_null_key_has_the_last_role(spark, tmp_path):
    spark.sql("SELECT 1L AS l_orderkey, 1 AS l_linenumber, CAST(NULL AS BIGINT) AS l_partkey, 7L AS l_suppkey, "
              "'N' AS l_returnflag, DATE'2024-01-15' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    (page,) = derive.job_feed_payloads(spark, str(tmp_path)).collect()
    assert "<title>Data Scientist at Supplier 7</title>" in page.body


def test_records_of_one_page_in_id_order_then_by_text(spark, tmp_path):
    day = "DATE'2024-01-15'"
    rows = ", ".join(f"(1L, {ln}, {part}L, {supp}L, 'N', {day})" for ln, part, supp in
                     ((3, 1, 9), (2, 1, 8), (3, 1, 7), (1, 1, 8), (2, 1, 8)))
    spark.sql(f"SELECT * FROM VALUES {rows} AS t(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate)") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    (page,) = derive.job_feed_payloads(spark, str(tmp_path)).collect()
    links = [s.split("</link>")[0] for s in page.body.split("<link>")[1:]]
    assert [x.rsplit("/", 1)[1] for x in links] == ["1", "2", "2", "3", "3"]
    assert page.body.index("Supplier 7") < page.body.index("Supplier 9")


def _feed(spark, body):
    return spark.createDataFrame([("u", "Feed", "jobs_feed", 200, body, None, 0, 0)],
                                 "url string, source_name string, kind string, status_code int, body string, "
                                 "error string, source_rank int, page long")


def _item(n, title="Role"):
    return f"<item><title>{title} {n}</title><link>http://x/{n}</link><description>d</description></item>"


def test_records_of_a_broken_feed_are_parsed_together(spark):
    broken = _feed(spark, "<rss><channel><title>R & D</title>" + "".join(_item(n, "A &amp; B & C") for n in range(40)))
    scanned = scan_jobs_feed(broken)
    assert "curata-end" in scanned._jdf.queryExecution().optimizedPlan().toString()
    got = [(r.role_title, r.job_url) for r in scanned.orderBy("ord").collect()]
    assert got == [(f"A & B & C {n}", f"http://x/{n}") for n in range(40)]


def test_one_bad_record_does_not_cost_the_others(spark):
    bad = "<item><title>Bad</b></title><link>http://x/bad</link></item>"
    for at in (0, 2, 4):
        items = [_item(n) for n in range(4)]
        items.insert(at, bad)
        rows = scan_jobs_feed(_feed(spark, "<rss><channel>" + "".join(items) + "</channel></rss>")).collect()
        assert {f"http://x/{n}" for n in range(4)} <= {r.job_url for r in rows}


def test_a_read_page_leaves_nothing_to_collect():
    gc.collect()
    gc.disable()
    try:
        assert html.main_text("<article><p>" + "Long enough. " * 30 + "</p><p>x</article>")
        assert not any(isinstance(o, html._Node) for o in gc.get_objects())
    finally:
        gc.enable()


def test_tables_are_handed_to_python_in_small_batches(spark):
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.unset(BATCH_BYTES)
    try:
        table(spark, SF, "pages")
        assert spark.conf.get(BATCH_BYTES) == "4m"
        spark.conf.set(BATCH_BYTES, "8m")
        table(spark, SF, "pages")
        assert spark.conf.get(BATCH_BYTES) == "8m"
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)
