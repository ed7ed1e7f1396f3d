import os
import tempfile

from pyspark.sql import functions as F

from curata.operators.validate import validate_entities
from curata.plans.jobs import job_export
from curata.schemas import ENTITY_SCHEMAS


def test_validation_rejects_bad_urls_and_keeps_siblings(spark):
    rows = [("https://ok.example.com", "Good", 10, 2016), ("", "No url", None, None),
            ("not_a_url", "Bad url", None, None), ("http://x", "", None, None),
            ("https://y", "Old", None, 1700), ("https://z", "Neg", -1, None)]
    df = spark.createDataFrame(rows, "source_url string, name string, employee_count int, founding_year int")
    ok, bad = validate_entities(df, "startup")
    assert [r.name for r in ok.collect()] == ["Good"]
    reasons = {r.name: r.violations for r in bad.collect()}
    assert reasons["No url"] == ["source_url_http"] and reasons["Bad url"] == ["source_url_http"]
    assert reasons[""] == ["name_required"]
    assert reasons["Old"] == ["founding_year_range"] and reasons["Neg"] == ["employee_count_nonnegative"]


def test_unknown_optional_fields_stay_null(spark):
    df = spark.createDataFrame([("https://a", "T", "https://arxiv.example.org/abs/1")],
                               "source_url string, title string, paper_url string")
    ok, bad = validate_entities(df.withColumn("github_stars", F.lit(None).cast("int")), "paper")
    r = ok.first()
    assert bad.count() == 0 and r.github_stars is None


def test_export_dry_run_and_csv(spark):
    empty = {tab: spark.createDataFrame([], ENTITY_SCHEMAS[e]) for tab, e in
             [("Startups", "startup"), ("Products", "product"), ("Research Papers", "paper"), ("Jobs", "job"),
              ("News", "news")]}
    empty["Entity Mapping Log"] = spark.createDataFrame([], "id string, raw_name string, canonical_name string, "
                                                            "match_method string, confidence double, "
                                                            "source_url string, timestamp string")
    counts = {r.tab: r.rows for r in job_export(empty).collect()}
    assert counts == {t: 0 for t in empty}
    one = {"Jobs": spark.createDataFrame([("i", "Acme", None, "Dev", "https://j", "https://s", "Remote", True,
                                           "ENGINEERING", None, "2026-08-15T10:00:00+00:00", True, "Feed", "t")],
                                         "id string, company_name string, canonical_company_name string, "
                                         "role_title string, job_url string, source_url string, location string, "
                                         "is_remote boolean, role_family string, description string, "
                                         "publication_date string, freshness_verified boolean, "
                                         "source_name string, collected_at string")}
    out = os.path.join(tempfile.mkdtemp(), "tabs")
    job_export(one, out).collect()
    back = spark.read.option("header", True).csv(os.path.join(out, "Jobs"))
    assert back.columns[0] == "ID" and back.first()["Is Remote"] == "True"
    assert back.first()["Canonical Company"] is None or back.first()["Canonical Company"] == ""
