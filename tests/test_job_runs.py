"""Jobs as runs: what a store and provider tiers do to rows, calls and counters."""
import os

import pytest
from pyspark.sql import functions as F

from curata.plans.derive import product_payloads
from curata.plans.jobs import job_metrics, job_products
from curata.plans.q_jobs import _listing, q_run_metrics_products
from curata.plans.tables import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_provider_counters_are_real(spark):
    m = q_run_metrics_products(spark, SF).first().asDict()
    assert m["gemini_429s"] > 0 and m["llm_fallbacks"] > 0 and m["llm_extractions_attempted"] > m["llm_fallbacks"]
    assert m["records_processed"] == m["deterministic_extractions"] + m["llm_extractions_attempted"]


def test_stored_rows_are_not_sent_to_a_provider(spark):
    readmes = _listing(table(spark, SF, "part")).select(
        "listing_id", F.concat(F.lit("Readme of "), "listing_id", F.lit(" " + "long " * 20)).alias("readme"))
    first, again = {}, {}
    new = job_products(product_payloads(spark, SF), readmes, None, [lambda prompt, entity: "{}"], stages=first)
    asked = first["extractions"].count()
    assert asked > 0
    store = new.select("dedup_key")
    rest = job_products(product_payloads(spark, SF), readmes, store, [lambda prompt, entity: "{}"], stages=again)
    assert again["extractions"].count() == 0 and rest.count() == 0
    m = job_metrics({"product": rest}, {"product": again}).first()
    # every listing is stored: none is new, and none of them counts as a repeat within the run
    assert m.records_processed == 0 and m.duplicates == m.records_discovered - new.count()
