"""The six tabs as one version: replaced together, or not at all."""
import pytest
from pyspark.sql import functions as F

from curata.operators import sinks
from curata.operators.sinks import publish_tabs, read_export

COLS = "id string, name string, employee_count int, description string, categories array<string>, source_url string, collected_at string"
NASTY = ' leads, "quotes"\nand a new line\\ '


def startups(spark, name):
    return spark.createDataFrame([("1", name, 0, NASTY, ["a", 'b"c'], "http://x", "t"), ("2", "B", 12, None, None, "http://y", "t")], COLS)


def papers(spark):
    return spark.createDataFrame([("7", "T", "http://p")], "id string, title string, paper_url string")


def test_tabs_are_replaced_together(spark, tmp_path):
    path = f"file://{tmp_path}/export"
    assert read_export(spark, path) == {}
    publish_tabs({"Startups": startups(spark, "old"), "Research Papers": papers(spark)}, path)
    publish_tabs({"Startups": startups(spark, "new")}, path)
    tabs = read_export(spark, path)
    assert set(tabs) == {"Startups"}
    first, second = tabs["Startups"].orderBy("ID").collect()
    assert (first["Name"], first["Employee Count"], first["Description"]) == ("new", "", NASTY)
    assert first["Categories"] == '["a", "b\\"c"]'
    assert (second["Employee Count"], second["Description"], second["Categories"]) == ("12", "", "[]")


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = f"file://{tmp_path}/export"
    publish_tabs({"Startups": startups(spark, "old")}, path)
    broken = papers(spark).withColumn("title", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish_tabs({"Startups": startups(spark, "new"), "Research Papers": broken}, path)
    tabs = read_export(spark, path)
    assert set(tabs) == {"Startups"} and {r["Name"] for r in tabs["Startups"].collect()} == {"old", "B"}


def test_every_tab_has_its_headers(spark, tmp_path):
    path = f"file://{tmp_path}/export"
    empty = spark.createDataFrame([], "id string")
    publish_tabs(dict.fromkeys(sinks.TAB_COLUMNS, empty), path)
    tabs = read_export(spark, path)
    assert {t: df.columns for t, df in tabs.items()} == {t: [c[0] for c in cols] for t, cols in sinks.TAB_COLUMNS.items()}
    assert all(df.columns[0] == "ID" and df.count() == 0 for df in tabs.values()) and len(tabs) == 6
