"""The curated store: batches, repeats, half-written attempts and a second writer."""
import pytest
from pyspark.sql import functions as F

from curata.operators import store as st
from curata.operators.store import commit_batch, commits, read_store, remove_abandoned


def rows(spark, keys, tag):
    return spark.createDataFrame([(f"k{k}", i, tag, "d") for i, k in enumerate(keys)], "dedup_key string, ord long, tag string, day string")


def stored(spark, path):
    return sorted((r.dedup_key, r.tag) for r in read_store(spark, path).select("dedup_key", "tag").collect())


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/store"


def test_repeated_and_overlapping_batches(spark, path):
    assert read_store(spark, path) is None and commits(spark, path).count() == 0
    assert commit_batch(rows(spark, [1, 2, 2, 3], "a"), path, "a") == 3
    assert commit_batch(rows(spark, [1, 2, 2, 3, 9], "again"), path, "a") == 0
    assert commit_batch(rows(spark, [3, 4], "b"), path, "b") == 1
    assert commit_batch(rows(spark, [1, 4], "c"), path, "c") == 0
    assert commit_batch(rows(spark, [], "d"), path, "d", partition_by=["day"]) == 0
    assert stored(spark, path) == [("k1", "a"), ("k2", "a"), ("k3", "a"), ("k4", "b")]
    assert [(r.version, r.batch_id, r["keys"]) for r in commits(spark, path).orderBy("version").collect()] == [
        (0, "a", 3), (1, "b", 1), (2, "c", 0), (3, "d", 0)]


def test_first_row_of_a_key_is_stored(spark, path):
    df = rows(spark, [1, 1, 1], "x").withColumn("tag", F.col("ord").cast("string")).repartition(3)
    assert commit_batch(df, path, "a", partition_by=["day"]) == 1 and stored(spark, path) == [("k1", "0")]


def test_half_written_batch_is_not_there_and_can_be_written_again(spark, path, monkeypatch):
    assert commit_batch(rows(spark, [1], "a"), path, "a") == 1

    def dies(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(st, "_claim", dies)
        with pytest.raises(RuntimeError):
            commit_batch(rows(spark, [1, 2], "lost"), path, "b")
    assert stored(spark, path) == [("k1", "a")]
    assert commit_batch(rows(spark, [1, 2], "b"), path, "b") == 1
    assert stored(spark, path) == [("k1", "a"), ("k2", "b")]
    assert remove_abandoned(spark, path) == 0 and remove_abandoned(spark, path, older_than_s=-60) == 1
    assert stored(spark, path) == [("k1", "a"), ("k2", "b")]


@pytest.mark.parametrize("other,keys,mine,total", [
    ("w2", [2, 3], 1, [("k1", "mine"), ("k2", "other"), ("k3", "other")]),   # one key taken meanwhile
    ("w2", [1, 2], 0, [("k1", "other"), ("k2", "other")]),                   # all taken
    ("w2", [7], 2, [("k1", "mine"), ("k2", "mine"), ("k7", "other")]),       # none taken
    ("w2", [], 2, [("k1", "mine"), ("k2", "mine")]),                         # an empty batch came first
    ("w1", [1, 2], 0, [("k1", "other"), ("k2", "other")]),                   # the same batch, twice at once
])
def test_a_second_writer_between_read_and_commit(spark, path, monkeypatch, other, keys, mine, total):
    claim, calls = st._claim, []

    def late(spark_, store, record):
        if not calls:
            calls.append(1)
            assert commit_batch(rows(spark, keys, "other"), path, other) == len(keys)
        return claim(spark_, store, record)
    monkeypatch.setattr(st, "_claim", late)
    assert commit_batch(rows(spark, [1, 2], "mine"), path, "w1") == mine
    assert stored(spark, path) == total
    found = read_store(spark, path)
    assert found.count() == found.select("dedup_key").distinct().count()
