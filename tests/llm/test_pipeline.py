"""The pipeline's stages against brute force on their own inputs."""
from collections import Counter

import corpus_pipeline as cp
from curata.llm.decontaminate import normal

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order_on_documents(spark, documents, sf):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    a = cp.materialize(cp.quality(spark, documents, sf), "t")
    kept = {r.doc_id for r in a.collect()}
    good = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert a.columns == NAMES and sum(i in kept for i in good) >= 0.95 * len(good)
    b = cp.materialize(cp.near_duplicates(spark, a, sf), "t")
    sets = {}
    for r in a.collect():
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for k, x in enumerate(ids):
        for y in ids[:k]:
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                p, q = sorted((root(x), root(y)))
                parent[q] = p
    assert b.columns == NAMES and sorted(r.doc_id for r in b.collect()) == [i for i in ids if root(i) == i]
    c = cp.materialize(cp.decontamination(spark, b, sf), "t")
    left = {r.doc_id for r in c.collect()}
    leaking = {r.doc_id for r in b.collect() if any(p in normal(r.text) for p in items)}
    assert c.columns == NAMES and not left & leaking
    assert len(left) >= b.count() - len(leaking) - 2
    d = cp.materialize(cp.mixing(spark, c, sf), "t")
    assert d.columns == NAMES and max(Counter(r.doc_id for r in d.collect()).values()) <= 3
    e = cp.sharding(spark, d, sf).collect()
    assert sorted(r.doc_id for r in e) == sorted(r.doc_id for r in d.collect())
    sizes = Counter(r.shard for r in e)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_every_stage_takes_hostile_and_empty_tables(spark, hostile, no_rows, sf):
    for _, stage in cp.STAGES:
        assert set(hostile.columns) <= set(stage(spark, hostile, sf).columns)
        stage(spark, hostile, sf).collect()
        assert stage(spark, no_rows, sf).collect() == []


def test_one_row_of_each_group_stays(spark, hostile, sf):
    rows = cp.near_duplicates(spark, hostile, sf).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [
        (False, i) for i in range(18) if i not in (8, 10, 11)] + [(True, 0)]


def test_the_row_that_stays_of_a_repeated_id_does_not_depend_on_the_order(spark, sf):
    rows = [(i % 7, f"text {i % 20} of some words that differ {i}", "x" * (i % 3)) for i in range(60)]
    want = None
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[1])):
        df = spark.createDataFrame(order, "doc_id long, text string, hash string").repartition(1 + len(order[0][1]) % 3)
        got = sorted(tuple(r) for r in cp.near_duplicates(spark, df, sf).collect())
        assert len(got) == 7 and set(got) <= set(rows) and got == (want or got)
        want = got
