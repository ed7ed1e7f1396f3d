"""Operator 10: targets, balance, bounds, reruns."""
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from curata.llm import mixing
from curata.llm.mixing import flight, mix, mixed_rows, targets

def words():
    return F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))


def test_targets_share_out_all_sizes():
    assert targets([("a", 100), ("b", 100), ("c", 100)]) == {"a": 187.5, "b": 75.0, "c": 37.5}
    t = targets([("a", 10), ("b", 200), (None, 100), ("d", 0)])
    assert t["a"] == 30 and t["d"] == 0 and abs(sum(t.values()) - 310) < 1e-9
    assert abs(t["b"] / t[None] - 2 / 5) < 1e-9  # the null source is last: fourth, so it weighs 5 again
    assert targets([]) == {}


def test_flight_keeps_both_totals_and_ends():
    rng = np.random.default_rng(1)
    x, p = rng.integers(1, 900, 500).astype(float), rng.random(500)
    out = flight(p, x, np.random.default_rng(2))
    assert abs(out.sum() - p.sum()) < 1e-6 and abs((out * x).sum() - (p * x).sum()) < 1e-3
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert ((out >= 0) & (out <= 1)).all()


def test_flight_keeps_expectations():
    x, p = np.array([1., 5, 2, 8, 3, 3]), np.array([.2, .5, .7, .3, .6, .9])
    mean = np.mean([flight(p, x, np.random.default_rng(s)) for s in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def check(rows, tolerance):
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.copies <= 3 and (r.size > 0 or r.copies == 0)
        by[r.source].append(r)
    for own in by.values():
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= tolerance * max(r.size for r in own) + 1e-6


def test_documents_meet_their_targets_and_reruns_agree(documents, monkeypatch):
    a = sorted(map(tuple, mix(documents, words()).collect()))
    assert a == sorted(map(tuple, mix(documents.repartition(5), words()).collect()))
    check(mix(documents, words()).collect(), 2)
    monkeypatch.setattr(mixing, "BLOCK", 8)  # several levels of blocks
    check(mix(documents, words()).collect(), 2)


def test_repeated_rows_are_one_unit(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 90 + [(2, "d", "s"), (3, "e f", "t"), (4, None, "t"), (None, "x", None)],
                               "doc_id long, text string, source string")
    out = mix(df, words()).collect()
    assert len(out) == 94
    check(out, 2)


def test_hostile_and_empty(hostile, hostile_rows, no_rows):
    out = mix(hostile, words()).collect()
    assert len(out) == len(hostile_rows)
    check(out, 2)
    assert mix(no_rows, words()).collect() == []


def test_the_mix_repeats_rows_as_decided(hostile):
    want, have = defaultdict(int), defaultdict(int)
    for r in mix(hostile, words()).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    for r in mixed_rows(hostile, words()).withColumn("size", words()).collect():
        have[r.doc_id, r.source, r.size] += 1
    assert dict(have) == {k: v for k, v in want.items() if v}
