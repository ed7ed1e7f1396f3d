"""Operator 9: models, exact selection, what the sample keeps."""
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from curata.llm.importance import buckets, kth_largest, resample


def test_ngrams_per_text():
    b, n = buckets(["a b", None, "b!", "", "a b"])
    assert n.tolist() == [4, 0, 4, 0, 4] and b[:4].tolist() == b[8:].tolist()


def test_weights_are_log_ratios(spark):
    rows = [(1, "good words here"), (2, "bad junk ###"), (3, "good words")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.log_weight for r in resample(spark.createDataFrame(rows, "doc_id long, text string"), labels,
                                                    bar_share=0).collect()}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets([t])[0].tolist())
        if i != 2:
            target.update(buckets([t])[0].tolist())
    size = 1 << 16
    for i, t in rows:
        want = sum(math.log((target[b] + 1) / (size + sum(target.values()))) - math.log((raw[b] + 1) / (size + sum(raw.values())))
                   for b in buckets([t])[0].tolist())
        assert abs(got[i] - want) < 1e-9


def test_kth_largest_is_exact(spark):
    rnd = random.Random(2)
    values = [rnd.gauss(0, 1) * 10 ** rnd.randint(-6, 6) for _ in range(800)] + [1.5] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 400, 777, 850):
        assert kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "v", 851) is None and kth_largest(df, "v", 0) is None


def test_sample_size_and_gumbel_frequencies(spark):
    """Equal weights: each row is drawn in k of n seeds; a fixed k gives k rows."""
    df = spark.createDataFrame([(i, f"same{i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    drawn = Counter()
    for s in range(12):
        kept = [r.doc_id for r in resample(df, labels, k=10, seed=str(s)).filter("kept").collect()]
        assert len(kept) == 10
        drawn.update(kept)
    assert max(drawn.values()) <= 9 and len(drawn) > 30


def test_clean_documents_stay_and_junk_goes(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = resample(documents, labels).join(labels, "doc_id").collect()
    # the target is good and not toxic text
    good, bad = [r.kept for r in got if r.quality == 1 and not r.toxic], [r.kept for r in got if r.quality == 0]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.6


def test_hostile_and_empty(spark, hostile, hostile_rows, no_rows):
    labels = spark.createDataFrame([(9, 1, 0), (9, 1, 0), (12, 0, 1), (None, 1, 0), (13, None, None)],
                                   "doc_id long, quality int, toxic int")
    out = resample(hostile, labels).collect()
    assert len(out) == len(hostile_rows)
    assert not any(r.kept for r in out if r.doc_id in (0, 1, 2))
    assert len({r.kept for r in out if r.doc_id == 9}) == 1
    assert resample(no_rows, labels).collect() == []
    assert all(r.kept for r in resample(hostile, labels.filter(F.lit(False))).collect() if r.doc_id == 9)
