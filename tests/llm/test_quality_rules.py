"""Operator 1 against a plain recomputation of every count, and its estimates on planted rules."""
import itertools
import os
import re
from collections import Counter

import pytest

from curata.llm.quality_rules import expectation_maximisation, posterior, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for p in places for j in (p, p + 1, p + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered))


def counts(df):
    return Counter((r[0], *r[1:6], r.base_failed) for r in df.collect())


def expected(rows):
    out = Counter()
    for r in rows:
        b = brute(r[1])
        out[(r[0], *b, b[0] < 50 or 100 * b[4] > 50 * b[0])] += 1
    return out


def test_counts_on_hostile_rows(hostile, hostile_rows):
    got = quality_rules(hostile)
    assert counts(got) == expected(hostile_rows)
    assert all(not (r.kept and r.base_failed) for r in got.collect())


def test_counts_on_documents(documents, document_rows):
    assert counts(quality_rules(documents)) == expected(document_rows)


def test_clean_documents_are_kept_and_junk_is_not(spark, documents, sf):
    got = quality_rules(documents).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)


def test_posterior_rejects_junk_that_passes_the_base(spark):
    """All labelled rows at sf0.1: at least 97 % of the good and at most 10 % of the bad are kept."""
    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    rows = quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).filter("not base_failed") \
        .join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert len(good) > 1000 and len(bad) > 100
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_no_rows(no_rows):
    df = quality_rules(no_rows)
    assert df.collect() == [] and "kept" in df.columns


def test_accuracies_are_recovered(spark):
    """1,000 good and 250 bad rows; rules right 90, 80 and 70 times in 100, independently."""
    acc, rows = {"a": 0.9, "b": 0.8, "c": 0.7}, {}
    for truth, n in ((1, 100000), (-1, 25000)):
        for a in (1, -1):
            for b in (1, -1):
                for c in (1, -1):
                    p = 1.0
                    for k, v in zip("abc", (a, b, c), strict=True):
                        p *= acc[k] if v == truth else 1 - acc[k]
                    rows[(a, b, c)] = rows.get((a, b, c), 0) + n * p
    patterns = spark.createDataFrame([(*k, float(v)) for k, v in rows.items()], "a int, b int, c int, n double").coalesce(1)
    fit = expectation_maximisation(patterns, list("abc"), iterations=60)
    assert abs(fit.share - 0.8) < 0.05
    for k in "abc":
        assert abs(fit.right_on_good[k] - acc[k]) < 0.05 and abs(fit.right_on_bad[k] - acc[k]) < 0.1


def planted(spark, sizes, laws, names):
    """Exact expected counts of vote patterns: ``laws``: one function (truth -> {votes: probability}) per family."""
    rows = {}
    for truth, n in sizes:
        for parts in itertools.product(*(law(truth).items() for law in laws)):
            p, key = 1.0, ()
            for votes, q in parts:
                p, key = p * q, key + votes
            rows[key] = rows.get(key, 0.0) + n * p
    return spark.createDataFrame([(*k, float(v)) for k, v in rows.items()],
                                 ", ".join(f"{c} int" for c in names) + ", n double").coalesce(1)


def right(acc):
    return lambda truth: {(truth,): acc, (-truth,): 1 - acc}


def test_copies_of_a_rule_count_once(spark):
    """Three rules that always say the same (right 6 in 10) against three independent good ones."""
    def same(truth):
        return {(truth,) * 3: 0.6, (-truth,) * 3: 0.4}
    patterns = planted(spark, ((1, 80000), (-1, 20000)), [same, right(0.9), right(0.9), right(0.85)], "xyzabc")
    fit = expectation_maximisation(patterns, {"copies": ("x", "y", "z"), "a": ("a",), "b": ("b",), "c": ("c",)},
                                   iterations=100)
    assert abs(fit.share - 0.8) < 0.05
    for k, acc in (("x", 0.6), ("y", 0.6), ("a", 0.9), ("b", 0.9), ("c", 0.85)):
        assert abs(fit.right_on_good[k] - acc) < 0.05 and abs(fit.right_on_bad[k] - acc) < 0.1
    row = spark.createDataFrame([(-1, -1, -1, 1, 1, 1), (1, 1, 1, -1, -1, -1)], "x int, y int, z int, a int, b int, c int")
    p = [r[0] for r in row.select(posterior(fit)).collect()]
    assert p[0] > 0.9 and p[1] < 0.1


def test_one_rule_alone_makes_no_class(spark):
    """All texts alike but for one rule's noise: the start values stand, most votes decide."""
    patterns = planted(spark, ((1, 10000),), [right(0.9), right(1.0), right(1.0)], "abc").filter("n > 0")
    fit = expectation_maximisation(patterns, list("abc"))
    row = spark.createDataFrame([(-1, 1, 1)], "a int, b int, c int")
    assert fit.share == 0.5 and row.select(posterior(fit)).first()[0] > 0.5
