"""Operator 8: exact sizes, gapless slots, nothing lost, uniform."""
from collections import Counter

from math import comb, log

import numpy as np

from curata.llm import sharding
from curata.llm.sharding import communication_matrix, even, log_probability, row_ends, shuffle_into_shards


def check(rows, n, shards):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == n and set(sizes) <= set(range(shards))
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_matrix_is_exact_and_hypergeometric():
    m = communication_matrix([5, 0, 17, 100], even(122, 7), np.random.default_rng(1))
    assert m.sum(axis=1).tolist() == [5, 0, 17, 100]
    assert sorted(m.sum(axis=0).tolist()) == [17] * 4 + [18] * 3
    # first cell: hypergeometric mean and variance over many draws
    cells = np.array([communication_matrix([40, 60], even(100, 4), np.random.default_rng(s))[0, 0] for s in range(2000)])
    assert abs(cells.mean() - 10) < 0.25 and abs(cells.var() - 40 * .25 * .75 * 60 / 99) < 0.6


def test_documents(documents):
    for parts, shards in ((1, 16), (7, 16), (3, 1)):
        out = shuffle_into_shards(documents.repartition(parts), shards).collect()
        check(out, documents.count(), shards)
        assert {r.doc_id for r in out} == {r.doc_id for r in documents.select("doc_id").collect()}


def test_every_row_may_land_everywhere(spark):
    """Chi-square of input third against shard, and of input order against slot."""
    df = spark.range(0, 6000, 1, 6)
    table, late = np.zeros((6, 4)), 0
    for r in shuffle_into_shards(df, 4, seed=9).collect():
        table[r.id // 1000, r.shard] += 1
        late += (r.id >= 3000) == (r.slot >= 750)
    assert ((table - 250) ** 2 / 250).sum() < 40  # 15 degrees of freedom
    assert abs(late / 6000 - 0.5) < 0.03


def test_seed_decides(spark):
    df = spark.range(0, 500, 1, 3)
    a, b, c = (sorted(map(tuple, shuffle_into_shards(df, 5, s).collect())) for s in (1, 1, 2))
    assert a == b != c


def test_hostile_and_empty(hostile, hostile_rows, no_rows):
    clash = hostile.withColumnsRenamed({"h": "pos", "words": "part", "kept": "slot"})
    out = shuffle_into_shards(clash, 5)
    assert {"pos", "part", "shard", "slot", "text"} <= set(out.columns)
    check(out.collect(), len(hostile_rows), 5)
    assert shuffle_into_shards(no_rows, 16).collect() == []


def test_log_probability_is_exact():
    for good, bad, draws in ((5, 9, 6), (40, 60, 30), (300, 2000, 1100), (5000, 100, 77), (1, 1, 1), (70000, 30000, 50000)):
        low, high = max(0, draws - bad), min(good, draws)
        for x in {low, high, *np.linspace(low, high, 9).astype(int).tolist()}:
            want = log(comb(good, x)) + log(comb(bad, draws - x)) - log(comb(good + bad, draws))
            assert abs(log_probability(x, good, bad, draws) - want) < 1e-8 * max(1, abs(want))


def test_rejection_sampler_has_the_exact_law():
    """Chi-square against the true probabilities, skewed, small and more than half drawn."""
    rng = np.random.default_rng(5)
    for good, bad, draws in ((12, 20, 9), (30, 4, 20), (3, 5000, 400), (40, 60, 77)):
        seen = Counter(sharding._by_rejection(rng, good, bad, draws) for _ in range(20000))
        cells = [(seen[x], 20000 * comb(good, x) * comb(bad, draws - x) / comb(good + bad, draws))
                 for x in range(max(0, draws - bad), min(good, draws) + 1)]
        big = [c for c in cells if c[1] >= 5]
        assert sum(n for n, _ in cells) == 20000
        assert sum((n - e) ** 2 / e for n, e in big) < 3 * len(big) + 12


def test_populations_beyond_numpy():
    rng = np.random.default_rng(3)
    good, bad, draws = 6 * 10**12, 94 * 10**12, 2 * 10**9
    x = np.array([sharding.hypergeometric(rng, good, bad, draws) for _ in range(2000)], float)
    sd = (draws * .06 * .94) ** 0.5
    assert abs(x.mean() - draws * .06) < 5 * sd / 2000 ** 0.5 and abs(x.std() / sd - 1) < 0.08
    m = communication_matrix([10**12, 3 * 10**12], even(4 * 10**12, 16), rng)
    assert m.sum(axis=1).tolist() == [10**12, 3 * 10**12] and set(m.sum(axis=0)) == {25 * 10**10}


def test_many_partitions_in_groups(spark):
    """5,000 partitions of unequal size: exact sums, without a cap on cells."""
    sizes = spark.range(5000).selectExpr("cast(id as int) part", "id % 7 n")
    rows = {r.part: list(r.ends) for r in row_ends(sizes, 16, 1).collect()}
    assert all(rows[p][-1] == p % 7 for p in range(5000))
    columns = np.diff(np.array([rows[p] for p in range(5000)]), axis=1, prepend=0).sum(axis=0)
    assert columns.tolist() == even(sum(p % 7 for p in range(5000)), 16).tolist()


def test_tables_too_large_to_broadcast(documents, monkeypatch):
    want = sorted(tuple(r) for r in shuffle_into_shards(documents.select("doc_id").repartition(5), 16).collect())
    monkeypatch.setattr(sharding, "MAX_CELLS", 0)
    got = shuffle_into_shards(documents.select("doc_id").repartition(5), 16).collect()
    check(got, len(want), 16)
    assert {r.doc_id for r in got} == {w[0] for w in want}
