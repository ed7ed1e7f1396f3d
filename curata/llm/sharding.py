"""Operator 8, uniform shuffle into shards of exact size.

Law ``rows``: shard sizes differ by at most one row.  With n_i rows in input partition i
and exact shard sizes s_j, a uniform random assignment puts a multivariate
hypergeometric number of partition i's rows into shard j.  That communication matrix is
drawn first, in two levels: the driver deals the rows of groups of ``GROUP`` partitions, tasks
deal each group's share among its partitions.  Each partition then permutes its rows locally
and deals them out by its row of the matrix, the rows are exchanged, and each shard is
permuted again.  The second permutation orders (shard, random number) by range, so that one
shard is spread over many tasks, and adds each task's offset to its local numbers: gapless
slots without a task that holds a shard.
"""
from __future__ import annotations

from functools import reduce
from math import floor, log, log1p, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Numbers that may be broadcast (8 bytes each); larger tables are joined by a shuffle.
MAX_CELLS = 4_000_000
#: Partitions that one task deals rows to.
GROUP = 1024
#: Populations from here on are beyond numpy's sampler.
LARGE = 1_000_000_000
_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition above, row number below


def even(total: int, shards: int) -> np.ndarray:
    """Shard sizes that differ by one at most."""
    return np.array([total // shards + (j < total % shards) for j in range(shards)], np.int64)


def communication_matrix(rows: list[int], columns: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Exact random counts (partition x shard) with the given row and column sums."""
    left, out = columns.copy(), np.zeros((len(rows), len(columns)), np.int64)
    for i, n in enumerate(rows):
        others, open_ = int(left.sum()), n
        for j, good in enumerate(left.tolist()):  # marginal by marginal: the populations may pass 2^30
            others -= good
            out[i, j] = hypergeometric(rng, good, others, open_)
            open_ -= int(out[i, j])
        left -= out[i]
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows taken from ``good + bad`` are good; every population size."""
    if not good or not draws:
        return 0
    if not bad:
        return draws
    return int(rng.hypergeometric(good, bad, draws)) if good + bad < LARGE else _by_rejection(rng, good, bad, draws)


def _by_rejection(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Ratio of uniforms under a table mountain hat (Stadlober 1989): a proposal x is accepted
    against the true ratio of its probability to the mode's, so the law is not approximated."""
    n = good + bad
    if draws > n - draws:  # the rows left over are the smaller sample
        return good - _by_rejection(rng, good, bad, n - draws)
    share = good / n
    spread = (draws * share * (1 - share) * (n - draws) / (n - 1) + 0.5) ** 0.5
    width = 2 * (2 / np.e) ** 0.5 * spread + 3 - 2 * (3 / np.e) ** 0.5
    centre = draws * share + 0.5
    top = log_probability(((draws + 1) * (good + 1)) // (n + 2), good, bad, draws)
    if min(good, draws) == 0:
        return 0
    while True:
        u, v = 1 - rng.random(), rng.random()
        x = floor(centre + width * (v - 0.5) / u)
        if max(0, draws - bad) <= x <= min(good, draws) and \
                2 * log(u) <= log_probability(x, good, bad, draws) - top:
            return x


def log_probability(x: int, good: int, bad: int, draws: int) -> float:
    """Log of the hypergeometric probability as three binomial ones by the saddle-point form
    (Loader 2000), in which no large logarithms cancel."""
    n = good + bad
    return _log_binomial(x, good, draws, n) + _log_binomial(draws - x, bad, draws, n) - _log_binomial(draws, n, draws, n)


def _log_binomial(x: int, n: int, draws: int, of: int) -> float:
    """log P(Binomial(n, draws / of) = x)"""
    p, q = draws / of, (of - draws) / of
    if x == 0 or x == n:
        return n * (log(p) if x else log1p(-p)) if n else 0.0
    # n * p - x and n * q - (n - x), from integers: they are small against n
    gap = (n * draws - x * of) / of
    return (_tail(n) - _tail(x) - _tail(n - x) - _deviance(x, gap, n * p) - _deviance(n - x, -gap, n * q)
            + 0.5 * (log(n) - log(2 * pi) - log(x) - log(n - x)))


def _tail(n: int) -> float:
    """log n! less Stirling's formula."""
    if n < 16:
        return reduce(lambda a, k: a + log(k), range(2, n + 1), 0.0) - 0.5 * log(2 * pi * n) - n * log(n) + n
    s = 1 / (n * n)
    return (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / n


def _deviance(x: int, gap: float, mean: float) -> float:
    """x log(x / mean) + mean - x, where mean = x + gap."""
    r = gap / x
    if abs(r) > 0.1:
        return gap - x * log1p(r)
    total, power, k = 0.0, r * r, 2  # x (r - log(1 + r)) as a series
    while abs(power) > 1e-18 * abs(r * r):
        total += power / k if k % 2 == 0 else -power / k
        power, k = power * r, k + 1
        if power == 0:
            break
    return x * total


def _deal_group(key: tuple, sizes: pd.DataFrame) -> pd.DataFrame:
    """The matrix rows of one group of partitions, as running sums over the shards."""
    sizes = sizes.sort_values("part")
    rng = np.random.default_rng([int(sizes["seed"].iloc[0]), int(key[0])])
    matrix = communication_matrix(sizes["n"].tolist(), np.array(sizes["shares"].iloc[0], np.int64), rng)
    return pd.DataFrame({"part": sizes["part"].to_numpy(), "ends": list(np.cumsum(matrix, axis=1))})


def row_ends(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, ends) from (part, n): where each shard's rows end among a partition's permuted rows.

    Only one sum per ``GROUP`` partitions passes through the driver.
    """
    grouped = sizes.withColumn("grp", F.floor(F.col("part") / GROUP).cast("int"))
    totals = sorted((r["grp"], r["n"]) for r in grouped.groupBy("grp").agg(F.sum("n").alias("n")).collect())
    matrix = communication_matrix([n for _, n in totals], even(sum(n for _, n in totals), shards),
                                  np.random.default_rng(seed))
    shares = sizes.sparkSession.createDataFrame(
        [(g, row, seed) for (g, _), row in zip(totals, matrix.tolist(), strict=True)],
        "grp int, shares array<long>, seed long")
    return grouped.join(shares, "grp").groupBy("grp").applyInPandas(_deal_group, "part int, ends array<long>")


def _small(table: DataFrame, cells: int) -> DataFrame:
    return F.broadcast(table) if cells <= MAX_CELLS else table


def shuffle_into_shards(df: DataFrame, shards: int = 16, seed: int = 20240229) -> DataFrame:
    """All columns of ``df`` plus ``shard`` (0 .. shards - 1) and ``slot`` (gapless from 0 in each shard).

    Every row goes to one shard, repeated rows and null keys like any other; a column
    of ``df`` named shard or slot is replaced.  Row values play no part, so no key can
    make a shard or task large.  An empty table gives no rows.  The counts are drawn from the
    exact law at every number of rows and partitions.  ``seed`` fixes the result for a
    given partitioning of the input.
    """
    spark = df.sparkSession
    own = df.drop("shard", "slot")
    columns = own.columns
    inner = {c: f"c{i}" for i, c in enumerate(columns)}  # no clash with the working columns
    mid = F.monotonically_increasing_id()
    local = (own.select(*(F.col(f"`{c}`").alias(a) for c, a in inner.items()), F.rand(seed).alias("r1"),
                        F.rand(seed + 1).alias("r2"))
             .sortWithinPartitions("r1").withColumn("mid", mid))
    local = materialize(local.withColumns({"part": F.shiftright("mid", 33).cast("int"),
                                           "pos": F.col("mid").bitwiseAND(F.lit(_LOW))}).drop("mid", "r1"), "dealt")
    ends = materialize(row_ends(local.groupBy("part").agg(F.count(F.lit(1)).alias("n")), shards, seed), "ends")
    dealt = local.join(_small(ends, ends.count() * shards), "part").withColumn(
        "shard", F.size(F.filter("ends", lambda e: e <= F.col("pos"))))
    ordered = dealt.repartitionByRange("shard", "r2").sortWithinPartitions("shard", "r2", "part", "pos") \
        .withColumn("mid", mid)
    ordered = materialize(ordered.select(*inner.values(), "shard",
                                         F.shiftright("mid", 33).cast("int").alias("part"),
                                         F.col("mid").bitwiseAND(F.lit(_LOW)).alias("pos")), "exchanged")
    # one row per shard and task: a running sum over the tasks of a shard
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = materialize(ordered.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
                        .select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
                                .alias("shift")), "shift")
    return ordered.join(_small(shift, shift.count() * 3), ["shard", "part"]).select(
        *(F.col(a).alias(c) for c, a in inner.items()), "shard", (F.col("pos") + F.col("shift")).alias("slot"))
