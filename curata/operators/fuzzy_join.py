"""Fuzzy resolution against seed tables of any size: a lossless similarity join.

Two token-sorted strings x and y reach ratio t (percent / 100) only if
LCS >= t / 2 * (|x| + |y|).  So

* their lengths differ at most by the factor (2 - t) / t;
* of the character pairs of x at most ``lost_pairs(|x|)`` are missing in y: a character without a
  partner costs at most two pairs of its own string and one of the other.

Every string therefore sends only its rarest ``lost_pairs`` + 1 pairs (repeats numbered; rarity as
counted in the seeds): two strings that can match share one of those.  Strings too short to have
that many pairs send their characters too, as do strings short enough to match one of them.
Candidates meet on these keys, each pair is scored once with the exact ratio, and a name's best seed
is an aggregate.  Seeds are never held as a list or literal and nothing is broadcast by hint.
"""
from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions.fuzzy import best_match, ratio_sorted, sort_tokens
from ..functions.rules import normalize_name
from ..functions.strings import is_blank, py_strip
from ..session import cut_lineage
from .resolve import DEFAULT_THRESHOLD, UNRESOLVED_BLANK

#: Seeds that one pass over the unmatched names scores.
SEEDS_PER_PASS = 20_000
SLACK = 1e-9   # thresholds are doubles: the filters keep a little more than they must


def lost_share(threshold: float) -> float:
    """Pairs of a string that a partner may lack, per character of the string."""
    t = max(threshold / 100 - SLACK, SLACK)
    return max(4 * (1 - t) / (2 - t), 2 * (1 - t) / t)


def longest_ratio(threshold: float) -> float:
    """Length of the longer string of a matching pair over that of the shorter one, at most."""
    t = max(threshold / 100 - SLACK, SLACK)
    return (2 - t) / t


def lost_pairs(length: int, threshold: float) -> int:
    return math.floor(length * lost_share(threshold) + SLACK)


def _longest_with_characters(threshold: float) -> float:
    """Strings up to this length send their characters: those with too few pairs, and their partners."""
    share = lost_share(threshold)
    if share >= 1:
        return math.inf
    weak = max(n for n in range(1, math.ceil(1 / (1 - share)) + 2) if n - 1 <= lost_pairs(n, threshold))
    return weak * longest_ratio(threshold) + SLACK


@pandas_udf(T.StringType())
def sorted_tokens(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else sort_tokens(x))


@pandas_udf(T.ArrayType(T.StringType()))
def pair_keys(s: pd.Series) -> pd.Series:
    """Character pairs of a string, repeats numbered."""
    def keys(x: str) -> list[str]:
        seen: Counter = Counter()
        out = []
        for i in range(len(x) - 1):
            pair = x[i:i + 2]
            out.append(f"{pair}{seen[pair]}")
            seen[pair] += 1
        return out
    return s.map(keys)


@pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio_sorted(x, y) for x, y in zip(a, b)], dtype=float)


def _keys(strings: DataFrame, frequency: DataFrame, threshold: float) -> DataFrame:
    """(q, key): what each distinct string ``q`` sends."""
    all_pairs = strings.select("q", F.explode(pair_keys("q")).alias("key")).join(frequency, "key", "left")
    f = F.coalesce("f", F.lit(0))
    sent = F.floor(F.length("q") * F.lit(lost_share(threshold)) + SLACK).cast("int") + 1
    pairs = all_pairs.groupBy("q").agg(F.sort_array(F.collect_list(F.struct(f.alias("f"), "key"))).alias("ks")) \
        .select("q", F.explode(F.slice("ks", F.lit(1), sent)).alias("k")).filter(F.col("k.f") > 0).select("q", "k.key")
    limit = _longest_with_characters(threshold)
    short = strings if math.isinf(limit) else strings.filter(F.length("q") <= limit)
    # a pair key has three characters or more
    return pairs.unionAll(short.select("q", F.explode(F.array_distinct(F.split("q", ""))).alias("key")))


def _prepared(seeds: DataFrame) -> DataFrame:
    """(c, seed_pos, seed): distinct sorted forms; the first seed of equal forms stands for them."""
    return seeds.select(sorted_tokens("seed").alias("c"), "seed_pos", "seed").filter(F.col("c") != "") \
        .groupBy("c").agg(F.min("seed_pos").alias("seed_pos"), F.min_by("seed", "seed_pos").alias("seed"))


def fuzzy_matches(names: DataFrame, seeds: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(q, seed, score): for every distinct sorted name ``q`` of ``names`` the best seed of ``seeds``
    (seed_pos, seed) that reaches ``threshold`` (over 0), the first in list order of equally good
    ones.  Names without one have no row."""
    form = _prepared(seeds)
    strings = names.select("q").filter(F.col("q") != "").distinct()
    frequency = form.select(F.explode(pair_keys("c")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("f"))
    left = _keys(strings, frequency, threshold).distinct()
    right = _keys(form.select(F.col("c").alias("q")), frequency, threshold).distinct().withColumnRenamed("q", "c")
    long, short = F.greatest(F.length("q"), F.length("c")), F.least(F.length("q"), F.length("c"))
    candidates = left.join(right, "key").filter(long <= short * F.lit(longest_ratio(threshold)) + SLACK) \
        .select("q", "c").distinct()
    scored = candidates.withColumn("score", ratio("q", "c")).filter(F.col("score") >= float(threshold))
    return scored.join(form, "c").groupBy("q").agg(
        F.max("score").alias("score"), F.min_by("seed", F.struct(-F.col("score"), "seed_pos")).alias("seed"))


def best_scores(names: DataFrame, seeds: DataFrame, per_pass: int = SEEDS_PER_PASS) -> DataFrame:
    """(q, score): the best ratio of every distinct ``q`` over all seeds, however low.

    No key can narrow a search without a threshold: each pass scores all names against a block of
    ``per_pass`` seeds, and the driver holds one block at a time."""
    strings = cut_lineage(names.select("q").distinct())
    out, block = None, []

    def scored(prepared: list[str]) -> DataFrame:
        def run(frames):
            for frame in frames:
                best = [best_match(q, prepared)[1] for q in frame["q"]]
                yield pd.DataFrame({"q": frame["q"], "score": best})
        return strings.mapInPandas(run, "q string, score double")
    for row in seeds.select(sorted_tokens("seed").alias("c")).distinct().toLocalIterator():
        block.append(row["c"])
        if len(block) == per_pass:
            out, block = scored(block) if out is None else out.unionAll(scored(block)), []
    if block or out is None:
        out = scored(block) if out is None else out.unionAll(scored(block))
    return out.groupBy("q").agg(F.greatest(F.max("score"), F.lit(0.0)).alias("score"))


def resolve_with_tables(df: DataFrame, name: str, seeds: DataFrame, aliases: DataFrame | None = None,
                        threshold: float = DEFAULT_THRESHOLD, score_unresolved: bool = True) -> DataFrame:
    """``df`` with canonical_name, match_method and confidence, resolved against the tables ``seeds``
    (seed_pos, seed) and ``aliases`` (alias, canonical): exact normal form, then alias, then fuzzy.

    Each distinct name is resolved once.  Equal normal forms: the later seed wins; equal fuzzy
    scores: the earlier.  The confidence of an unresolved name is its best score over all seeds,
    which costs names times seeds for those names; with ``score_unresolved`` off it is 0.
    Null and blank names are ``Unresolved`` by method NONE.
    """
    for c in ("canonical_name", "match_method", "confidence"):
        if c in df.columns:
            raise ValueError(f"column {c} already present")
    norms = seeds.withColumn("_norm", normalize_name("seed")).groupBy("_norm").agg(F.max_by("seed", "seed_pos").alias("_exact"))
    d = df.select(F.col(name).alias("_name")).distinct().withColumns(
        {"_norm": normalize_name("_name"), "_blank": is_blank("_name"), "q": sorted_tokens("_name")})
    d = d.join(norms, "_norm", "left")
    if aliases is not None:
        known = aliases.groupBy(F.col("alias").alias("_norm")).agg(F.min("canonical").alias("_alias"))
        d = d.join(known, "_norm", "left")
    else:
        d = d.withColumn("_alias", F.lit(None).cast("string"))
    d = cut_lineage(d.drop("_norm"))
    todo = d.filter(~F.col("_blank") & F.col("_exact").isNull() & F.col("_alias").isNull()).select("q").distinct()
    best = fuzzy_matches(todo, seeds, threshold)
    if score_unresolved:
        best = cut_lineage(best)
        rest = best_scores(todo.join(best, "q", "left_anti"), seeds)
        best = best.unionByName(rest.withColumn("seed", F.lit(None).cast("string")))
    known = F.coalesce("_exact", "_alias")
    # a sorted form may stand for names of every method: only names without a lookup take its score
    r = d.join(best, "q", "left").select(
        "_name",
        F.when(F.col("_blank"), UNRESOLVED_BLANK).otherwise(F.coalesce(known, "seed", py_strip("_name"))).alias("canonical_name"),
        _method().alias("match_method"),
        F.when(F.col("_blank"), 0.0).when(known.isNotNull(), 100.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("confidence"))
    return df.join(r, df[name].eqNullSafe(r["_name"]), "left").drop("_name")


def _method() -> Column:
    return (F.when(F.col("_blank"), "NONE").when(F.col("_exact").isNotNull(), "EXACT")
            .when(F.col("_alias").isNotNull(), "ALIAS").when(F.col("seed").isNotNull(), "FUZZY").otherwise("UNRESOLVED"))
