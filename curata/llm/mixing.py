"""Operator 10, mixing sources to target weights by cube-method balanced sampling.

Each source shares 100 % of all sizes by its weight; a target stops at ``cap`` times
its source's size and the excess is shared again by weight.  A document's expected number
of copies is r = target / source size: floor(r) copies for sure and one more with inclusion
probability r - floor(r).  The fractional probabilities are balanced per source on two totals,
tokens and documents.  The flight phase moves them along the constraints' null space: any
three open units have a direction that changes neither total; a step goes as far as
one of them reaches 0 or 1, to either side with the probabilities that keep the expectation.
It runs in blocks of bounded size spread over the cluster; each block leaves at most two open
units, these are blocked again, and so on until one small landing problem per source is
left, whose last units are rounded at random.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (5, 2, 1)
CAP = 3.0
BLOCK = 2048
EPS = 1e-9


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> dict:
    """Target per source: sources by code point, null last, weighted by position."""
    order = sorted((s for s, _ in sizes if s is not None)) + [None] * any(s is None for s, _ in sizes)
    size = dict(sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(size.values())), list(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > cap * size[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = cap * size[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in full]
    return out


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Inclusion probabilities after the flight phase: all 0 or 1 but at most two; the sums of
    p and of p * x stay."""
    p = p.astype(float).copy()
    queue = [int(i) for i in np.flatnonzero((p > EPS) & (p < 1 - EPS))]
    scale = max(1.0, float(np.abs(x).max(initial=0)))
    x = x / scale
    held: list[int] = []
    draws = iter(rng.random(len(queue) + 1).tolist())
    for i in queue:
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        # null vector of the rows (1, 1, 1) and (x_a, x_b, x_c)
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        if abs(u[0]) + abs(u[1]) + abs(u[2]) < 1e-15:
            u = (1.0, -1.0, 0.0)  # equal sizes: any exchange keeps both totals
        up = min((1 - p[j]) / d if d > 0 else p[j] / -d for j, d in zip(held, u, strict=True) if abs(d) > 1e-15)
        down = min(p[j] / d if d > 0 else (1 - p[j]) / -d for j, d in zip(held, u, strict=True) if abs(d) > 1e-15)
        step = up if next(draws) * (up + down) < down else -down
        for j, d in zip(held, u, strict=True):
            p[j] = min(1.0, max(0.0, p[j] + step * d))
            if p[j] < EPS or p[j] > 1 - EPS:
                p[j] = round(p[j])
        held = [j for j in held if 0 < p[j] < 1]
    return p


def land(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rounds what the flight left (two units at most) at random."""
    open_ = (p > 0) & (p < 1)
    return np.where(open_, rng.random(len(p)) < p, p).astype(float)


def _flown(group: pd.DataFrame, last: bool) -> pd.DataFrame:
    group = group.sort_values(["u", "uid"], kind="stable").reset_index(drop=True)
    rng = np.random.default_rng(abs(int(group["u"].iloc[0])))
    p = flight(group["p"].to_numpy(), group["x"].to_numpy(float), rng)
    return group.assign(p=land(p, rng) if last else p)


def _flyer(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda group: _flown(group, last)


def _open(p: Column) -> Column:
    return (p > 0) & (p < 1)


def balance(units: DataFrame) -> DataFrame:
    """(uid, p): p of every unit moved to 0 or 1.  ``units``: uid string, source_no int, x double
    (its size), p double strictly between 0 and 1; uid is unique."""
    schema = "uid string, source_no int, x double, p double, u long, block long"
    level, done = 0, None
    state = units.withColumn("u", F.xxhash64("uid"))
    while True:
        state = materialize(state.select("uid", "source_no", "x", "p", "u"), f"units{level}")
        counts = {r["source_no"]: r["n"] for r in state.groupBy("source_no").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts:
            break
        last = max(counts.values()) <= BLOCK
        blocks = F.lit(1).cast("long")
        for s, n in counts.items():
            blocks = F.when(F.col("source_no") == s, F.lit(-(-n // BLOCK)).cast("long")).otherwise(blocks)
        dealt = state.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(level)), blocks))
        flown = materialize(dealt.groupBy("source_no", "block").applyInPandas(
            _flyer(last), schema), f"flown{level}")
        ended = flown.filter(~_open(F.col("p"))).select("uid", "p")
        done = ended if done is None else done.unionAll(ended)
        if last:
            break
        state, level = flown.filter(_open(F.col("p"))), level + 1
    return done if done is not None else units.select("uid", "p").limit(0)


def mix_units(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Per unit (doc_id, source, size) of ``rows``: m equal rows, ``whole`` copies for each and one
    more for ``plus`` of them; source_size and target of its source."""
    units = materialize(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")), "mix-units")
    sizes = [(r["source"], r["n"]) for r in units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).alias("n")).collect()]
    goal = targets(sizes, weights, cap)
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    facts = rows.sparkSession.createDataFrame(
        [(s, i, n, float(goal[s])) for i, (s, n) in enumerate(order)],
        "source_name string, source_no int, source_size long, target double")
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = units.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("source_name"))).select(
        "doc_id", "source", "size", "m", "source_no", "source_size", "target", F.floor(ratio).alias("whole"),
        (F.col("m") * (ratio - F.floor(ratio))).alias("extra"),
        F.to_json(F.struct("doc_id", "source", "size"), {"ignoreNullFields": "false"}).alias("uid"))
    known = known.withColumn("sure", F.floor(F.col("extra") + EPS)).withColumn(
        "p", F.greatest(F.lit(0.0), F.col("extra") - F.col("sure")))
    drawn = balance(known.filter((F.col("p") > EPS) & (F.col("p") < 1)).select(
        "uid", "source_no", F.col("size").cast("double").alias("x"), "p"))
    return known.drop("p").join(drawn, "uid", "left").select(
        "doc_id", "source", "size", "m", "source_size", "target", "whole",
        (F.col("sure") + F.coalesce(F.col("p"), F.lit(0.0)).cast("long")).alias("plus"))


def _rows(df: DataFrame, size: Column, id_col: str, source_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                     F.coalesce(size, F.lit(0)).cast("long").alias("size"))


def mix(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target and ``copies`` (0 .. ceil(cap)).

    Rows that agree in id, source and size are one unit: of m such rows, whole copies are
    given to as many as the expectation asks for and only the last fraction is drawn, so a row
    repeated any number of times is still one unit.  Null id, null source (the last one) and size 0
    (never drawn) are allowed.  Draws depend on the rows' values alone, not on partitions: reruns
    agree.  The number of sources must be modest (their sizes come to the driver, one number
    each).  Other columns are not read.  Empty table: no rows.
    """
    units = mix_units(_rows(df, size, id_col, source_col), weights, cap)
    # the first ``plus`` of a unit's m equal rows get one copy more
    return units.withColumn("no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") + F.when(F.col("no") <= F.col("plus"), 1).otherwise(0)).cast("long").alias("copies"))


def mixed_rows(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
               weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as :func:`mix` says, with its columns.

    Equal units (id, source, size) are told apart by the order of their row hashes."""
    units = mix_units(_rows(df, size, id_col, source_col), weights, cap).select(
        F.col("doc_id").alias("u_id"), F.col("source").alias("u_source"), F.col("size").alias("u_size"), "whole", "plus")
    sized = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
                      F.coalesce(size, F.lit(0)).cast("long").alias("n"))
    key = [F.col(f"row.`{id_col}`"), F.col(f"row.`{source_col}`"), F.col("n")]
    joined = sized.join(units, key[0].eqNullSafe(F.col("u_id")) & key[1].eqNullSafe(F.col("u_source"))
                        & (F.col("n") == F.col("u_size")))
    place = F.row_number().over(W.partitionBy(*key).orderBy(F.xxhash64("row")))
    copies = F.col("whole") + F.when(F.col("plus") >= F.col("no"), 1).otherwise(0)
    return joined.withColumn("no", place).filter(copies > 0).select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long")))).select("row.*")
