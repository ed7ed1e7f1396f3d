"""Operator 9, quality classifier by importance resampling.

Two generative models over hashed word 1- and 2-grams (bags of ``BUCKETS`` buckets): one of
target texts (labelled good, not toxic), one of all raw texts.  A text's log importance
weight is the summed log ratio of its n-grams, and ``k`` texts are sampled without
replacement, in proportion to the weights, by adding Gumbel noise and taking the k largest
(Gumbel top-k).  Raw counts cover every document; the target side is fitted on a bounded
sample of labelled rows (``MAX_LABELLED``, smallest hashes first).
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

TOKEN = re.compile(r"\w+|[^\w\s]+")
BUCKETS = 1 << 16
MAX_LABELLED = 20_000
MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = 4096  # histogram cells of one step of the selection


def buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, one text after the other, and how many each has."""
    digest = xxhash.xxh64_intdigest
    hashes, n = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        own = [digest(w) for w in TOKEN.findall(t or "")]
        n[i] = len(own)
        hashes += own
    one = np.array(hashes, np.uint64)
    if not len(one):
        return np.zeros(0, np.int64), n
    # a bigram with the word before; a text's first word has none, so a mark stands there
    before = np.concatenate([np.zeros(1, np.uint64), one[:-1]])
    before[np.cumsum(n)[n > 0] - n[n > 0]] = 1
    two = (before * MIX + one) * MIX
    out = np.empty(2 * len(one), np.int64)
    shift = np.uint64(64 - 16)
    out[0::2] = (one * MIX) >> shift
    out[1::2] = two >> shift
    return out, 2 * n


def count_buckets(df: DataFrame) -> DataFrame:
    """(bucket, raw, target): n-gram counts over all rows and over rows with ``is_target``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, 4 << 20):
            b, n = buckets(batch.column(0).to_pylist())
            mine = np.repeat(np.array(batch.column(1).to_pylist(), bool), n)
            raw += np.bincount(b, minlength=BUCKETS)
            target += np.bincount(b[mine], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                         ["bucket", "raw", "target"])
    return df.select("text", "is_target").mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket") \
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(df: DataFrame, table: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns and the text's log importance weight."""
    shared = df.sparkSession.sparkContext.broadcast(table)
    kept = df.select(*keep, "text")
    schema = ", ".join(f"{c} {t}" for c, t in kept.dtypes if c != "text") + ", log_weight double, n_grams long"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            b, n = buckets(batch.column(len(keep)).to_pylist())
            out, some = np.zeros(len(n)), n > 0
            if some.any():
                out[some] = np.add.reduceat(shared.value[b], (np.cumsum(n) - n)[some])
            yield pa.RecordBatch.from_arrays([batch.column(j) for j in range(len(keep))]
                                             + [pa.array(out), pa.array(n)], [*keep, "log_weight", "n_grams"])
    return kept.mapInArrow(score, schema)


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column, by narrowing histograms: a few counts of at most
    ``STEP`` cells each come to the driver, never the values.  None if k < 1 or there are
    fewer rows."""
    x = F.col(column)
    low, high, n = df.agg(F.min(x), F.max(x), F.count(x)).first()
    if k < 1 or n < k:
        return None
    while low < high:
        width = (high - low) / STEP
        if width <= 0 or low + width == low:
            break
        cell = F.least(F.lit(STEP - 1), F.floor((x - F.lit(low)) / F.lit(width)))
        rows = df.filter(x.between(F.lit(low), F.lit(high))).groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(x).alias("a"), F.max(x).alias("b")).orderBy(F.desc("cell")).collect()
        above = 0
        for r in rows:
            if above + r["n"] >= k:
                k, low, high = k - above, r["a"], r["b"]
                break
            above += r["n"]
    return low


def target_sample(labels: DataFrame, id_col: str, is_target: Column, bound: int) -> DataFrame:
    """At most ``bound`` labelled ids (each once; smallest hashes first) with their verdict; a
    null verdict counts as no."""
    return (labels.filter(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("label_id")).agg(F.min(F.coalesce(is_target, F.lit(False))).alias("good"))
            .orderBy(F.xxhash64("label_id"), "label_id").limit(bound))


def resample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_id_col: str = "doc_id", is_target: Column | None = None, k: int | None = None,
             keep_targets: float = 0.995, temperature: float = 0.2, bar_share: float = 0.3, max_labelled: int = MAX_LABELLED,
             seed: str = "gumbel-1") -> DataFrame:
    """All rows with ``log_weight``, ``key`` (weight plus noise) and ``kept`` (drawn into the sample).

    ``k``: sample size.  By default as many as there are texts whose weight per n-gram is not below
    all but ``1 - keep_targets`` of the labelled target texts', so that target-like texts of any
    length are drawn; ``bar_share`` of the labelled targets are kept from the model for this.  For that the ranking uses the weight above that bar, summed over the
    text; Gumbel noise of scale ``temperature`` (1: in proportion to the weights, lower: closer
    to the k best) is a function of id and text, so a rerun draws the same sample.
    Rows with equal keys (repeated rows) stand or fall together.  Null and texts without a
    token are never drawn.  Without labelled targets there is no ratio: all texts are kept.
    Null ids are rows like any other; other columns are not read.  Empty table: no rows.
    """
    want = is_target if is_target is not None else (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    sample = materialize(target_sample(labels, label_id_col, want, max_labelled), "labelled")  # bounded: 20,000 ids
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # the bar is set by target texts that the target model has not seen
    sample = sample.withColumn("for_bar", F.pmod(F.xxhash64("label_id", F.lit("bar")), F.lit(1000)) < bar_share * 1000)
    flagged = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"), "left")
    counts = materialize(count_buckets(flagged.select("text", (F.coalesce("good", F.lit(False)) & ~F.coalesce("for_bar", F.lit(False))).alias("is_target"))),
                         "buckets").toPandas()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)  # add-one smoothing
    raw[counts.bucket] += counts.raw
    target[counts.bucket] += counts.target
    table = np.log(target / target.sum()) - np.log(raw / raw.sum())
    if not counts.target.sum():
        table[:] = 0.0
    hashed = flagged.withColumn("unit", F.sha2(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"),
                                                           F.xxhash64("text").cast("string")), 256)).select(
        "doc_id", "text", "good", "for_bar", ((F.conv(F.substring("unit", 1, 13), 16, 10).cast("double") + 0.5)
                                   / F.lit(float(1 << 52))).alias("u"))
    scored = materialize(log_ratios(hashed, table, ["doc_id", "good", "for_bar", "u"]), "weights")
    per = F.col("log_weight") / F.col("n_grams")
    bar = scored.filter(F.col("good") & (F.col("for_bar") if bar_share else F.lit(True)) & (F.col("n_grams") > 0)).agg(F.percentile(per, F.lit(1 - keep_targets))).first()[0]
    bar = 0.0 if bar is None else bar
    gumbel = F.lit(-float(temperature)) * F.log(-F.log("u"))
    keyed = scored.filter(F.col("n_grams") > 0).withColumn(
        "key", F.col("log_weight") - F.lit(float(bar)) * F.col("n_grams") + gumbel)
    if k is None:
        k = keyed.filter(per >= bar).count()
    least = kth_largest(keyed, "key", k)
    n_rows = keyed.count()
    kept = F.lit(k >= n_rows) if least is None else F.col("key") >= F.lit(least)
    none = scored.filter(F.col("n_grams") == 0)
    return keyed.select("doc_id", "log_weight", "key", kept.alias("kept")).unionAll(
        none.select("doc_id", "log_weight", F.lit(None).cast("double"), F.lit(False)))
