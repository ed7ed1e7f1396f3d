"""Operator 5, n-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are the distinct shingle sets, columns the shingles (48-bit
hashes, in one global order), and the entries of M * M^T are the overlaps.  For a
threshold t only a part of the product is ever formed:

* equal sets are one row (their class is linked whatever else happens);
* column block 1 is the lowest part of the hash space, half as large again as the share of its
  entries that a link may lack.  A row whose entries there include more single-row columns than
  that is discarded.  A column is of a single row if the least and the largest row number in it are
  one, so the entries are exchanged once, pre-aggregated, and never joined;
* for the rows left all columns are counted.  Single-row columns drop out, rows are discarded
  by the same bound again, and the others keep a prefix: the n - ceil(t n) + 1 rarest entries
  (columns by row count), of which two linked rows share at least one;
* each column first contributes one star, its most central row with every other one.
  Verified star links already join whole groups of copies;
* then a column contributes products only between rows of different components whose sizes,
  single-row entries and parities leave room for a link: the symmetric difference holds both
  rows' single entries, and in each of 256 bins of the other columns where one row has an odd
  and the other an even number of entries, one more.  Overlap counts are accumulated per pair,
  and a pair is discarded when its count plus what lies beyond the shorter prefix stays below
  ceil(t / (1 + t) * (n + m));
* the pairs left are verified on their whole sets, and components are closed.

So a group of copies costs a star, not its square, and no link between different texts is lost.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove, slices

TOP = 1 << 48
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the fixed-size row filter that spares unaffected texts the second reading.
FILTER_BITS = 1 << 25
#: Four 64-bit words of column parities per row.
PARITY = ["p0", "p1", "p2", "p3"]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of an ASCII-lower-cased
    text; fewer words: the whole sequence as one; no words: none."""
    digest = xxhash.xxh64_intdigest
    # bytes.lower and bytes.split know ASCII only, which is what is asked for
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([digest(w) for w in words], np.uint64)
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        out = (out ^ h[j:len(h) - n + 1 + j]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def least_overlap(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """ceil(t * n)"""
    return -(-percent * n // 100)


def _block(percent: int) -> int:
    """Upper edge of column block 1: rows that share nothing must have more entries below it than a
    link may lack, (100 - ``percent``) % of all, by a clear margin."""
    return TOP * min(100, 3 * (100 - percent) // 2 + 1) // 100


def _sets(df: DataFrame, width: int) -> DataFrame:
    """doc_id, n, and digest of the set (null if empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n", "digest"])
    kind = dict(df.dtypes)["doc_id"]
    return df.mapInArrow(run, f"doc_id {kind}, n long, digest binary")


def _low(df: DataFrame, bits: np.ndarray, width: int, percent: int) -> DataFrame:
    """(doc_id, h): the entries in column block 1 of the texts whose id the filter lets through."""
    shared, edge = df.sparkSession.sparkContext.broadcast(bits), _block(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            batch = _chosen(batch, shared.value)
            sets = [np.unique(shingle_set(t, width) >> np.uint64(16)).view(np.int64) for t in batch.column(1).to_pylist()]
            low = [s[:np.searchsorted(s, edge)] for s in sets]
            at = np.repeat(np.arange(len(low)), [len(x) for x in low])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.concatenate([*low, np.zeros(0, np.int64)]))], ["doc_id", "h"])
    return df.select("doc_id", "text", _slot(F.col("doc_id")).alias("slot")).mapInArrow(
        run, f"doc_id {dict(df.dtypes)['doc_id']}, h long")


def up(value: Column, by: int) -> Column:
    """ceil(value / by) of integers, exactly."""
    return ((value + (by - 1) - F.pmod(value + (by - 1), F.lit(by))) / by).cast("long")


def _row_filter(ids: DataFrame) -> np.ndarray:
    """Bitmap of the hashes of the ids, of fixed size; false positives only cost a reading."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], ["bits"])
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in ids.select(_slot(F.col("doc_id"))).coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        bits |= np.frombuffer(r["bits"], np.uint8)
    return bits


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS)).cast("long")


def _chosen(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """The rows (doc_id, text, slot) that the filter lets through."""
    at = batch.column(2).to_numpy(zero_copy_only=False)
    return batch.take(pa.array(np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)))


def _whole_sets(df: DataFrame, bits: np.ndarray, width: int) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            batch = _chosen(batch, shared.value)
            sets = [np.unique(shingle_set(t, width) >> np.uint64(16)) for t in batch.column(1).to_pylist()]
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "entries"])
    kind = dict(df.dtypes)["doc_id"]
    return df.select("doc_id", "text", _slot(F.col("doc_id")).alias("slot")).mapInArrow(
        run, f"doc_id {kind}, entries array<long>").withColumn("row", F.monotonically_increasing_id())


def _parity(word: int) -> Column:
    """Aggregate: 64 of the 256 bins of the columns ``h``, each with the parity of its entries."""
    inside = F.shiftright("h", 6).bitwiseAND(F.lit(3)) == word
    return F.bit_xor(F.when(inside, F.expr("shiftleft(1L, int(h & 63L))")).otherwise(F.lit(0).cast("long")))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets reach the threshold.

    A hot row is y of many pairs (the centre of a star): its set is joined while the pairs are
    narrow, so that no task reads the sets of all its partners."""
    both = (pairs.join(sets.withColumnsRenamed({"doc_id": "y", "entries": "b"}), "y")
            .join(sets.withColumnsRenamed({"doc_id": "x", "entries": "a"}), "x")
            .select("x", "y", F.size("a").alias("n"), F.size("b").alias("m"),
                    F.size(F.array_intersect("a", "b")).alias("common")))
    common = F.col("common")
    return both.filter(common * 100 >= (F.col("n") + F.col("m") - common) * percent).select("x", "y")


def components(links: DataFrame, work: str = "") -> DataFrame:
    """(doc_id, label): the smallest id reachable over ``links`` (x, y), for every linked id.

    Minimum-label steps over the links with pointer jumping; every step is written to the
    shared folder and only the number of changed labels comes to the driver."""
    edges = materialize(links.unionAll(links.select("y", "x")).distinct(), work + "edges")
    labels = materialize(edges.select(F.col("x").alias("doc_id")).distinct().withColumn("label", F.col("doc_id")),
                         work + "labels")
    while True:
        near = edges.join(labels, F.col("y") == F.col("doc_id")).groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("doc_id") == F.col("x")).select(
            "doc_id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        far = step.select(F.col("doc_id").alias("at"), F.col("label").alias("far"))
        new = materialize(step.join(far, F.col("label") == F.col("at"), "left").select(
            "doc_id", "old", F.least("label", "far").alias("label")), work + "labels")
        labels = new.select("doc_id", "label")
        if not new.filter(F.col("old") != F.col("label")).limit(1).count():
            return labels


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                       percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    Two rows link when 100 * |intersection| >= ``percent`` * |union| of their shingle sets.
    ``component_id``: smallest id reachable by links, the row's own included.  Null, empty
    and blank texts have empty sets and are linked with nothing.  A null id takes no part
    in links between ids: such a row is its own component (null).  Rows that share an id
    share what any of them reaches.  Very long texts are taken whole.  Other columns are not
    read.  Empty table: no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    work = f"jaccard-{uuid.uuid4().hex}/"  # what is not needed after the components are found
    sets = materialize(_sets(docs, width), "sets")
    named = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # one row of each set: the smallest id's
    classes = materialize(named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), work + "classes")
    miss = F.col("n") - up(F.col("n") * percent, 100)  # entries that a link may lack
    # a column is of a single id if the least and the largest id in it are one
    alone = _low(docs, _row_filter(classes), width, percent).groupBy("h").agg(
        F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")).filter(F.col("doc_id") == F.col("last")) \
        .groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone"))
    # an id with several sets is not judged by their sum: it stays
    several = named.groupBy("doc_id").agg((F.min(F.xxhash64("digest")) < F.max(F.xxhash64("digest"))).alias("several"))
    hopeful = materialize(classes.groupBy("doc_id").agg(F.max("n").alias("n")).join(several, "doc_id").join(
        alone, "doc_id", "left").filter(F.col("several") | (F.coalesce("alone", F.lit(0)) <= miss)).select("doc_id"),
        work + "hopeful")
    whole = materialize(_whole_sets(docs.filter(F.col("doc_id").isNotNull()), _row_filter(hopeful), width), work + "whole")
    if whole.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > 1).limit(1).count():
        whole = materialize(whole.dropDuplicates(["doc_id", "entries"]).withColumn(
            "row", F.monotonically_increasing_id()), work + "whole")  # only where ids repeat
    entry = whole.select("row", F.explode("entries").alias("h"))
    shared = entry.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    mine = entry.join(shared, "h").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("c", "h"))).alias("entries"), *(_parity(w).alias(p) for w, p in enumerate(PARITY)))
    mine = mine.join(whole.select("row", "doc_id", F.size("entries").cast("long").alias("n")), "row").select(
        "doc_id", "n", "entries", *PARITY, (F.col("n") - F.size("entries")).alias("alone")).filter(F.col("alone") <= miss)
    prefix = materialize(mine.select("doc_id", "n", "alone", *PARITY, (F.col("alone") / F.col("n")).alias("apart"), F.explode(
        F.slice("entries", F.lit(1), (miss + 1 - F.col("alone")).cast("int"))["h"]).alias("h")), work + "prefix")
    whole = whole.select("doc_id", "entries")

    def asked(n: str, m: str) -> Column:
        return up((F.col(n) + F.col(m)) * percent, 100 + percent)

    def near(n: str, m: str, apart: Column) -> Column:
        """Sizes and the entries known to be of one row only leave room for a link."""
        return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & \
            (apart <= F.col(n) + F.col(m) - asked(n, m) * 2)

    # stars: every row with the most central row of its columns, the one that leads most of them
    centre = prefix.groupBy("h").agg(F.min(F.struct("apart", "doc_id", "n", "alone")).alias("top"),
                                     F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    led = (prefix.join(centre.select("h", F.col("top.doc_id").alias("y"), F.col("top.n").alias("m"),
                                     F.col("top.apart").alias("apart_y"), F.col("top.alone").alias("alone_m")), "h")
           .filter((F.col("doc_id") != F.col("y")) & near("n", "m", F.col("alone") + F.col("alone_m")))
           .groupBy(F.col("doc_id").alias("x"), "y").agg(F.count(F.lit(1)).alias("c"),
                                                         F.min("apart_y").alias("apart_y"))
           .groupBy("x").agg(F.min_by("y", F.struct(-F.col("c"), "apart_y", "y")).alias("y")))
    stars = materialize(led, work + "stars")
    links = materialize(_links(stars, whole, percent), work + "star-links")
    label = components(links, work)
    # what the stars left apart: products between different components only
    side = materialize(prefix.join(label, "doc_id", "left").select(
        "h", "doc_id", "n", "alone", *PARITY, F.coalesce("label", "doc_id").alias("label")), work + "side")
    open_ = side.groupBy("h").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter(F.col("a") < F.col("b"))
    side = materialize(side.join(open_.select("h"), "h", "left_semi"), work + "open")
    left = side.select("h", F.col("doc_id").alias("x"), "n", "alone", *PARITY, F.col("label").alias("lx"))
    right = side.select("h", F.col("doc_id").alias("y"), F.col("n").alias("m"), F.col("alone").alias("alone_m"),
                        F.col("label").alias("ly"), *(F.col(p).alias(f"{p}_m") for p in PARITY))
    odd = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_m"))) for p in PARITY), F.col("alone") + F.col("alone_m"))
    count = (left.join(right, "h").filter((F.col("x") < F.col("y")) & (F.col("lx") != F.col("ly"))
                                              & near("n", "m", odd))
             .groupBy("x", "y", "n", "m").agg(F.count(F.lit(1)).alias("c")))

    beyond = F.greatest(up(F.col("n") * percent, 100), up(F.col("m") * percent, 100)) - 1
    pairs = materialize(count.filter(F.col("c") + beyond >= asked("n", "m")).select("x", "y").distinct(), work + "pairs")
    # a row follows the representative of its set; an id with several sets ties them together
    follows = materialize(named.join(classes.select("digest", F.col("doc_id").alias("rep")), "digest").select(
        "doc_id", "rep").distinct(), "follows")
    ties = follows.join(follows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > 1), "doc_id",
                        "left_semi").filter(F.col("doc_id") != F.col("rep")).select(
        F.col("doc_id").alias("x"), F.col("rep").alias("y"))
    label = materialize(components(links.unionAll(_links(pairs, whole, percent)).unionAll(ties), work), "components")
    remove(docs.sparkSession, work)
    found = follows.join(label.withColumnRenamed("doc_id", "rep"), "rep", "left").groupBy("doc_id").agg(
        F.min(F.coalesce("label", "rep")).alias("component_id"))
    return sets.select("doc_id", "n").join(found, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
