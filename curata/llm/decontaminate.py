"""Operator 6, benchmark decontamination by the q-gram lemma.

Texts and benchmark items are compared as UTF-8 bytes, ASCII-lower-cased, with runs of
ASCII white space as one blank.  An item of m bytes may differ by k = ``edit_rate`` * m
edits.  An occurrence with at most k edits keeps at least m - q + 1 - k * q of the item's
q-grams, all of them on k + 1 neighbouring diagonals (text position minus item
position).  So shared q-grams are counted in overlapping diagonal bands of 2 * (k + 1),
one every k + 1; bands with too few cannot hold an occurrence, the others are verified
by a banded alignment.  k is lowered where the lemma would ask for less than one q-gram.

An item longer than ``WINDOW`` bytes also leaks in part: each of its windows of that
length, one every ``STRIDE`` bytes and one at its end, is looked for by the same lemma,
bands and alignment, with ``edit_rate`` of the window's length.  So every verbatim
passage of ``WINDOW + STRIDE - 1`` bytes holds a whole window.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

Q = 8  # a q-gram is one 64-bit number
BITS = 22
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of benchmark text in one broadcast block; a larger benchmark takes more passes.
BLOCK_BYTES = 4 << 20
WINDOW, STRIDE = 200, 25  # bytes: about 30 words
#: Pairs of equal q-grams (one in a text, one in an item) that are laid out at once.
MAX_PAIRS = 1 << 20


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def grams(buf: bytes) -> np.ndarray:
    """All q-grams of a buffer as numbers."""
    if len(buf) < Q:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(buf, np.uint8)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, Q)).view("<u8").ravel()


def slot(g: np.ndarray) -> np.ndarray:
    return (g * MIX) >> np.uint64(64 - BITS)


def budget(m: np.ndarray, edit_rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Edits that patterns of m bytes may have, and the q-grams that an occurrence then keeps."""
    k = np.minimum((m * edit_rate).astype(np.int64), np.maximum(0, (m - Q) // Q))
    return k, np.maximum(1, m - Q + 1 - k * Q)


def window_starts(m: int) -> np.ndarray:
    return np.append(np.arange(0, m - WINDOW, STRIDE), m - WINDOW)


class Block:
    """q-gram index of some items."""

    def __init__(self, items: list[tuple[int, bytes]], edit_rate: float):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.k, self.least = budget(m, edit_rate)
        self.long = m > WINDOW
        self.window_k, self.window_least = map(int, budget(np.int64(WINDOW), edit_rate))
        own = [grams(t) for t in self.texts]
        all_grams = np.concatenate([*own, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(own)), [len(x) for x in own])
        at = np.concatenate([np.arange(len(x)) for x in own] + [np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(all_grams, kind="stable")
        self.item, self.at = item[order], at[order]
        self.keys, self.first, self.times = np.unique(all_grams[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[slot(self.keys)] = True


def banded_edits(pattern: bytes, region: bytes, k: int) -> int:
    """Least edits from ``pattern`` to any stretch of ``region``, along the diagonals the region
    allows and k more to either side (enough for any alignment with at most k edits)."""
    p, m = np.frombuffer(pattern, np.uint8), len(pattern)
    width = max(1, len(region) - m + 1) + 2 * k
    r = np.full(m + width, 256, np.uint16)  # outside the region nothing matches
    r[k:k + len(region)] = np.frombuffer(region, np.uint8)
    steps, row = np.arange(width), np.zeros(width, np.int64)
    for i in range(m):
        new = row + (r[i:i + width] != p[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def cells(pair: np.ndarray, diagonal: np.ndarray, step: np.ndarray | int, least: Callable) -> Iterator[tuple]:
    """(pair, band, hits) of the bands of 2 * ``step`` diagonals, one every ``step``, with enough hits."""
    band = diagonal // step
    # a band covers the cells b and b + 1 of ``step`` diagonals each
    key_pair = np.concatenate([pair, pair])
    key_band = np.concatenate([band, band - 1])
    order = np.lexsort((key_band, key_pair))
    key_pair, key_band = key_pair[order], key_band[order]
    new = np.flatnonzero(np.concatenate([[True], (key_pair[1:] != key_pair[:-1]) | (key_band[1:] != key_band[:-1])]))
    count = np.diff(np.append(new, len(key_pair)))
    keep = count >= least(key_pair[new])
    for at, n in zip(new[keep].tolist(), count[keep].tolist(), strict=True):
        yield int(key_pair[at]), int(key_band[at]), order[at:at + n] % len(pair)


def verified(text: bytes, pattern: bytes, k: int, low: int) -> tuple[int, int]:
    """(edits, about where) of ``pattern`` on the 2 * (k + 1) diagonals from ``low`` on."""
    begin = max(0, low - k)
    region = text[begin:max(0, low + 2 * (k + 1) + len(pattern) + k)]
    at = region.find(pattern)
    edits = 0 if at >= 0 else banded_edits(pattern, region, k) if len(region) >= len(pattern) - k else k + 1
    return edits, begin + max(0, at)


def pieces(text: np.ndarray, where: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The hits (text number, number of the q-gram in the index) in pieces of at most ``MAX_PAIRS`` pairs:
    (hits, items or None for all).  A piece holds whole (text, item) pairs, so what is found does not
    depend on the cut; a single such pair may be larger."""
    total = np.bincount(text, block.times[where])
    part = np.zeros(len(total), np.int64)
    filled = number = 0
    for t in np.flatnonzero(total):
        if filled and filled + total[t] > MAX_PAIRS:
            filled, number = 0, number + 1
        part[t], filled = number, filled + total[t]
    for n in range(number + 1):
        own = np.flatnonzero(part[text] == n)
        if block.times[where[own]].sum() <= MAX_PAIRS:
            yield own, None
            continue
        # one text alone: pairs of each item, then runs of items
        keys, count = np.unique(where[own], return_counts=True)
        per_item = np.zeros(len(block.texts), np.int64)
        for a in range(0, len(keys), 4096):
            times = block.times[keys[a:a + 4096]]
            np.add.at(per_item, block.item[spread(block.first[keys[a:a + 4096]], times)], np.repeat(count[a:a + 4096], times))
        run = (np.cumsum(per_item) - 1) // MAX_PAIRS
        for r in np.unique(run[per_item > 0]):
            items = (run == r) & (per_item > 0)
            yield own, items


def spread(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for ``times`` numbers each."""
    return np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())


def find(texts: list[bytes], block: Block) -> Iterator[tuple[int, int, int, int]]:
    """(text number, item number, edits, about where), one per pair: the best occurrence of the
    whole item, else of any of its windows."""
    gap = b"\0" * Q
    buf = gap.join(texts) + gap
    starts = np.cumsum([0, *(len(t) + Q for t in texts)])[:-1]
    g = grams(buf)
    hits = np.flatnonzero(block.seen[slot(g)])
    where = np.searchsorted(block.keys, g[hits])
    real = (where < len(block.keys)) & (block.keys[np.minimum(where, len(block.keys) - 1)] == g[hits])
    hits, where = hits[real], where[real]
    if not len(hits):
        return
    text = np.searchsorted(starts, hits, "right") - 1
    for own, items in pieces(text, where, block):
        pos, index = lay_out(hits[own], where[own], items, block)
        yield from matches(texts, starts, pos, index, block)


def lay_out(hits: np.ndarray, where: np.ndarray, items: np.ndarray | None, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(position in the texts, number in the index) of every pair of equal q-grams, of the marked items only."""
    if items is None:
        return np.repeat(hits, block.times[where]), spread(block.first[where], block.times[where])
    pos, index = [], []
    most = max(1, MAX_PAIRS // int(block.times[where].max()))  # hits at once, before items are chosen
    for a in range(0, len(hits), most):
        times = block.times[where[a:a + most]]
        i = spread(block.first[where[a:a + most]], times)
        chosen = items[block.item[i]]
        pos.append(np.repeat(hits[a:a + most], times)[chosen])
        index.append(i[chosen])
    return np.concatenate(pos), np.concatenate(index)


def matches(texts: list[bytes], starts: np.ndarray, pos: np.ndarray, index: np.ndarray,
            block: Block) -> Iterator[tuple[int, int, int, int]]:
    """What ``find`` gives, from the pairs of equal q-grams."""
    item, at_item = block.item[index], block.at[index]
    shift = max(map(len, block.texts))  # diagonals may be negative
    diagonal = pos - at_item + shift
    text = np.searchsorted(starts, pos, "right") - 1
    n_items = len(block.texts)
    pair = text.astype(np.int64) * n_items + item
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for pr, b, _ in cells(pair, diagonal, block.k[item] + 1, lambda p: block.least[p % n_items]):
        t, i = divmod(pr, n_items)
        k = int(block.k[i])
        if (t, i) in best and best[t, i][0] == 0:
            continue
        edits, at = verified(texts[t], block.texts[i], k, b * (k + 1) - shift - int(starts[t]))
        if edits <= k and ((t, i) not in best or edits < best[t, i][0]):
            best[t, i] = (edits, at)
    in_part: dict[tuple[int, int], tuple[int, int]] = {}
    some, k = block.long[item], block.window_k
    if some.any():
        at_item = at_item[some]
        for pr, b, own in cells(pair[some], diagonal[some], k + 1, lambda p: block.window_least):
            t, i = divmod(pr, n_items)
            if (t, i) in best or in_part.get((t, i), (1, 0))[0] == 0:
                continue
            item_text, low = block.texts[i], b * (k + 1) - shift - int(starts[t])
            begins, have = window_starts(len(item_text)), np.sort(at_item[own])
            shared = np.searchsorted(have, begins + WINDOW - Q, "right") - np.searchsorted(have, begins)
            enough = np.flatnonzero(shared >= block.window_least)
            for w in enough[np.argsort(-shared[enough], kind="stable")]:  # the likeliest first
                begin = int(begins[w])
                edits, at = verified(texts[t], item_text[begin:begin + WINDOW], k, low + begin)
                if edits <= k and ((t, i) not in in_part or edits < in_part[t, i][0]):
                    in_part[t, i] = (edits, at)
                if edits == 0:
                    break
    for (t, i), (edits, at) in (in_part | best).items():
        yield t, i, edits, at


def blocks(benchmark: DataFrame, item_col: str, text_col: str, edit_rate: float) -> Iterator[Block]:
    """The benchmark in blocks of at most ``BLOCK_BYTES`` (or one item), read one by one."""
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).distinct().orderBy("i", "t")
    items, size = [], 0
    for r in rows.toLocalIterator():
        t = normal(r["t"])
        if len(t) < Q:
            continue
        if items and size + len(t) > BLOCK_BYTES:
            yield Block(items, edit_rate)
            items, size = [], 0
        items.append((r["i"], t))
        size += len(t)
    if items:
        yield Block(items, edit_rate)


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", edit_rate: float = 0.08) -> DataFrame:
    """(doc_id, item_id, edits, at): the benchmark items that occur in each text, whole or in part.

    ``edits``: of the best occurrence of the whole item, else of its best window; ``at``:
    about where that starts in the normalised text.  Whole texts are searched; the benchmark is read in blocks of bounded size,
    each broadcast and matched against all rows in one pass without a shuffle.
    Null and empty texts match nothing; items of fewer than 8 bytes cannot be told
    from chance and are skipped.  Repeated rows are reported each.  Other columns are
    not read.  Empty tables: no rows.
    """
    spark = df.sparkSession
    schema = f"doc_id {dict(df.dtypes)[id_col]}, item_id {dict(benchmark.dtypes)[item_col]}, edits int, at long"
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.octet_length("text") >= Q)
    out = spark.createDataFrame([], schema)
    item_type = pa.int64() if dict(benchmark.dtypes)[item_col] == "bigint" else None
    for block in blocks(benchmark, item_col, item_text_col, edit_rate):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 4 << 20):
                ids = batch.column(0)
                found = list(find([normal(t) for t in batch.column(1).to_pylist()], shared.value))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([f[0] for f in found], pa.int64())),
                     pa.array([shared.value.ids[f[1]] for f in found], item_type),
                     pa.array([f[2] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int64())],
                    names=["doc_id", "item_id", "edits", "at"])
        out = out.unionAll(texts.mapInArrow(scan, schema))
    return out
