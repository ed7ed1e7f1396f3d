"""Operator 13, phrase collocations by prefix-free parsing.

Every piece of text is cut at trigger words (one word in ``TRIGGER``, by hash), which depend on
the word alone: the same passage is cut the same way wherever it stands.  A chunk runs from one
cut to the next and on over the next ``max_words`` - 1 words, the overlap.  The dictionary of
distinct chunks, with the number of times each was parsed, replaces the text.  N-grams are
counted inside distinct chunks, weighted by that number, and only those that start before the
overlap: an n-gram that starts in the overlap belongs to the next chunk, so each is counted once.
Words are counted first, then pairs of frequent words, then what only holds frequent pairs, and so
on, which leaves most rare n-grams out of the shuffle and loses no frequent one.

Tasks cut and count in NumPy and Arrow over blocks of bounded size, where Python touches distinct words
and chunks only and a word is a number of its block.  Spark adds the counts up, pre-aggregated, so a word pair
held by a third of all texts costs a row per task.  Scores are exact decimal arithmetic.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices

TRIGGER = 16
#: Entries of a task's dictionary before it is handed on.
HELD = 1 << 18
#: Bytes of text that a task cuts at once, or one piece.
BLOCK = 1 << 20
#: Bytes of chunks in which a task counts at once.
GATHERED = 8 << 20
#: Bits of the filter of frequent shorter grams, of fixed size; only the work depends on it.
FILTER_BITS = 1 << 24
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Parts in which a language's candidates are ranked before the last ranking.
PARTS = 256
#: Piece ends become newlines, tabs blanks.
ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")


class _Triggers(dict):
    """word -> does it start a chunk; a memo of bounded size."""
    def __missing__(self, word: bytes) -> bool:
        if len(self) >= HELD:
            self.clear()
        out = self[word] = xxhash.xxh32_intdigest(word) % TRIGGER == 0
        return out


def pieces_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of each piece, A-Z lower-cased; pieces without a word are left out."""
    for piece in (text or "").encode("utf-8", "surrogatepass").lower().translate(ENDS).split(b"\n"):
        words = piece.split()  # only blanks are left of the ASCII white space
        if words:
            yield words


def chunks_of(words: list[bytes], triggers: dict, max_words: int) -> Iterator[tuple[int, list[bytes]]]:
    """(own, words): a chunk and the number of its words before the overlap.

    The rule for one piece, word by word; ``cut_block`` cuts whole blocks by it."""
    start = 0
    for at, word in enumerate(words):
        if at and triggers[word]:
            yield at - start, words[start:at + max_words - 1]
            start = at
    yield len(words) - start, words[start:]


def _table(counts: dict, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    keys = list(zip(*counts, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [*(pa.array(k, pa.binary()).cast(pa.string()) if kind == pa.string() else pa.array(k, kind)
           for k, kind in zip(keys, kinds, strict=True)), pa.array(counts.values(), pa.int64())], [*names, "c"])


def _bytes(held: pa.LargeBinaryArray) -> list[bytes]:
    """The values of an array without nulls (``to_pylist`` makes an object of Arrow's for each)."""
    at = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held) + 1].tolist()
    data = held.buffers()[2].to_pybytes() if len(held) else b""
    return [data[i:j] for i, j in zip(at, at[1:], strict=False)]


def _words(text: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """(numbers, words) of a text in which each word ends at one of ``stops``, a blank, and the next
    one begins right behind it: the words once each, and the number of each word of the text."""
    ends = np.append(0, stops + 1).astype(np.int64)
    held = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(stops), [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
    return held.indices.to_numpy(), pc.binary_slice(held.dictionary, 0, -1)


def cut_block(block: bytes, triggers: dict, max_words: int) -> tuple[np.ndarray, list[int], list[bytes]]:
    """(place, own, chunk) of the chunks of a block of text that is lower-cased, with its pieces ended
    by newlines: what ``chunks_of`` makes of each piece, for all pieces at once.  Place: a byte of the
    block that belongs to the chunk."""
    raw = np.frombuffer(block, np.uint8)
    line = raw == 10
    inside = (raw != 32) & ~line
    after = np.zeros(len(raw), bool)  # the byte behind each word
    after[1:] = inside[:-1] & ~inside[1:]
    kept = inside | after
    flat, stops = raw[kept], np.flatnonzero(after[kept])
    if not len(stops):
        return stops, [], []
    flat[stops] = 32
    last_byte = np.flatnonzero(after) - 1
    first = np.flatnonzero(np.diff(np.cumsum(line)[last_byte], prepend=-1))  # words that begin a piece
    numbers, words = _words(flat, stops)
    words = _bytes(words)
    begins = np.fromiter(map(triggers.__getitem__, words), bool, len(words))[numbers]
    begins[first] = True
    at = np.flatnonzero(begins)
    to, bounds = np.append(at[1:], len(stops)), np.append(first, len(stops))
    until = np.minimum(to + max_words - 1, bounds[np.searchsorted(bounds, at, "right")])
    text = flat.tobytes()
    starts = np.concatenate([[0], stops[:-1] + 1])[at]
    return last_byte[at], (to - at).tolist(), [text[i:j] for i, j in zip(starts.tolist(), stops[until - 1].tolist(), strict=True)]


def dictionary(texts: DataFrame, max_words: int) -> DataFrame:
    """(lang, own, chunk, c): the distinct chunks of ``texts`` (lang, text) and their parse frequency."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triggers, counts = _Triggers(), Counter()

        def flush() -> pa.RecordBatch:
            out = _table(counts, ["lang", "own", "chunk"], [pa.string(), pa.int32(), pa.string()])
            counts.clear()
            return out
        for batch in slices(batches, BLOCK):
            langs, rows = (c.cast(pa.binary()).to_pylist() for c in batch.columns)
            rows = [t or b"" for t in rows]
            row_ends = np.cumsum([len(t) + 1 for t in rows])
            text = (b"\n".join(rows) + b"\n").lower().translate(ENDS)
            start = 0
            while start < len(text):  # a long text in blocks of whole pieces
                stop = text.find(b"\n", min(start + BLOCK, len(text)) - 1) + 1
                place, own, chunk = cut_block(text[start:stop], triggers, max_words)
                lang = map(langs.__getitem__, np.searchsorted(row_ends, place + start, "right").tolist())
                keys = zip(lang, own, chunk, strict=True)
                while some := list(islice(keys, HELD)):
                    counts.update(some)
                    if len(counts) >= HELD:
                        yield flush()
                start = stop
        yield flush()
    return texts.mapInArrow(run, "lang string, own int, chunk string, c long") \
        .groupBy("lang", "own", "chunk").agg(F.sum("c").alias("c"))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``GATHERED`` bytes: what is counted together need not be sent twice."""
    held, size = [], 0
    for batch in slices(batches, GATHERED):
        held.append(batch)
        size += batch.nbytes
        if size >= GATHERED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _slots(words: np.ndarray, size: int, bits: int) -> np.ndarray:
    """The filter bit of the ``size``-gram at each start in an array of hashes of words and language."""
    h = words[:max(0, len(words) - size + 1)].copy()
    for j in range(1, size):
        h = (h ^ (h >> np.uint64(32))) * MIX + words[j:len(words) - size + 1 + j]
    h = (h ^ (h >> np.uint64(29))) * MIX
    return (h >> np.uint64(24)) % np.uint64(bits)


def ngram_counts(chunks: DataFrame, size: int, shorter: np.ndarray | None) -> DataFrame:
    """(lang, gram, f): the n-grams of ``size`` words and their occurrences, without some that hold a
    shorter gram missing from the filter ``shorter`` (all, if None)."""
    known = None if shorter is None else chunks.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            text = pc.binary_join_element_wise(
                batch.column(2).cast(pa.large_binary()), *(pa.scalar(x, pa.large_binary()) for x in (b"", b" ")))
            text = np.frombuffer(text.buffers()[2], np.uint8, pc.sum(pc.binary_length(text)).as_py())
            ids, words = _words(text, np.flatnonzero(text == 32))
            lens = pc.count_substring(batch.column(2), " ").to_numpy().astype(np.int64) + 1
            own, weight = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            lang_of = batch.column(0).dictionary_encode()
            row = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
            # an n-gram starts before the overlap and ends in its chunk
            until = np.cumsum(lens) - lens + np.minimum(own, lens - size + 1)
            good = np.arange(len(ids)) < until[row]
            if known is not None and size > 1:
                bits = known.value
                langs = _hashes(lang_of.dictionary.cast(pa.binary()).to_pylist())[lang_of.indices.to_numpy()]
                slot = _slots(_hashes(_bytes(words))[ids] + langs[row], size - 1, len(bits) * 8)
                held = np.zeros(len(ids) + 1, bool)
                held[:len(slot)] = bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1
                good &= held[:-1] & held[1:]
                del slot, held
            at = np.flatnonzero(good)
            code = lang_of.indices.to_numpy().astype(np.int64)[row[at]]
            for j in range(size):
                if int(code.max(initial=0)) >= (1 << 62) // len(words):
                    code = np.unique(code, return_inverse=True)[1]
                code = code * len(words) + ids[at + j]
            order = np.argsort(code)
            code, at = code[order], at[order]
            first = np.flatnonzero(np.diff(code, prepend=-1))
            weight = weight[row[at]]
            f = np.add.reduceat(weight, first) if len(first) else weight
            at = at[first]
            word = words.cast(pa.large_string()).cast(pa.string())
            grams = [word.take(pa.array(ids[at + j])) for j in range(size)]
            grams = pc.binary_join_element_wise(*grams, " ") if size > 1 else grams[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row[at])), grams, pa.array(f, pa.int64())], ["lang", "gram", "c"])
    return chunks.mapInArrow(run, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("f"))


def gram_filter(grams: DataFrame, size: int, bits: int) -> np.ndarray:
    """Bitmap of the ``size``-grams of ``grams`` (lang, gram), of ``bits`` bits whatever there is:
    a gram of the table is always found, and few others are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = (c.cast(pa.binary()).to_pylist() for c in batch.columns)
            hashes = _hashes([w for g in words for w in g.split(b" ")]) + np.repeat(_hashes(langs), size)
            slot = _slots(hashes, size, bits)[::size]
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64))], ["slot"])
    rows = grams.select("lang", "gram").mapInArrow(run, "slot long").groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot & 63L))")).alias("word"))
    out = np.zeros(bits // 64, "<i8")
    for r in rows.toLocalIterator():  # at most bits / 64 rows
        out[r["at"]] = r["word"]
    return out.view(np.uint8)


def frequent_ngrams(chunks: DataFrame, max_words: int, min_count: int, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, size, gram, f): all n-grams of up to ``max_words`` words that occur ``min_count`` times.

    Shortest first: an n-gram is at most as frequent as the shorter ones inside it, so
    one with a rarer part is not counted (the filter lets some through, the last test does not)."""
    shorter, out = None, []
    for size in range(1, max_words + 1):
        grams = materialize(ngram_counts(chunks, size, shorter).filter(F.col("f") >= min_count), f"grams-{size}")
        out.append(grams.select("lang", F.lit(size).alias("size"), "gram", "f"))
        if size < max_words:
            shorter = gram_filter(grams, size, bits)
    return reduce(DataFrame.unionAll, out)


def collocations(df: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, inside_percent: int = 50,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases of 2 to
    ``max_words`` words.

    A candidate occurs a >= ``min_count`` times in its language's pieces (overlaps included).  Of its
    cuts in two, with l and r occurrences of the parts, the lowest floor(1000000 * a * a / (l * r))
    counts, of equal ones the first.  A candidate that lies inside a longer one with at least
    ``inside_percent`` % of its occurrences is dropped.  Order: score, then a (falling), then phrase
    by bytes.  n: words of the language.  Null language: ``und``; null and empty texts have no
    words, and a language without candidates has no rows.  Repeated rows count as often as they
    occur.  Very long texts are taken whole.  Other columns are not read.
    """
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    chunks = materialize(dictionary(texts, max_words), "chunks")
    words = chunks.groupBy("lang").agg(F.sum(F.col("c") * F.col("own")).alias("n"))
    # the parts of a candidate are at least as frequent as it is
    grams = frequent_ngrams(chunks, max_words, min_count)
    known = grams.select("lang", F.col("gram").alias("part"), "f")
    candidate = grams.filter(F.col("size") > 1).select("lang", "size", F.col("gram").alias("phrase"), F.col("f").alias("a"))
    word = F.split("phrase", " ")
    cut = candidate.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("*", F.array_join(F.slice(word, F.lit(1), F.col("k")), " ").alias("first"),
                     F.array_join(F.slice(word, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    cut = cut.join(known.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first"]) \
        .join(known.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    # whole numbers of up to 38 digits; a quotient is at most 1000000
    a, l, r = (F.col(x).cast("decimal(16,0)") for x in ("a", "l", "r"))
    cut = cut.withColumn("up", F.lit(1000000).cast("decimal(7,0)") * a * a).withColumn("down", l * r) \
        .withColumn("score", F.expr("up div down"))
    best = cut.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # every shorter phrase inside a candidate, with the most occurrences of such a candidate
    inner = F.sequence(F.lit(2), F.col("size") - 1)
    inside = candidate.filter(F.col("size") > 2).select("lang", "a", "size", word.alias("w"), F.explode(inner).alias("m")) \
        .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at")) \
        .groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("longer") * 100 < F.col("a") * inside_percent, F.lit(True))).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = kept.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
