"""Operator 7, language identification with interpolated Kneser-Ney character models.

A text is lower-cased and every run of other signs than letters becomes one blank; its
UTF-16 units are the characters.  Four units fit one 64-bit number, so an n-gram is its
own hash.  Spark counts the 4-grams of each language over all learning rows; the lower
orders use Kneser-Ney continuation counts, each order has its own discount n1 / (n1 + 2 n2),
and probabilities are interpolated down to the uniform distribution.  Probabilities of seen
n-grams and back-off weights of seen contexts are stored per language and order as sorted
arrays and looked up by binary search.  The language with the lowest cross-entropy per
character wins.

All entries that an n-gram needs beyond single characters hold its last but one character,
so a model too large for one broadcast is cut by (language, that character) into blocks,
each broadcast and scored in a pass of its own; a text's sums over the blocks are exact.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

ORDER = 4
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Entries (12 bytes each) that may be broadcast at once; a larger model is scored in blocks.
MAX_ENTRIES = 16_000_000
BINS = 40
NOTHING = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
SIGNS = 1 << 16


def encoded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram numbers of all texts one after the other, where each text's begin, and how
    many letters or blanks each predicts (0: no letter)."""
    parts, lengths = [], []
    for t in texts:
        s = NOT_LETTERS.sub(" ", (t or "").lower()).strip()
        if not any(map(str.isalpha, s)):  # signs such as one half or a circled one are no letters
            s = ""
        raw = ("\0\0\0 " + s + " ").encode("utf-16-le", "surrogatepass") if s else b""
        parts.append(raw)
        lengths.append(len(raw) // 2)
    c = np.frombuffer(b"\0\0" * (ORDER - 1) + b"".join(parts), np.uint16).astype(np.uint64)
    keys = c[ORDER - 1:].copy()
    for j in range(1, ORDER):
        keys |= c[ORDER - 1 - j:len(c) - j] << np.uint64(16 * j)
    n = np.array(lengths, np.int64)
    # the padding and the first blank are context, not predictions
    inside = np.arange(len(keys)) - np.repeat(np.cumsum(n) - n, n) >= ORDER
    starts = np.cumsum(np.maximum(n - ORDER, 0)) - np.maximum(n - ORDER, 0)
    return keys[inside], starts, np.maximum(n - ORDER, 0)


def count_grams(df: DataFrame) -> DataFrame:
    """(lang, key, c): 4-gram counts of the columns ``lang`` and ``text``."""
    def emit(counts: dict) -> Iterator[pa.RecordBatch]:
        for lang, (k, c) in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(c)], ["lang", "key", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, 4 << 20):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                keys = encoded([t for x, t in zip(langs, texts, strict=True) if x == lang])[0]
                k, c = np.unique(keys, return_counts=True)
                if lang in counts:
                    k0, c0 = counts[lang]
                    k, inverse = np.unique(np.concatenate([k0, k]), return_inverse=True)
                    c = np.bincount(inverse, np.concatenate([c0, c])).astype(np.int64)
                counts[lang] = (k, c.astype(np.int64))
            if sum(len(k) for k, _ in counts.values()) > 2_000_000:
                yield from emit(counts)
                counts = {}
        yield from emit(counts)
    return df.select("lang", "text").mapInArrow(count, "lang string, key long, c long").groupBy("lang", "key") \
        .agg(F.sum("c").alias("c"))


def _mask(n: int) -> int:
    return (1 << (16 * n)) - 1


def kneser_ney(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, n, kind, key, value): log probabilities (kind p) and back-off weights (kind g)."""
    counts = {ORDER: grams}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: in how many longer n-grams
        short = F.col("key").bitwiseAND(F.lit(_mask(n)))
        counts[n] = counts[n + 1].groupBy("lang", short.alias("key")).agg(F.count(F.lit(1)).alias("c"))
    signs = counts[1].select("key").distinct().agg((F.count(F.lit(1)) + 1).alias("signs"))
    lower, out = None, None
    for n in range(1, order + 1):
        context: Column = F.shiftrightunsigned("key", 16) if n > 1 else F.lit(0).cast("long")
        c = counts[n].withColumn("context", context)
        d = c.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")) \
            .select("lang", ((F.col("n1") + 0.5) / (F.col("n1") + 2 * F.col("n2") + 1)).alias("d"))
        sums = c.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds")) \
            .join(d, "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        full = c.join(sums, ["lang", "context"])
        if n == 1:
            full = full.crossJoin(F.broadcast(signs)).withColumn("below", 1.0 / F.col("signs"))  # one row
        else:
            full = full.withColumn("short", F.col("key").bitwiseAND(F.lit(_mask(n - 1)))) \
                .join(lower.withColumnsRenamed({"key": "short", "p": "below"}), ["lang", "short"])
        p = full.select("lang", "key", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")
                                        + F.col("weight") * F.col("below")).alias("p"))
        lower = p
        rows = p.select("lang", F.lit(n).alias("n"), F.lit("p").alias("kind"), "key", F.log("p").alias("value")) \
            .unionAll(sums.select("lang", F.lit(n), F.lit("g"), F.col("context"), F.log("weight")))
        out = rows if out is None else out.unionAll(rows)
    # one more row per language: a sign never seen
    unseen = signs.select(F.lit(None).cast("string"), F.lit(0), F.lit("p"), F.lit(0).cast("long"),
                          -F.log("signs"))
    return out.unionAll(unseen)


class Models:
    """Sorted arrays of every language's model."""

    def __init__(self, langs: list[str], unseen: float, order: int, code: np.ndarray, key: np.ndarray, value: np.ndarray):
        """``code``: language number * 16 + order * 2 + (1 for back-off weights), per entry."""
        self.langs, self.unseen, self.order, self.arrays = langs, unseen, order, {}
        by_code = np.lexsort((key.view(np.uint64), code))
        code, key, value = code[by_code], key[by_code].view(np.uint64), value[by_code].astype(np.float32)
        first = np.flatnonzero(np.diff(code, prepend=-1))
        for at, to in zip(first, np.append(first, len(code))[1:], strict=True):
            c = int(code[at])
            self.arrays[langs[c // 16], c % 16 // 2, "g" if c % 2 else "p"] = (key[at:to], value[at:to])

    def _look(self, lang: str, n: int, kind: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, v = self.arrays.get((lang, n, kind), NOTHING)
        if not len(k):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
        return k[at] == keys, v[at]

    def log_p(self, lang: str, keys: np.ndarray, n: int | None = None) -> np.ndarray:
        """Log probability of the last character of each n-gram given the others."""
        n = self.order if n is None else n
        if n == 0:
            return np.full(len(keys), self.unseen)
        keys = keys & np.uint64(_mask(n))
        seen, value = self._look(lang, n, "p", keys)
        out = value.astype(np.float64)
        if not seen.all():
            rest = keys[~seen]
            known, weight = self._look(lang, n, "g", rest >> np.uint64(16) if n > 1 else np.zeros_like(rest))
            out[~seen] = np.where(known, weight, 0.0) + self.log_p(lang, rest, n - 1)
        return out


class Table:
    """The entries of all models as a table, with the number of each entry's part."""

    def __init__(self, df: DataFrame):
        """From the columns ``lang`` (not null) and ``text``; counts cover every row."""
        grams = materialize(count_grams(df.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())), "grams")
        table = materialize(kneser_ney(grams), "models")
        self.langs = langs = sorted(r["lang"] for r in table.select("lang").distinct().collect() if r["lang"] is not None)
        unseen, order = table.agg(F.max(F.when(F.col("n") == 0, F.col("value"))), F.max("n")).first()
        self.unseen, self.order = float(unseen or 0.0), order or 0
        lang = F.array_position(F.array(*(F.lit(x) for x in langs)), F.col("lang")) - 1 if langs else F.lit(0)
        sign = F.when(F.col("kind") == "g", F.col("key")).otherwise(F.shiftrightunsigned("key", 16)).bitwiseAND(F.lit(SIGNS - 1))
        # part: language and last but one character; null for what every n-gram of the language needs
        self.rows = table.filter("n > 0").select(
            lang.alias("lang_no"), F.when(F.col("n") > 1, lang * SIGNS + sign).alias("part"),
            (lang * 16 + F.col("n") * 2 + F.when(F.col("kind") == "g", 1).otherwise(0)).cast("int").alias("code"),
            "key", F.col("value").cast("float").alias("value"))

    def models(self, first: int = 0, last: int | None = None) -> Models:
        """The entries of the parts ``first`` to ``last``, brought to the driver."""
        last = len(self.langs) * SIGNS - 1 if last is None else last
        mine = F.col("part").between(first, last) | (F.col("part").isNull() & F.col("lang_no").between(first // SIGNS, last // SIGNS))
        got = self.rows.filter(mine).select("code", "key", "value").toArrow()
        return Models(self.langs, self.unseen, self.order, *(got.column(i).to_numpy() for i in range(3)))

    def blocks(self) -> list[tuple[int, int]]:
        """First and last part of blocks of at most ``MAX_ENTRIES`` entries (or one part) that cover all parts."""
        common, sizes = {}, []
        for r in self.rows.groupBy("lang_no", "part").agg(F.count(F.lit(1)).alias("c")).collect():
            if r["part"] is None:
                common[r["lang_no"]] = r["c"]
            else:
                sizes.append((r["part"], r["c"]))
        starts, size, lang = [0], 0, None
        for part, c in sorted(sizes):
            new = c + (common.get(part // SIGNS, 0) if part // SIGNS != lang else 0)
            if size and size + new > MAX_ENTRIES:
                starts.append(part)
                size, new = 0, c + common.get(part // SIGNS, 0)
            size, lang = size + new, part // SIGNS
        return list(zip(starts, [*(x - 1 for x in starts[1:]), len(self.langs) * SIGNS - 1], strict=True))


def train(df: DataFrame) -> Models:
    """Models of full order from the columns ``lang`` (not null) and ``text``, in one piece."""
    return Table(df).models()


def entropies_in_blocks(df: DataFrame, table: Table, keep: list[str]) -> DataFrame:
    """As :func:`entropies`, from one broadcast and pass per block of the models."""
    rows = materialize(df.select(*keep, "text", F.monotonically_increasing_id().alias("row_no")), "numbered")
    texts, sums = rows.select("row_no", "text"), None
    for first, last in table.blocks():
        shared = df.sparkSession.sparkContext.broadcast(table.models(first, last))

        def score(batches: Iterator[pa.RecordBatch], shared=shared, first=first, last=last) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in slices(batches, 4 << 20):
                keys, starts, n = encoded(batch.column(1).to_pylist())
                some = n > 0
                if not some.any():
                    continue
                u, inverse = np.unique(keys, return_inverse=True)
                sign = ((u >> np.uint64(16)) & np.uint64(SIGNS - 1)).astype(np.int64)
                for i in range(first // SIGNS, last // SIGNS + 1):
                    own = (i * SIGNS + sign >= first) & (i * SIGNS + sign <= last)
                    log_p = np.zeros(len(u))
                    log_p[own] = m.log_p(m.langs[i], u[own])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).filter(pa.array(some)), pa.array(np.full(some.sum(), i, np.int32)), pa.array(n[some]),
                         pa.array(np.add.reduceat(log_p[inverse], starts[some]))], names=["row_no", "lang_no", "n", "s"])
        part = texts.mapInArrow(score, "row_no long, lang_no int, n long, s double")
        sums = part if sums is None else sums.unionAll(part)
    h = sums.groupBy("row_no", "lang_no").agg(F.max("n").alias("n_signs"), F.sum("s").alias("s")) \
        .withColumn("at", F.struct((-F.col("s") / F.col("n_signs")).alias("h"), "lang_no"))
    ranked = h.groupBy("row_no").agg(F.max("n_signs").alias("n_signs"), F.array_sort(F.collect_list("at")).alias("r"))
    second = F.get("r", F.lit(1))["h"] if len(table.langs) > 1 else F.lit(-table.unseen)
    names = F.array(*(F.lit(x) for x in table.langs))
    found = ranked.select("row_no", "n_signs", F.get("r", F.lit(0)).alias("first"), second.alias("second"))
    return rows.drop("text").join(found, "row_no", "left").select(
        *keep, F.coalesce("n_signs", F.lit(0).cast("long")).alias("n_signs"), F.get(names, F.col("first.lang_no")).alias("best"),
        F.col("first.h").alias("entropy"), (F.col("second") - F.col("first.h")).alias("lead"))


def entropies(df: DataFrame, models: Models, keep: list[str]) -> DataFrame:
    """``keep`` columns, characters scored, best language, its cross-entropy and the lead over the next."""
    shared = df.sparkSession.sparkContext.broadcast(models)
    kept = df.select(*keep, "text")
    schema = ", ".join(f"{c} {t}" for c, t in kept.dtypes if c != "text")
    arrow_out = "n_signs long, best string, entropy double, lead double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, 4 << 20):
            keys, starts, n = encoded(batch.column(len(keep)).to_pylist())
            u, inverse = np.unique(keys, return_inverse=True)
            some = n > 0
            h = np.full((len(m.langs), len(n)), np.inf)
            for i, lang in enumerate(m.langs):
                if some.any():
                    h[i, some] = -np.add.reduceat(m.log_p(lang, u)[inverse], starts[some]) / n[some]
            if m.langs:
                order = np.argsort(h, axis=0, kind="stable")
                best, at = order[0], np.arange(len(n))
                first = h[best, at]
                second = h[order[1], at] if len(m.langs) > 1 else np.full(len(n), m.unseen * -1.0)
            else:
                best, first, second = np.zeros(len(n), int), np.zeros(len(n)), np.zeros(len(n))
                some = np.zeros(len(n), bool)
            lead = np.where(some, second - np.where(some, first, 0.0), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(j) for j in range(len(keep))]
                + [pa.array(n), pa.array([m.langs[b] if s else None for b, s in zip(best, some, strict=True)], pa.string()),
                   pa.array([float(x) if s else None for x, s in zip(first, some, strict=True)], pa.float64()),
                   pa.array([float(x) if s else None for x, s in zip(lead, some, strict=True)], pa.float64())],
                names=[*keep, "n_signs", "best", "entropy", "lead"])
    return kept.mapInArrow(score, f"{schema}, {arrow_out}")


def identify(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", rejects_above: float = 4.0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, cross_entropy, rejected), one row per input row.

    Learns from rows that are not ``held_out`` and have a language and a text, predicts every
    row from its text alone.  ``lang_pred``: a learned language, or ``und`` where the text is
    null or has no letter (or nothing could be learned); equal cross-entropies go to the first
    language in code point order.  ``score``: share of right answers among learning rows
    whose lead over the second language fell into the same bin, made monotone, smoothed.
    ``rejected``: und, or the cross-entropy is more than ``rejects_above`` standard deviations
    above its language's mean over the learning rows.  Very long texts are taken whole, in
    batches cut by bytes.  Repeated rows and null ids are kept; other columns are not read.
    Empty table: no rows.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                     F.coalesce(held_out, F.lit(False)).alias("held_out"),
                     F.when(~F.coalesce(held_out, F.lit(False)), F.col(lang_col)).alias("lang"))
    table = Table(rows.filter(~F.col("held_out")).select("lang", "text"))
    keep = ["doc_id", "held_out", "lang"]
    found = entropies_in_blocks(rows, table, keep) if len(table.blocks()) > 1 else entropies(rows, table.models(), keep)
    # signs per nat of lead: the evidence grows with the text
    scored = materialize(found, "entropies").withColumn(
        "bin", F.least(F.lit(BINS - 1), F.floor(F.log1p(F.col("lead") * F.col("n_signs")) * 4)).cast("int"))
    own = scored.filter(F.col("lang").isNotNull() & F.col("best").isNotNull())
    bins = {r["bin"]: (r["n"], r["ok"]) for r in own.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("best") == F.col("lang")).alias("ok")).collect()}
    score, shares = 0.0, []
    for b in range(BINS):
        n, ok = bins.get(b, (0, 0))
        score = max(score, (ok + 1) / (n + 2))
        shares.append((b, score))
    limits = {r["best"]: r["m"] + rejects_above * (r["s"] or 0.0) for r in own.groupBy("best").agg(
        F.avg("entropy").alias("m"), F.stddev("entropy").alias("s")).collect()}
    limit = F.lit(None).cast("double")
    for lang, x in limits.items():
        limit = F.when(F.col("best") == lang, F.lit(x)).otherwise(limit)
    by_bin = F.array(*(F.lit(float(s)) for _, s in shares))
    return scored.select(
        "doc_id", "held_out", F.coalesce("best", F.lit("und")).alias("lang_pred"),
        F.when(F.col("best").isNull(), F.lit(0.0)).otherwise(F.get(by_bin, F.col("bin"))).alias("score"), F.col("entropy").alias("cross_entropy"),
        F.coalesce(F.col("entropy") > limit, F.col("best").isNull()).alias("rejected"))
