"""Operator 1, quality rules: weak supervision over rules that vote or abstain.

Rules look at a text and vote good (1), bad (-1) or abstain (0).  Rules that look at the
same signal form a family: the model holds one joint table of a family's votes per class,
so that correlated rules do not count twice, and takes families as independent.  The rows
that pass the base are grouped into vote patterns (at most 3^7, whatever the input size) and
expectation-maximisation over that small table estimates the share of good texts and each
family's tables.  The posterior probability of "good" given a row's votes replaces
all-must-pass filtering.  Everything is DataFrame expressions.
"""
from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, let, materialize, words_of

SYMBOLS = "#*$%&|<>"
#: A word with a letter or digit and no sign but punctuation.
PLAIN_WORD = r"^[^\p{S}#%&*]*[\p{L}\p{N}][^\p{S}#%&*]*$"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"


def count_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more in the array.

    Windows are compared by a 64-bit hash.  Most texts have no repeated window and
    stop at the distinct count; the others sort (hash, position) so that equal
    windows become neighbours: n log n, also for one very long repetitive text.
    """
    def marked(hashes: Column) -> Column:
        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                   lambda s: F.size(F.array_distinct(F.flatten(F.transform(
                       F.filter(F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                                           lambda a, b: F.struct((a["h"] == b["h"]).alias("same"),
                                                                 a["i"].alias("x"), b["i"].alias("y"))),
                                lambda t: t["same"]),
                       lambda t: F.array(t["x"], t["x"] + 1, t["x"] + 2, t["y"], t["y"] + 1, t["y"] + 2))))))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(
        let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
            .otherwise(marked(h))))).cast("long")


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts per input row (a null text counts as empty)."""
    base = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (base
            .select("*", words_of(F.col("text")).alias("words"))
            .select("doc_id",
                    F.size("words").cast("long").alias("n_words"),
                    F.length(F.regexp_replace("text", SPACE_RUN, "")).cast("long").alias("word_chars"),
                    count_chars(F.col("text"), SYMBOLS).alias("n_symbols"),
                    let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                                  (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
                    .alias("lines"),
                    repeated_words(F.col("words")).alias("n_repeat_words"),
                    count_chars(F.col("text"), UPPER).alias("n_upper"),
                    count_chars(F.col("text"), ".!?").alias("n_ends"),
                    (F.length("text") - F.length(F.regexp_replace("text", r"\p{L}+", ""))).cast("long").alias("n_letters"),
                    F.size(F.filter("words", lambda w: w.rlike(PLAIN_WORD))).cast("long").alias("n_plain_words"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", F.col("lines.dup").alias("n_dup_lines"),
                    "n_repeat_words", F.col("lines.n_lines").alias("n_lines"), "n_upper", "n_ends", "n_letters",
                    "n_plain_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


#: Rules by signal.  Word counts and repeated windows have no rule: the base decides on them.
FAMILIES = {"signs": ("symbols", "letters"), "wordlike": ("plain_words",), "capitals": ("capitals",),
            "dup_lines": ("dup_lines",), "word_length": ("word_length",), "sentences": ("sentences",)}


def votes() -> dict[str, Column]:
    """The rules, over the columns of :func:`measures`; no words: every ratio rule abstains."""
    n, c = F.col("n_words"), F.col
    some = n > 0

    def ratio(bad: Column, good: Column) -> Column:
        return F.when(some, _vote(bad, good)).otherwise(0)
    return {
        "symbols": ratio(c("n_symbols") * 10 > n, c("n_symbols") * 50 <= n),
        "letters": ratio(c("n_letters") * 10 < c("word_chars") * 8, c("n_letters") * 10 >= c("word_chars") * 9),
        "plain_words": ratio(c("n_plain_words") * 10 < n * 8, c("n_plain_words") * 10 >= n * 9),
        "capitals": ratio(c("n_upper") * 10 > c("word_chars") * 3, c("n_upper") * 10 < c("word_chars")),
        "dup_lines": F.when(c("n_lines") > 1, _vote(c("n_dup_lines") * 10 > c("n_lines") * 3, c("n_dup_lines") == 0))
        .otherwise(0),
        "word_length": ratio((c("word_chars") < n * 2) | (c("word_chars") > n * 15),
                             c("word_chars").between(n * 3, n * 10)),
        "sentences": F.when(n >= 20, _vote((c("n_ends") * 2 > n) | (c("n_ends") * 100 < n), c("n_ends") * 40 >= n))
        .otherwise(0),
    }


@dataclass(frozen=True)
class Fit:
    """Share of good rows; per family and pattern of its votes (all abstain left out), P(pattern | good)
    and P(pattern | bad)."""
    share: float
    families: dict[str, tuple[str, ...]]
    tables: dict[str, dict[tuple[int, ...], tuple[float, float]]]

    def _right(self, vote: int) -> dict[str, float]:
        out = {}
        for name, rules in self.families.items():
            for i, rule in enumerate(rules):
                of = [(p[i] == vote, pair[vote == -1]) for p, pair in self.tables[name].items() if p[i]]
                out[rule] = sum(x for hit, x in of if hit) / sum(x for _, x in of)
        return out

    @property
    def right_on_good(self) -> dict[str, float]:
        """P(a rule votes good | good), given that it votes."""
        return self._right(1)

    @property
    def right_on_bad(self) -> dict[str, float]:
        """P(a rule votes bad | bad), given that it votes."""
        return self._right(-1)

    def useful(self, margin: float = 0.1) -> set[str]:
        """Families with a rule that tells the classes apart the way its votes say; the others carry no weight."""
        g, b = self.right_on_good, self.right_on_bad
        return {name for name, rules in self.families.items() if any(g[r] + b[r] - 1 >= margin for r in rules)}


def _start(families: dict[str, tuple[str, ...]]) -> Fit:
    """Half of the rows good, each family right four times in five, whatever the number of its rules."""
    def pair(p: tuple[int, ...]) -> tuple[float, float]:
        odds = 4.0 ** (sum(p) / sum(map(abs, p)))
        return odds / (1 + odds), 1 / (1 + odds)
    return Fit(0.5, families, {name: {p: pair(p) for p in itertools.product((1, 0, -1), repeat=len(rules)) if any(p)}
                               for name, rules in families.items()})


def _is(rules: tuple[str, ...], pattern: tuple[int, ...]) -> Column:
    out = F.lit(True)
    for rule, vote in zip(rules, pattern, strict=True):
        out = out & (F.col(rule) == vote)
    return out


def _log_odds(fit: Fit) -> Column:
    out = F.lit(0.0) + F.log(F.lit(fit.share) / F.lit(1 - fit.share))
    for name in sorted(fit.useful()):
        term = F.lit(0.0)
        for p, (g, b) in fit.tables[name].items():
            term = F.when(_is(fit.families[name], p), F.log(F.lit(g) / F.lit(b))).otherwise(term)
        out = out + term
    return out


def posterior(fit: Fit) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_log_odds(fit)))


def expectation_maximisation(patterns: DataFrame, rules: list[str] | dict[str, tuple[str, ...]], iterations: int = 20,
                             tolerance: float = 1e-4, smoothing: float = 1.0) -> Fit:
    """``patterns``: one row per vote pattern with its row count ``n``; ``rules``: the families, or
    a list of rules of a family each.

    Starts from families that are right four times in five.  No accuracy is bounded from below:
    what a family that does not tell the classes apart says has no weight (:meth:`Fit.useful`).
    If fewer than two families do, nothing in the votes speaks for two kinds of texts and the
    start stands.  Each step is one aggregate over the pattern table; only its sums come back.
    An empty table leaves the start values.
    """
    families = rules if isinstance(rules, dict) else {r: (r,) for r in rules}
    start = fit = _start(families)
    s = smoothing
    cells = [(name, p) for name, table in start.tables.items() for p in table]
    for _ in range(iterations):
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n).alias("n"), F.sum(n * p).alias("good")]
        for k, (name, votes_) in enumerate(cells):
            hit = _is(families[name], votes_)
            sums += [F.sum(F.when(hit, n * p).otherwise(0.0)).alias(f"g{k}"),
                     F.sum(F.when(hit, n * (1 - p)).otherwise(0.0)).alias(f"b{k}")]
        got = patterns.withColumn("p", posterior(fit)).agg(*sums).first()
        if not got["n"]:
            return start
        tables = {name: {} for name in families}
        for k, (name, votes_) in enumerate(cells):
            tables[name][votes_] = tuple(got[f"{c}{k}"] + s * x for c, x in
                                         zip("gb", start.tables[name][votes_], strict=True))
        for name, table in tables.items():
            total = [sum(pair[c] for pair in table.values()) for c in (0, 1)]
            tables[name] = {v: (pair[0] / total[0], pair[1] / total[1]) for v, pair in table.items()}
        new = Fit(min(0.999, max(0.001, (got["good"] + s) / (got["n"] + 2 * s))), families, tables)
        moved = max(abs(new.share - fit.share), *(abs(x - y) for name, v in cells for x, y in
                                                  zip(tables[name][v], fit.tables[name][v], strict=True)))
        fit = new
        if moved < tolerance:
            break
    return fit if len(fit.useful()) > 1 else start


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = 0.5) -> DataFrame:
    """Counts, votes' posterior and verdict, one row per input row.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated
    3-word windows.  ``kept``: not base_failed and posterior of "good" >= ``keep_from``;
    the model is fitted on the rows that pass the base, every row of them.
    Null or empty text: no words, so base_failed.  Null ids and repeated rows are kept
    as they are, one result row each.  Other columns of ``df`` are not read, so their
    names cannot clash.  Empty table: no rows.
    """
    n = F.col("n_words")
    rows = materialize(measures(df, id_col, text_col).select(
        "*", ((n < 50) | (F.col("n_repeat_words") * 100 > n * 50)).alias("base_failed"),
        *(v.alias(k) for k, v in votes().items())), "quality")
    patterns = materialize(rows.filter(~F.col("base_failed")).groupBy(*votes()).agg(F.count(F.lit(1)).alias("n")),
                           "patterns").coalesce(1)
    fit = expectation_maximisation(patterns, FAMILIES)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round(posterior(fit), 9).alias("p_good"),
    ).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             (~F.col("base_failed") & (F.col("p_good") >= keep_from)).alias("kept"), "p_good")
