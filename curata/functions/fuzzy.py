"""Token-sort similarity (Indel / LCS based) and best-choice scoring.

``token_sort_ratio(a, b)`` = 100 * (1 - indel(a', b') / (len a' + len b')),
where ``x'`` is ``x`` split on whitespace, tokens sorted, joined by one space,
and ``indel = len a' + len b' - 2 * LCS``.  It is case-sensitive and is not a
Levenshtein ratio.  LCS uses the bit-parallel recurrence on Python integers.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def sort_tokens(s: str) -> str:
    return " ".join(sorted(s.split()))


def lcs_length(a: str, b: str) -> int:
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio_sorted(a: str, b: str) -> float:
    total = len(a) + len(b)
    if total == 0:
        return 100.0
    dist = total - 2 * lcs_length(a, b)
    return (1.0 - dist / total) * 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio_sorted(sort_tokens(a), sort_tokens(b))


def best_match(name: str, prepared: list[str]):
    """(index, score) of the first highest-scoring choice; lossless length pruning."""
    q = sort_tokens(name)
    lq = len(q)
    best_i, best = -1, -1.0
    for i, c in enumerate(prepared):
        total = lq + len(c)
        if total and best >= 0 and (1.0 - (total - 2 * min(lq, len(c))) / total) * 100.0 <= best:
            continue  # even a perfect LCS could not beat (or displace) the current best
        sc = ratio_sorted(q, c)
        if sc > best:
            best_i, best = i, sc
    return best_i, best


def best_match_udf(choices: list[str], memo_size: int = 65536):
    """pandas UDF: (name, wanted) -> struct(idx int, score double) over a bounded choice list.

    Rows with ``wanted`` false get null without scoring.  Scores are memoised
    per task (bounded), so a name repeated across many rows is scored once.
    """
    prepared = [sort_tokens(c) for c in choices]
    memo: dict[str, tuple[int, float]] = {}

    @pandas_udf(T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    def _best(names: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        idx, score = [], []
        for n, w in zip(names, wanted):
            if n is None or not w or not prepared:
                idx.append(None)
                score.append(None)
                continue
            hit = memo.get(n)
            if hit is None:
                if len(memo) >= memo_size:
                    memo.clear()
                hit = memo[n] = best_match(n, prepared)
            idx.append(hit[0])
            score.append(hit[1])
        return pd.DataFrame({"idx": pd.array(idx, dtype="Int32"), "score": pd.array(score, dtype="Float64")})
    return _best
