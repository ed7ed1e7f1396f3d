"""Operator 7: probabilities against a plain Kneser-Ney, held-out accuracy, defined edge cases."""
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from curata.llm.language_id import encoded, identify, train


def plain_model(texts, order=4):
    """log p(sign | context) by the textbook formulas, per order, from dictionaries."""
    grams = Counter()
    for t in texts:
        s = "\0\0\0 " + t + " "
        for i in range(4, len(s)):
            grams[s[i - 3:i + 1]] += 1
    counts = {order: grams}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    signs = len(counts[1]) + 1

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / signs
        c = counts[n]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = (n1 + .5) / (n1 + 2 * n2 + 1)
        total = sum(v for k, v in c.items() if k[:-1] == g[:-1])
        kinds = sum(1 for k in c if k[:-1] == g[:-1])
        if not total:
            return p(g[1:])
        return max(c[g] - d, 0) / total + d * kinds / total * p(g[1:])
    return p


def test_probabilities_are_kneser_neys(spark):
    texts = ["abra cadabra", "banana band", "cab"]
    models = train(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    p = plain_model(texts)
    keys, _, n = encoded(["abracadabra zab", "nab"])
    s = ["\0\0\0 abracadabra zab ", "\0\0\0 nab "]
    want = [math.log(p(x[i - 3:i + 1])) for x in s for i in range(4, len(x))]
    assert n.sum() == len(want)
    assert np.allclose(models.log_p("x", keys), want, atol=1e-5)


def test_held_out_accuracy(spark, documents):
    out = identify(documents, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    rows = out.join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == documents.count() and len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_uses_the_text_alone(spark):
    rows = [(i, "der die das und nicht ein", "de") for i in range(8)] + [(i, "the and of to in is", "en") for i in range(8, 16)]
    rows += [(16, "und die das", "en"), (17, "of the", "de"), (18, "123 !?", "en"), (19, None, "en"), (20, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(df, F.col("doc_id") >= 16).collect()}
    assert (got[16].lang_pred, got[17].lang_pred) == ("de", "en")
    assert {got[i].lang_pred for i in (18, 19, 20)} == {"und"} and got[19].score == 0 and got[18].rejected


def test_whole_texts_are_counted(spark):
    models = train(spark.createDataFrame([("x", "ab " * 40000 + "zq"), ("y", "cd")], "lang string, text string"))
    assert models.langs == ["x", "y"] and ord("q") in models.arrays["x", 1, "p"][0]


def test_hostile_and_empty(hostile, hostile_rows, no_rows):
    out = identify(hostile, F.col("doc_id") % 4 == 2).collect()
    assert len(out) == len(hostile_rows)
    assert all((r.lang_pred == "und") == (r.doc_id in (0, 1, 2)) for r in out)
    assert identify(no_rows, F.lit(False)).collect() == []


def test_signs_that_are_no_letters_are_undetermined(spark):
    rows = [(i, "der die das und nicht ein", "de") for i in range(8)] + [(8 + i, t, None) for i, t in enumerate(["½ ¾ ²", "①", "Ⅷ 7"])]
    got = {r.doc_id: r.lang_pred for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                                                   F.lit(False)).collect()}
    assert [got[i] for i in (8, 9, 10)] == ["und"] * 3 and got[0] == "de"
