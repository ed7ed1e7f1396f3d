"""Operator 6 on passages of longer items, against the same plain edit-distance search per window."""
import random

from curata.llm import decontaminate
from curata.llm.decontaminate import STRIDE, WINDOW, normal
from test_decontaminate import best_edits, edited, got, some_text


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(rnd.randint(3, 9))) for _ in range(n))


def windows(p):
    return [p[a:a + WINDOW] for a in {*range(0, len(p) - WINDOW, STRIDE), len(p) - WINDOW}] if len(p) > WINDOW else []


def test_passages_of_long_items(spark, monkeypatch):
    rnd = random.Random(5)
    long, middle, short = words(rnd, 400), some_text(rnd, 394).replace(" ", "e"), some_text(rnd, 150).replace(" ", "e")
    items = [(1, long), (2, middle), (3, short)]
    around = lambda x: f"{words(rnd, 30)} {x} {words(rnd, 30)}"
    w = long.split()
    docs = [around(" ".join(w[150:250])),                                   # 100 words of 400
            around(middle[:300]), around(middle[47:347]), around(middle[94:]),  # 300 characters of 394
            around(long[:900] + " " + words(rnd, 60) + " " + long[900:]),       # split by inserted text
            around(edited(rnd, middle[20:280], 9)), around(edited(rnd, middle[20:280], 60)),
            around(middle[:150]), around(short[:100]), around(short), around(long), middle[50:50 + WINDOW + STRIDE - 1]]
    want = {}
    for j, x in enumerate(docs):
        t = normal(x)
        for i, item in items:
            p = normal(item)
            whole = best_edits(p, t) if len(p) < 1000 else 0 if p in t else len(p)
            if whole <= min(int(len(p) * 0.08), (len(p) - 8) // 8):
                want[j, i] = whole
                continue
            part = min((0 if v in t else best_edits(v, t) if i == 2 else WINDOW for v in windows(p)), default=WINDOW)
            if part <= int(WINDOW * 0.08):
                want[j, i] = part
    assert {0, 1, 2, 3, 4, 5, 9, 10, 11} == {j for j, _ in want}
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert got(d, b) == want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)  # several passes
    assert got(d, b) == want


def test_pieces_of_pairs_change_nothing(monkeypatch):
    rnd = random.Random(8)
    passage = words(rnd, 60)
    items = [(i, normal(f"{words(rnd, 20)} {passage} {words(rnd, 20)} the same end of many items " * (1 + i % 3))) for i in range(40)]
    texts = [normal(x) for x in (items[3][1].decode(), f"{words(rnd, 50)} {passage} {passage}", words(rnd, 200), "", passage * 3,
                                 " ".join(i[1].decode() for i in items[5:9]))]
    block = decontaminate.Block(items, 0.08)
    want = sorted(decontaminate.find(texts, block))
    assert len(want) > 80
    for most in (1, 500, 20_000, 100_000):
        monkeypatch.setattr(decontaminate, "MAX_PAIRS", most)
        assert sorted(decontaminate.find(texts, block)) == want
