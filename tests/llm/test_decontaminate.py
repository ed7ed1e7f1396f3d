"""Operator 6 against a plain edit-distance search of every item in every text."""
import random

from curata.llm import decontaminate
from curata.llm.decontaminate import banded_edits, find_leaks, normal

LETTERS = "abcdefghijklmnopqrst "


def best_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def some_text(rnd, n):
    return "".join(rnd.choice(LETTERS) for _ in range(n))


def edited(rnd, s, k):
    s = list(s)
    for _ in range(k):
        i, how = rnd.randrange(len(s)), rnd.random()
        if how < 0.4:
            s[i] = rnd.choice(LETTERS)
        elif how < 0.7:
            del s[i]
        else:
            s.insert(i, rnd.choice(LETTERS))
    return "".join(s)


def got(docs, items):
    return {(r.doc_id, r.item_id): r.edits for r in find_leaks(docs, items).collect()}


def test_every_edit_distance_around_the_budget(spark, monkeypatch):
    rnd = random.Random(3)
    items = [(i, some_text(rnd, n)) for i, n in enumerate((9, 16, 30, 60, 100, 150))]
    docs = []
    for i, t in items:
        for k in range(0, int(0.08 * len(t)) + 4):
            docs.append((len(docs), some_text(rnd, rnd.randint(0, 60)) + edited(rnd, t, k) + some_text(rnd, 40)))
    docs += [(len(docs), items[4][1] + items[5][1]), (len(docs) + 1, some_text(rnd, 500)), (len(docs) + 2, None),
             (len(docs) + 3, "")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in items:
        p = normal(t)
        k = min(int(len(p) * 0.08), max(0, (len(p) - 8) // 8))
        for j, x in docs:
            e = best_edits(p, normal(x))
            if e <= k:
                want[j, i] = e
    assert got(d, b) == want and len(want) > 15
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)  # several passes
    assert got(d, b) == want


def test_alignment_equals_the_full_table():
    rnd = random.Random(4)
    for _ in range(60):
        p = some_text(rnd, rnd.randint(8, 40)).encode()
        t = some_text(rnd, 12).encode() + edited(rnd, p.decode(), rnd.randint(0, 3)).encode() + b"zzzzzzzz"
        full = best_edits(p, t)
        if full <= 6:
            assert banded_edits(p, t, 6) == full


def test_documents_find_verbatim_items_and_nothing_else(spark, documents, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = got(documents, items)
    bench = {r.item_id: normal(r.text) for r in items.collect()}
    texts = {r.doc_id: normal(r.text) for r in documents.collect()}
    exact = {(d, i) for d, t in texts.items() for i, p in bench.items() if p in t}
    assert exact <= set(found) and exact
    for (d, i), e in found.items():
        assert e <= 0.08 * len(bench[i])


def test_hostile_and_empty(spark, hostile, no_rows):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, "x"), (4, "")],
                                  "item_id long, text string")
    rows = find_leaks(hostile, items).collect()
    assert sorted(r.doc_id for r in rows) == [9, 9, 9, 10, 11] and {r.item_id for r in rows} == {1}
    assert find_leaks(no_rows, items).collect() == []
    assert find_leaks(hostile, items.limit(0)).collect() == []
