"""Operator 5 against all pairs of exact sets."""
import random
import re

from curata.llm.jaccard_join import jaccard_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall((text or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))


def brute(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    sets = [(r[0], shingle_set(r[1])) for r in rows if r[0] is not None]
    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    out = sorted((((r[0] is None), r[0] or 0, len(shingle_set(r[1])),
                   None if r[0] is None else root(r[0]) if shingle_set(r[1]) else r[0]) for r in rows))
    return out


def got(df):
    return sorted(((r[0] is None), r[0] or 0, r.n_shingles, r.component_id) for r in jaccard_components(df).collect())


def test_documents(documents, document_rows):
    assert got(documents) == brute(document_rows)


def test_hostile_and_empty(hostile, hostile_rows, no_rows):
    assert got(hostile) == brute(hostile_rows)
    assert jaccard_components(no_rows).collect() == []


def test_groups_of_edited_copies_chains_and_shared_passages(spark):
    """Copies at every distance around the threshold, chains, small sets, a passage in half of the rows."""
    rnd = random.Random(5)
    vocabulary = [f"v{i}" for i in range(4000)]
    passage = rnd.choices(vocabulary, k=60)
    rows = []
    for n in (4, 5, 6, 7, 8, 9, 11, 14, 20, 40, 90, 200):
        base = rnd.choices(vocabulary, k=n)
        for _ in range(9):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, n // 25))):
                w[rnd.randrange(n)] = rnd.choice(vocabulary)
            rows.append(" ".join(w))
        w = list(base)
        for _ in range(8):  # each a little further away
            w = w[1:] + [rnd.choice(vocabulary)]
            rows.append(" ".join(w))
    rows += [" ".join(passage + rnd.choices(vocabulary, k=rnd.randint(1, 80))) for _ in range(90)]
    rnd.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_ids_with_several_texts_tie_their_components(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = [(9, a), (9, b), (5, a), (3, b), (3, b), (7, "x"), (7, None)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(
        (False, i, n, c) for i, n, c in [(9, 5, 3), (9, 5, 3), (5, 5, 3), (3, 5, 3), (3, 5, 3), (7, 1, 7), (7, 0, 7)])


def test_string_ids(spark, document_rows):
    rows = [(f"d{r[0]:06d}", r[1]) for r in document_rows]
    want = sorted((f"d{i:06d}", n, f"d{c:06d}") for _, i, n, c in brute([(r[0], r[1]) for r in document_rows]))
    df = spark.createDataFrame(rows + [(None, "a b c d e")], "doc_id string, text string")
    assert sorted(tuple(r) for r in jaccard_components(df).collect() if r[0]) == want


def test_working_tables_are_removed(spark, documents):
    import os
    from curata.session import checkpoint_dir
    folder = os.path.join(checkpoint_dir(spark), "llm")
    jaccard_components(documents, width=5, percent=80).count()
    assert not [f for f in os.listdir(folder) if f.startswith("jaccard-")]
