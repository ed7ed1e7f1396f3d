"""Collocations against plain counting, and their SQL."""
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from curata.llm import collocations as module
from curata.llm.collocations import chunks_of, collocations, pieces_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, lang string, text string"


def brute(rows, max_words=3, min_count=10, top=2000, inside=50):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, max_words + 1):
                    if i + m <= len(w):
                        f[lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        dropped = {g[i:j] for g, a in cand.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1)
                   if j - i < len(g) and 100 * a >= inside * c[g[i:j]]}
        rows_ = []
        for g, a in cand.items():
            score, _, l, r = min((1000000 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
            if g not in dropped:
                rows_.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in collocations(df, **kw).collect())


def made_rows(seed=1, n=120):
    rng = np.random.default_rng(seed)
    words = [*"abcdefghij", "new", "York", "NEW", "city", "Ünï", " x", "日本"]
    out = []
    for i in range(n):
        w = rng.choice(words, size=rng.integers(0, 60))
        text = "".join(x + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n"], p=[.7, .05, .05, .08, .05, .05, .02]) for x in w)
        out.append((i, ["en", "de", None, "und"][i % 4], text + " in new york city today"))
    out += [(1000, "en", "run " * 3000), (1001, "en", None), (1002, None, ""), (1003, "xx", "only a few"), (None, "en", "a b c " * 50)]
    return out + [out[5]] * 20


def test_same_as_brute_force(spark):
    rows = made_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    plain = [r[1:] for r in rows]
    assert got(df) == brute(plain) and len(brute(plain)) > 50
    assert got(df, max_words=4, min_count=3, top=25, inside_percent=80) == brute(plain, 4, 3, 25, 80)
    assert got(df, max_words=2) == brute(plain, 2)


def test_flushes_do_not_change_counts(spark, monkeypatch):
    rows = made_rows(seed=2, n=30)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    monkeypatch.setattr(module, "PARTS", 1)
    monkeypatch.setattr(module, "HELD", 7)
    monkeypatch.setattr(module, "GATHERED", 500)
    assert got(df) == brute([r[1:] for r in rows])


def test_full_filter_lets_everything_through_and_changes_nothing(spark):
    rows = made_rows(seed=4, n=60)
    texts = spark.createDataFrame([("und" if r[1] is None else r[1], r[2]) for r in rows], "lang string, text string")
    chunks = module.dictionary(texts, 4)
    a, b = (sorted(tuple(r) for r in module.frequent_ngrams(chunks, 4, 3, bits).collect()) for bits in (64, 1 << 16))
    assert a == b and {r[1] for r in a} == {1, 2, 3, 4}
    pairs = module.ngram_counts(chunks, 2, None)
    fewer = module.ngram_counts(chunks, 2, module.gram_filter(
        module.ngram_counts(chunks, 1, None).filter("f >= 3"), 1, 1 << 16))
    assert fewer.count() < pairs.count()


def test_hostile_table(hostile, hostile_rows, no_rows):
    rows = [(r[2], r[1]) for r in hostile_rows]
    assert got(hostile, min_count=2) == brute(rows, min_count=2)
    assert got(no_rows) == []


def test_scores_beyond_64_bits(spark):
    """a * a * 1000000 passes 2^63 from three million occurrences on; here by the same formula on a small table of counts."""
    df = spark.range(1).selectExpr("cast(3000000000000 as long) a", "cast(3000000000001 as long) l", "cast(3000000000007 as long) r")
    up, down = "cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(16,0))", "cast(l as decimal(16,0)) * cast(r as decimal(16,0))"
    assert df.selectExpr(f"({up}) div ({down}) s").first()["s"] == 1000000 * 3000000000000 ** 2 // (3000000000001 * 3000000000007)


def test_chunks_cover_every_ngram_once():
    rng = np.random.default_rng(0)
    triggers = {f"w{i}".encode(): i % 3 == 0 for i in range(10)}
    for _ in range(200):
        words = [f"w{i}".encode() for i in rng.integers(0, 10, size=rng.integers(1, 40))]
        for n in (1, 2, 3, 4):
            seen = Counter()
            for own, chunk in chunks_of(words, triggers, n):
                seen.update(tuple(chunk[i:i + m]) for i in range(own) for m in range(1, n + 1) if i + m <= len(chunk))
            assert seen == Counter(tuple(words[i:i + m]) for m in range(1, n + 1) for i in range(len(words) - m + 1))


def test_a_passage_is_cut_alike_wherever_it_stands():
    words = [f"w{i * i % 997}".encode() for i in range(300)]
    triggers = module._Triggers()
    alone = {b" ".join(c) for _, c in chunks_of(words, triggers, 3)}
    moved = {b" ".join(c) for _, c in chunks_of([b"x"] * 11 + words + [b"y"] * 5, triggers, 3)}
    assert len(alone - moved) <= 2 and len(alone) > 5


class Asked(dict):
    """Triggers that note each question."""
    def __init__(self):
        super().__init__()
        self.asked = Counter()

    def __getitem__(self, word):
        self.asked[word] += 1
        return module._Triggers()[word]


def test_blocks_are_cut_as_their_pieces_and_ask_once_a_word():
    rng = np.random.default_rng(3)
    words = ["a", "B", "ab", "abcdefg", "abcdefgh", "abcdefghi", "abcdefgh" * 3, "Ünï", "日本", "x\x00", "x", *(f"w{i}" for i in range(40))]
    for _ in range(40):
        text = "".join(w + rng.choice([" ", "\t ", ".", "\n\n", " , ", "\r\n", "\x0b"], p=[.7, .1, .05, .05, .04, .03, .03])
                       for w in rng.choice(words, size=rng.integers(0, 400)))
        block = (text + "\n").encode().lower().translate(module.ENDS)
        for n in (1, 2, 3, 5):
            asked = Asked()
            place, own, chunk = module.cut_block(block, asked, n)
            assert list(zip(own, chunk, strict=True)) == [
                (k, b" ".join(c)) for words_ in pieces_of(text) for k, c in chunks_of(words_, module._Triggers(), n)]
            assert max(asked.asked.values(), default=1) == 1
            assert all(block[p:p + 1] not in (b" ", b"\n") for p in place) and sorted(place) == list(place)
    assert module.cut_block(b" \n \n", {}, 3)[1:] == ([], [])


def test_small_blocks_do_not_change_counts(spark, monkeypatch):
    rows = made_rows(seed=5, n=60)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    monkeypatch.setattr(module, "BLOCK", 40)
    assert got(df, min_count=5) == brute([r[1:] for r in rows], min_count=5)


def test_words_are_numbered_exactly():
    text = b"a \x00 a\x00 a abcdefgh abcdefghi abcdefgh \xc3\xbc a "
    flat = np.frombuffer(text, np.uint8)
    numbers, words = module._words(flat, np.flatnonzero(flat == 32))
    assert [module._bytes(words)[i] for i in numbers] == text.split() and len(words) == len(set(text.split()))


def test_pieces():
    assert list(pieces_of("A b\tÉ.c;;d\x0be f, \n!")) == [[b"a", b"b", "É".encode()], [b"c"], [b"d"], ["e f".encode()]]
    assert list(pieces_of(None)) == list(pieces_of("")) == []


def test_query_equals_its_sql(spark, sf):
    from curata.llm.oracles import ORACLES
    from curata.llm.queries import queries
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(ORACLES["op13_collocations"])
    cols = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    out = queries()["op13_collocations"](spark, sf)
    assert sorted(tuple(r) for r in out.select(*cols).collect()) == want and len(want) > 20
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text")
    assert got(spark.read.parquet(f"{sf}/documents.parquet")) == brute([tuple(r) for r in docs.collect()])
