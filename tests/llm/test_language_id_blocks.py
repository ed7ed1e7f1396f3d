"""Operator 7 with a model cut into blocks: the full order is kept and nothing changes."""
import numpy as np
from pyspark.sql import functions as F

from curata.llm import language_id
from curata.llm.language_id import Table, encoded, identify


def by_id(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.rejected, r.held_out), r.cross_entropy, r.score)
                  for r in df.collect())


def same(a, b):
    assert [x[0] for x in a] == [x[0] for x in b] and len(a) > 5
    for i in (1, 2):
        assert np.allclose([np.nan if x[i] is None else x[i] for x in a], [np.nan if x[i] is None else x[i] for x in b],
                           atol=1e-9, equal_nan=True)


def test_blocks_change_no_result(spark, documents, monkeypatch):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    whole = by_id(identify(documents, fold))
    monkeypatch.setattr(language_id, "MAX_ENTRIES", 5000)
    same(by_id(identify(documents, fold)), whole)


def test_hostile_rows_in_blocks(spark, hostile, monkeypatch):
    whole = by_id(identify(hostile, F.col("doc_id") % 4 == 2))
    monkeypatch.setattr(language_id, "MAX_ENTRIES", 300)
    same(by_id(identify(hostile, F.col("doc_id") % 4 == 2)), whole)


def test_blocks_are_bounded_and_cover_every_gram(spark, monkeypatch):
    texts = [("x", "abra cadabra banana"), ("y", "der die das und nicht"), ("y", "日本語 テスト")]
    table = Table(spark.createDataFrame(texts, "lang string, text string"))
    assert table.blocks() == [(0, 2 * 65536 - 1)] and table.models().order == 4
    whole, most = table.models(), 40
    monkeypatch.setattr(language_id, "MAX_ENTRIES", most)
    parts = [(a, b, table.models(a, b)) for a, b in table.blocks()]
    assert len(parts) > 2 and parts[0][0] == 0 and all(p[1] + 1 == q[0] for p, q in zip(parts, parts[1:], strict=False))
    keys = np.unique(encoded(["abracadabra zab", "die nacht 日本 qq", "cab"])[0])
    sign = ((keys >> np.uint64(16)) & np.uint64(65535)).astype(np.int64)
    for i, lang in enumerate(table.langs):
        got = np.full(len(keys), np.nan)
        for a, b, m in parts:
            own = (i * 65536 + sign >= a) & (i * 65536 + sign <= b)
            got[own] = m.log_p(lang, keys[own])
        assert np.allclose(got, whole.log_p(lang, keys), atol=1e-12)
