"""Fixtures shared by the operator tests: a hostile little documents table."""
import os

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, h long, kept string"


def _rows():
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    prose = "the quick brown fox jumps over the lazy dog and runs away from the old bear in the wood. " * 4
    texts = [None, "", "   \n\t ", "one", "one two", "a b c d", "Ünïcödé wörds çà et là 日本語 テスト",
             long_text, long_text, prose, prose, prose.upper(), "### $$$ <|im_end|> %%% ||| " * 30,
             "same line here\nsame line here\nother\nsame line here\n\n\n",
             "call (212) 555-0100 or a.b@mail.example.com at 10.0.0.1, 4111 1111 1111 1111 on 1999-12-31.",
             "Released under the MIT License.", "x" * 5000, "1234 5678 9012 3456 not a card 4111111111111112"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, None, "clash", i, "clash")
            for i, t in enumerate(texts)]
    rows += [(None, "null id text " * 20, None, None, 1, None, None, None), rows[9], rows[9], rows[0]]
    return rows


@pytest.fixture(scope="session")
def hostile(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="session")
def hostile_rows():
    return _rows()


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return SF


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return [tuple(r) for r in documents.collect()]
