"""Line dedup against a plain dictionary of lines, and its SQL."""
import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from curata.llm.line_dedup import common_lines, dedup_lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_documents=5):
    def key(line):
        return line.strip(SPACE).translate(LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_documents
                or doc == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in dedup_lines(df, **kw).collect()), key=repr)


LINE = "This line is Boilerplate that Ünïcode readers find in Every document"


def made_rows():
    rows = [(i, f"own {i}\n  {LINE} \t\n\nend\n{LINE.upper() if i % 2 else LINE}") for i in range(6)]
    rows += [(7, "four holders of this line are not enough, so it stays put\nx")] * 2
    rows += [(i, "four holders of this line are not enough, so it stays put") for i in (8, 9, 10)]
    rows += [(None, f"{LINE}\nnull id"), (None, None), (11, ""), (12, None), (13, "\n\n"), (5, LINE), (5, f"{LINE}\nagain")]
    rows += [(20 + i, "é" * 39 + "\n" + "é" * 40) for i in range(5)]
    rows += [(30, "\n".join(f"{LINE}{k % 50}" for k in range(5000)))] + [(31 + i, "\n".join(f"{LINE}{k}" for k in range(50))) for i in range(4)]
    rows += [(40 + i, "one line alone, which makes the whole of six documents") for i in range(6)]
    return rows


def test_same_as_brute_force(spark):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == brute(rows)
    assert got(df, min_chars=5, min_documents=2) == brute(rows, 5, 2)


def test_hostile_table(hostile, hostile_rows, no_rows):
    rows = [(r[0], r[1]) for r in hostile_rows]
    assert got(hostile, min_chars=3, min_documents=2) == brute(rows, 3, 2)
    assert got(no_rows) == [] and common_lines(no_rows).count() == 0


def test_string_ids(spark):
    rows = [(str(i) if i else None, t) for i, t in made_rows()]
    assert got(spark.createDataFrame(rows, "name string, body string"), id_col="name", text_col="body") == brute(rows)


def test_query_equals_its_sql_and_brute_force(spark, sf):
    from curata.llm.oracles import ORACLES
    from curata.llm.queries import queries
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cur = con.execute(ORACLES["op12_line_dedup"])
    cols = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    out = queries()["op12_line_dedup"](spark, sf)
    assert sorted(tuple(r) for r in out.select(*cols).collect()) == want
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in
             brute([tuple(r) for r in docs.select("doc_id", "text").collect()])]
    assert sorted(plain) == want and sum(r[2] for r in want) > 0


def test_counting_is_pre_aggregated_and_texts_are_exchanged_once(spark):
    df = spark.createDataFrame(made_rows(), "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = dedup_lines(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    carrying = [x for x in plan.splitlines() if "Exchange" in x]
    assert len(carrying) == 4  # lines and common keys by hash, positions and texts by row
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("text,n", [(None, 1), ("", 1), ("a", 1), ("a\n", 2), ("\n", 2), ("a\r\nb", 2)])
def test_lines(spark, text, n):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert got(df) == [(1, n, 0, text or "")]
    assert df.select(F.lit(1)).count() == 1
