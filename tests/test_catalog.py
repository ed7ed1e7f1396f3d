"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import os

import duckdb
import pytest

from curata.plans.catalog import oracle_sql, queries
from curata.plans.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(r[i]) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert _norm(got, df.columns) == _norm(cur.fetchall(), cols)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() >= 0
