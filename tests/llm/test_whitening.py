"""Whitening against exact fractions and LAPACK's eigenvectors."""
import math
from fractions import Fraction

import numpy as np
import pytest

from curata.llm.whitening import fit_whitening, integer_vectors, one_sided_jacobi, pivoted_cholesky, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows):
    out = []
    for vec_id, v, *_ in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in v]))
    return out


def brute(rows, k=4):
    """Everything exact up to the eigenvectors."""
    kept = usable(rows)
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    v = [[float(sum(Fraction(n * x[i] - s[i], n) * Fraction(n * x[j] - s[j], n) for x in fit) / n) for j in range(d)]
         for i in range(d)]
    e, u = np.linalg.eigh(np.array(v))
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for vec_id, x in kept:
        y = np.array([float(Fraction(n * x[i] - s[i], n)) for i in range(d)])
        for c in range(k):
            out.setdefault((vec_id, c + 1), []).append(
                (n, sum((n * x[i] - s[i]) ** 2 for i in range(d)), float(y @ u[:, c] / math.sqrt(e[c])), e[c] / np.trace(v)))
    return out


def check(df, rows, k=4):
    want = brute(rows, k)
    got = whiten(df, k).collect()
    assert len(got) == sum(map(len, want.values()))
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        n, deviation, whitened, explained = min(want[r["vec_id"], r["component"]], key=lambda w: abs(abs(w[2]) - abs(r["whitened"])))
        turn = sign.setdefault(r["component"], math.copysign(1, whitened * r["whitened"]))
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(turn * r["whitened"] - whitened) < 1e-9 * max(1, abs(whitened))
        assert abs(r["explained"] / explained - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-9


def made_rows(n=300, d=12, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.linspace(2, 0.3, d) @ rng.normal(size=(d, d)) / 3 + 1.5
    rows = [(i, [float(np.float32(c)) for c in x[i]], 0) for i in range(n)]
    rows += [(n, None, 0), (n + 1, [float("nan")] + [0.0] * (d - 1), 0), (n + 2, [None] + [0.0] * (d - 1), 0),
             (n + 3, [float("inf")] * d, 0), (n + 4, [-0.0] * d, 0), (n + 5, [0.001] * d, 0)]
    return rows + [(n + 10 + i, rows[7][1], 1) for i in range(200)] + [rows[3]] * 3  # a hot vector, repeated rows


def test_same_as_brute_force(spark):
    rows = made_rows()
    check(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


def test_result_does_not_depend_on_how_rows_are_dealt(spark):
    rows = made_rows(d=5)
    one = whiten(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    two = whiten(spark.createDataFrame(rows[::-1], SCHEMA).repartition(9)).collect()
    assert sorted(r[:6] for r in one) == sorted(r[:6] for r in two)


def test_driver_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    want, got = None, whiten(df)
    assert got.count() == 4 * len(rows)
    fit, w = fit_whitening(integer_vectors(df))
    x = np.array(sorted({tuple(x) for _, x in usable(rows)}), float)
    want = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.abs(w.eigenvalues / want - 1).max() < 1e-9 and fit.count() == w.n == len(x)


def test_rank_ties_and_degenerate_tables(spark, no_rows):
    def rows_of(vectors):
        return whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert rows_of([[1.0, 2.0]]) == [] and rows_of([[1.0, 2.0]] * 5) == [] and rows_of([[], []]) == []
    assert rows_of([None, [float("nan")]]) == []
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    line = rows_of([[float(i), 2.0 * i, 5.0] for i in range(10)])
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    square = rows_of([[1.0, 1.0], [1.0, -1.0], [-1.0, 1.0], [-1.0, -1.0]])  # equal eigenvalues
    assert len(square) == 8 and all(abs(r["explained"] - 0.5) < 1e-12 and r["identity_error"] < 1e-12 for r in square)
    mixed = rows_of([[0.0, 1.0], [1.0, 0.0], [2.0, 2.0], [1.0], [1.0, 2.0, 3.0]])
    assert {r["vec_id"] for r in mixed} == {0, 1, 2}
    huge = rows_of([[1e30, 0.0], [-1e30, 1.0], [0.0, 3.0]])
    assert {r["vec_id"] for r in huge} == {0, 1, 2} and any(r["deviation"] is None for r in huge)


def test_null_ids_and_clashing_columns(spark):
    rows = [(None if i % 3 else i, [float(i % 5), float(i % 7)], "clash", i) for i in range(30)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, n int")).collect()
    assert len(got) == 60 and sum(r["vec_id"] is None for r in got) == 40


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (9, 4), (30, 30), (64, 64)])
def test_factor_and_rotations(d, rank):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, rank)) * np.logspace(0, -4, rank)
    v = a @ a.T
    factor = pivoted_cholesky(v)
    assert factor.shape == (d, rank) and np.abs(factor @ factor.T - v).max() < 1e-12 * max(1, np.abs(v).max())
    turned = one_sided_jacobi(factor)
    gram = turned.T @ turned
    norms = np.sqrt(np.diag(gram))
    assert np.abs(gram / np.outer(norms, norms) - np.eye(rank)).max() < 1e-13
    assert np.abs(turned @ turned.T - v).max() < 1e-12 * max(1, np.abs(v).max())
    assert np.allclose(np.sort(norms ** 2)[::-1], np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-6)
