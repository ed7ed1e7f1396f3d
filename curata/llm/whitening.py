"""Operator 11, embedding whitening: pivoted Cholesky of the centred scatter, then one-sided
Jacobi directly on the triangular factor.

The vectors become integers, and so do all sums over rows: the scatter is gathered around the
integer vector next to the mean, as integer matrix products that doubles hold exactly, and the
rest of the mean (under one half per dimension) is taken off the finished sums.  Results do not
depend on how rows are dealt.  Only numbers by dimension reach the driver: n, the sums, and the
d x d scatter.  There V = L L' (rows of L pivoted, columns only up to the rank), and Jacobi
rotations make the columns of L orthogonal: their squared norms are the eigenvalues of V and
the normalised columns its eigenvectors, small ones as accurate as large ones.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

#: Integers up to here are exact in a double.
EXACT = 1 << 53
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of a table; its size depends on the number of dimensions only."""
    n: int                    # vectors in the fit list
    sums: list[int]           # per dimension
    eigenvalues: np.ndarray   # falling, as many as the rank
    components: np.ndarray    # one unit column per eigenvalue
    trace: float


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, x): floor(scale * entry) of each usable vector; null vectors and vectors with null or
    non-finite entries are left out.  Entries beyond 64 bits end at the largest or smallest long."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & ~F.exists("v", bad)).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in slices(batches, 8 << 20):
            x = _matrix(batch.column(0), d)
            n += len(x)
            small = int(np.abs(x).max(initial=0)) < (1 << 62) // max(1, len(x)) and x.min(initial=0) > -(1 << 62)
            part = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, part, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int32()), pa.array(
                [str(s) for s in (n, *total)], pa.string())], ["at", "s"])
    rows = fit.mapInArrow(run, "at int, s string").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r["at"]: int(r["s"]) for r in rows.collect()}  # one number per dimension
    return got.get(-1, 0), [got.get(i, 0) for i in range(d)]


def _gram(y: np.ndarray) -> np.ndarray:
    """y' y as doubles: exact in steps that 53 bits hold, plain products where no step does."""
    top = float(np.abs(y).max(initial=0)) ** 2
    step = max(1, int(EXACT // top)) if top else max(1, len(y))
    return sum((y[i:i + step].T @ y[i:i + step] for i in range(0, len(y), step)), np.zeros((y.shape[1],) * 2))


def _covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance matrix (divisor n) of the fit list, centred before multiplying."""
    d = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # next to the mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in slices(batches, 8 << 20):
            total += _gram(_matrix(batch.column(0), d).astype(float) - centre)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j, pa.int64()), pa.array(total[i, j])], ["cell", "s"])
    cells = fit.mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).toPandas()  # d x d
    scatter = np.zeros(d * d)
    scatter[cells["cell"]] = cells["s"]
    scatter = scatter.reshape(d, d)
    scatter = np.triu(scatter) + np.triu(scatter, 1).T
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre, strict=True)])
    return scatter / n - np.outer(rest, rest)


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (d x rank) with v = L L'; the largest remaining diagonal entry is taken each time, until
    what remains is rounding error of the largest."""
    d = len(v)
    left = np.diag(v).copy()
    floor = d * EPS * left.max(initial=0)
    out = np.zeros((d, d))
    for k in range(d):
        p = int(left.argmax())
        if left[p] <= floor:
            return out[:, :k]
        column = (v[:, p] - out[:, :k] @ out[p, :k]) / np.sqrt(left[p])
        column[left == -np.inf] = 0  # pivots of earlier steps
        out[:, k] = column
        left -= column ** 2
        left[p] = -np.inf
    return out


def one_sided_jacobi(a: np.ndarray) -> np.ndarray:
    """``a`` with its columns rotated until any two are orthogonal.

    A sweep meets every pair once, in rounds of disjoint pairs; sweeps go on until every cosine
    is rounding error or no longer shrinks."""
    a = a.copy()
    r = a.shape[1]
    order = np.arange(r + r % 2)  # an odd number gets an idle place
    last = np.inf
    while r > 1:
        worst = 0.0
        for _ in range(len(order) - 1):
            p, q = order[:len(order) // 2], order[:len(order) // 2 - 1:-1]
            real = (p < r) & (q < r)
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, float(cosine.max(initial=0)))
            turn = cosine > EPS
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            x, y = x[:, turn], y[:, turn]
            a[:, p[turn]], a[:, q[turn]] = c * x - s * y, s * x + c * y
            order = np.concatenate([order[:1], order[-1:], order[1:-1]])
        if worst <= EPS * np.sqrt(len(a)) or (worst < 1e-12 and worst > last / 2):
            break
        last = worst
    return a


def fit_whitening(vectors: DataFrame) -> tuple[DataFrame, Whitening | None]:
    """The fit list of ``integer_vectors`` (each distinct x once; written to the shared folder) and
    its whitening.  None if there is no vector, no dimension or no variance.

    The dimension is the length of most usable vectors (the longest of several such)."""
    size = F.size("x")
    common = vectors.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    # equal vectors meet by their whole value, pre-aggregated in every task
    fit = materialize(vectors.filter(size == d).select("x").distinct(), "fit-list")
    if d == 0:
        return fit, None
    n, sums = _sums(fit, d)
    v = _covariance(fit, n, sums)
    rotated = one_sided_jacobi(pivoted_cholesky(v))
    e = (rotated ** 2).sum(0)
    order = np.argsort(-e, kind="stable")
    if not len(order):
        return fit, None
    units = rotated[:, order] / np.sqrt(e[order])
    units *= np.sign(units[np.abs(units).argmax(0), np.arange(len(order))])  # one of the two signs, fixed
    return fit, Whitening(n, sums, e[order], units, float(np.trace(v)))


def _centred(x: np.ndarray, w: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S exactly, and x - S / n in doubles."""
    top = int(np.abs(x.astype(float)).max(initial=0)) + 1
    small = w.n * top + max(map(abs, w.sums)) < 1 << 62
    apart = x * w.n - np.array(w.sums) if small else x.astype(object) * w.n - np.array(w.sums, object)
    return apart, (apart / w.n).astype(float)


def _deviation(apart: np.ndarray) -> list[int | None]:
    top = max(abs(int(apart.max(initial=0))), abs(int(apart.min(initial=0))))
    if top * top * max(1, apart.shape[1]) < 1 << 63:
        return (apart.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = (apart.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in exact]


def identity_error(fit: DataFrame, w: Whitening, k: int) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity), from the vectors
    themselves."""
    k = min(k, len(w.eigenvalues))
    turn, d = w.components[:, :k] / np.sqrt(w.eigenvalues[:k]), len(w.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in slices(batches, 8 << 20):
            z = _centred(_matrix(batch.column(0), d), w)[1] @ turn
            z = np.column_stack([z, np.ones(len(z))])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range((k + 1) ** 2), pa.int32()), pa.array(total.ravel())], ["cell", "s"])
    rows = fit.mapInArrow(run, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()  # (k + 1) squared
    total = np.zeros((k + 1) ** 2)
    for r in rows:
        total[r["cell"]] = r["s"] / w.n
    total = total.reshape(k + 1, k + 1)
    return float(np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max())


def whiten(df: DataFrame, k: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable vector
    and component 1..``k``, components by falling eigenvalue.

    Fitted on each distinct integer vector once.  Left out: null vectors, vectors with null or
    non-finite entries, and vectors of another length than most have.  There are at most as many
    components as the rank of the covariance: of equal vectors, or a single one, none, so no
    rows; so too of empty vectors and an empty table.  Repeated rows and null ids get rows of
    their own; equal eigenvalues are numbered in a fixed order.  ``deviation`` is null where it
    needs more than 63 bits.  Other columns are not read.
    """
    vectors = integer_vectors(df, id_col, vec_col)
    fit, w = fit_whitening(vectors)
    kind = dict(vectors.dtypes)["vec_id"]
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if w is None:
        return df.sparkSession.createDataFrame([], schema)
    k = min(k, len(w.eigenvalues))
    off, d = identity_error(fit, w, k), len(w.sums)
    root, explained = np.sqrt(w.eigenvalues[:k]), w.eigenvalues[:k] / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            apart, y = _centred(_matrix(batch.column(1), d), w)
            rows = len(y)
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, w.n, np.int64)), pa.array(_deviation(apart), pa.int64()).take(pa.array(each)),
                pa.array((y @ w.components[:, :k] / root).ravel()), pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, off))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return vectors.filter(F.size("x") == d).mapInArrow(run, schema)
