"""Embedding whitening: exact sums and a centred covariance from Spark, the
leading components from a tridiagonal form, and a broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LARGEST = 2.0 ** 52  # |x| below this is exact as a double
EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """Size and per-dimension sums of the fit list, and its components
    (columns, by falling eigenvalue) with the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix:
    reflections H_0 ... H_(m-3), each clearing a column below the
    subdiagonal, give a tridiagonal H' a H."""
    a = a.copy()
    m = len(a)
    mirrors = []
    for j in range(m - 2):
        v = a[j + 1:, j].copy()
        size = np.linalg.norm(v)
        if size > 0 and np.abs(v[1:]).max() > 0:
            v[0] += np.copysign(size, v[0])
            v /= np.linalg.norm(v)
            block = a[j + 1:, j + 1:]
            w = block @ v
            w -= v * (v @ w)
            block -= 2.0 * (np.outer(v, w) + np.outer(w, v))
            below = a[j + 1, j] - 2.0 * v[0] * (v @ a[j + 1:, j])
            a[j + 1:, j] = a[j, j + 1:] = 0.0
            a[j + 1, j] = a[j, j + 1] = below
        else:
            v = np.zeros(m - j - 1)
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def unmirror(mirrors: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Columns in the tridiagonal form's basis, brought back."""
    out = columns.copy()
    for j in reversed(range(len(mirrors))):
        v = mirrors[j]
        out[j + 1:] -= 2.0 * np.outer(v, v @ out[j + 1:])
    return out


def below(diagonal: np.ndarray, off: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie below
    each cut, as the negative pivots of its shifted factorisation."""
    tiny = EPS * (np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)) ** 2 * EPS + 1e-300
    count = np.zeros(len(cuts), np.int64)
    pivot = np.ones(len(cuts))
    for i, d in enumerate(diagonal):
        pivot = d - cuts - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection on Sturm counts
    (all intervals are halved together)."""
    m = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    pad = EPS * max(np.abs(low[0]), np.abs(high[0]), 1e-300) * m
    low, high = low - pad, high + pad
    rank = m - 1 - np.arange(k)  # the eigenvalue with so many below it
    for _ in range(2000):
        middle = 0.5 * (low + high)
        if ((middle <= low) | (middle >= high)).all():
            break
        above = below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return 0.5 * (low + high)


def _factor(diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float):
    """Elimination with row exchanges of the shifted tridiagonal matrix."""
    m = len(diagonal)
    u = np.zeros((m, 3))
    swap, times = np.zeros(m, bool), np.zeros(m)
    row = np.array([diagonal[0] - shift, off[0] if m > 1 else 0.0, 0.0])
    for i in range(m - 1):
        new = np.array([off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < m else 0.0])
        if abs(new[0]) > abs(row[0]):
            swap[i], row, new = True, new, row
        if abs(row[0]) < tiny:
            row[0] = tiny
        u[i], times[i] = row, new[0] / row[0]
        rest = new - times[i] * row
        row = np.array([rest[1], rest[2], 0.0])
    if abs(row[0]) < tiny:
        row[0] = tiny
    u[m - 1] = row
    return u, swap, times


def _solve(parts, b: np.ndarray) -> np.ndarray:
    u, swap, times = parts
    b = b.copy()
    m = len(b)
    for i in range(m - 1):
        if swap[i]:
            b[i], b[i + 1] = b[i + 1], b[i]
        b[i + 1] -= times[i] * b[i]
    x = np.zeros(m + 2)
    for i in reversed(range(m)):
        x[i] = (b[i] - u[i, 1] * x[i + 1] - u[i, 2] * x[i + 2]) / u[i, 0]
        if abs(x[i]) > 1e200:  # only the direction matters
            x, b = x * 1e-200, b * 1e-200
    return x[:m]


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration.  Eigenvalues nearer
    than a thousandth of the matrix's norm are one cluster; its vectors are
    made orthogonal to those before them in every round."""
    m = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), 1e-300)
    out = np.zeros((m, len(values)))
    rng = np.random.default_rng(m)
    shift, start = 0.0, 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * norm:
            start = i
        # equal values get shifts a rounding apart
        shift = value if i == start else min(value, shift - EPS * norm)
        parts = _factor(diagonal, off, shift, EPS * norm)
        v = rng.standard_normal(m)
        for _ in range(rounds):
            for _ in range(2):
                v -= out[:, start:i] @ (out[:, start:i].T @ v)
            v /= np.linalg.norm(v)
            v = _solve(parts, v)
            v /= np.abs(v).max()
        for _ in range(2):
            v -= out[:, start:i] @ (out[:, start:i].T @ v)
            v /= np.linalg.norm(v)
        out[:, i] = v
    return out


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors
    (columns)."""
    size = np.abs(covariance).max()
    if size == 0:
        return np.zeros(k), np.eye(len(covariance))[:, :k]
    diagonal, off, mirrors = tridiagonal(covariance / size)
    values = leading_values(diagonal, off, k)
    return values * size, unmirror(mirrors, leading_vectors(diagonal, off, values))


# ------------------------------------------------------------ Spark
def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, scale: float, shift: int) -> DataFrame:
    """(id, x) with x = floor(scale * entry) + shift as long, of the rows
    whose vector has finite entries only, none too large to be exact."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e.cast("double"))
                   | (F.abs(e.cast("double")) * F.lit(abs(scale)) + abs(shift) >= F.lit(LARGEST)))
    return vectors.filter(v.isNotNull() & ~bad & (F.size(v) > 0)).select(
        F.col(id_col).alias("id"),
        F.transform(v, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long") + F.lit(shift).cast("long")).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _pair_sums(parts: DataFrame, dim: int) -> np.ndarray:
    """Symmetric matrix from (i, j, v) rows, i <= j: the rows of all tasks
    meet by cell, and dim * (dim + 1) / 2 sums reach the driver."""
    out = np.zeros((dim, dim))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j = cells["i"].to_numpy(), cells["j"].to_numpy()
    out[i, j] = out[j, i] = cells["v"].to_numpy()
    return out


def _upper(total: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(total))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                      names=["i", "j", "v"])


def covariance_of(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance (divisor n) of the ``x`` column, centred before
    multiplying; every task sends one matrix."""
    dim = len(sums)
    s = np.array(sums, object)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        whole, rest = (s // n).astype(np.int64), ((s % n) / n).astype(np.float64)
        for batch in batches:
            y = (_matrix(batch.column(0), dim) - whole) - rest
            total += y.T @ y
        yield _upper(total)

    return _pair_sums(rows.select("x").mapInArrow(scatter, "i int, j int, v double"), dim) / n


def fit_whitening(rows: DataFrame, k: int) -> Whitening | None:
    """Fit on the (id, x) rows of one length; None if there are none, or no
    direction has variance.  Directions whose eigenvalue is within rounding
    of zero are left out."""
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()  # one row a dimension
    if not sums:
        return None
    s, n = [int(r["s"]) for r in sorted(sums)], sums[0]["n"]
    covariance = covariance_of(rows, n, s)
    values, components = leading_components(covariance, min(k, len(s)))
    trace = float(np.trace(covariance))
    real = values > max(len(s) * EPS * values[0] * 16, 0.0)
    if not real.any():
        return None
    return Whitening(n, tuple(s), values[real], components[:, real], trace)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2 in whole numbers; null where
    that is no 64-bit number."""
    far = n * x.astype(np.float64) - sums.astype(np.float64)
    if (far ** 2).sum(1).max(initial=0) < 2.0 ** 62 and n * float(np.abs(x).max(initial=0)) < 2.0 ** 62:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(1).tolist()
    big = ((n * x.astype(object) - sums) ** 2).sum(1)
    return [int(v) if v < 2 ** 63 else None for v in big]


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32,
           scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """(``id_col``, component from 1, n, deviation, whitened, explained,
    identity_error): the leading components' whitened coordinates of every
    vector, one row each.

    Entries are taken as x = floor(scale * entry) + shift.  Vectors that are
    null, empty, hold null or non-finite entries, or entries so large that x
    is not exact, drop out.  The fit list is all that remain, repeated rows
    each; null ids and repeated ids stay.  With vectors of several lengths
    the commonest length (the shorter of equals) is fitted and the others
    drop out.  Directions without variance have no rows: a table of one
    vector, or of equal ones, gives none.  ``deviation`` is null beyond 64
    bits.

    The rows are passed over for their sums (exact, by dimension), for the
    centred covariance (one matrix a task, summed by cell), for the whitened
    values' own covariance, and for the result.  The driver holds matrices of
    dimension by dimension, whatever the number of rows; the projection that
    goes to the tasks is dimension by ``components``."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows = materialize(integer_rows(vectors, id_col, vec_col, scale, shift), "whitening")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = lengths[0]["d"] if lengths else 0
    rows = rows.filter(F.size("x") == dim)
    fit = fit_whitening(rows, components) if dim else None
    if fit is None:
        return spark.createDataFrame([], schema)
    # a column per component: the unit vector over the root of its eigenvalue
    turn = spark.sparkContext.broadcast((fit.n, np.array(fit.sums, object), fit.components / np.sqrt(fit.values)))

    def project(x: np.ndarray) -> np.ndarray:
        n, sums, columns = turn.value
        return ((x - (sums // n).astype(np.int64)) - ((sums % n) / n).astype(np.float64)) @ columns

    k = len(fit.values)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))  # the last column is one: sums beside products
        for batch in batches:
            w = project(_matrix(batch.column(0), dim))
            w = np.concatenate([w, np.ones((len(w), 1))], 1)
            total += w.T @ w
        yield _upper(total)

    seen = _pair_sums(rows.select("x").mapInArrow(again, "i int, j int, v double"), k + 1) / fit.n
    error = float(np.abs(seen[:k, :k] - np.outer(seen[:k, k], seen[:k, k]) - np.eye(k)).max())
    share = fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, _ = turn.value
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            m = len(x)
            if not m:
                continue
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n, np.int64)), pa.array(deviations(x, n, sums), pa.int64()).take(at),
                 pa.array(project(x).reshape(-1)), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(run, schema)
