"""Embedding whitening (operator 11): distributed centred covariance, leading eigenvectors, broadcast projection.

Vectors are fixed-point numbers x = floor(256 * c).  The fit list holds each different x once (a
partial aggregate, so one very common vector costs nothing).  Its sums are exact integers; its
covariance is summed over centred rows by partition, in blocks of matrix rows added up a tree of
``FAN_IN`` partials a task.  The driver holds one d x d matrix, bounded by the dimension and not
by the rows, and finds the leading eigenpairs: Householder tridiagonalisation, bisection on Sturm
counts, inverse iteration with reorthogonalisation inside clusters.  The components (d x k) go to
all tasks as a broadcast variable.

Defined results: rows whose vector is null, or holds null, NaN, infinite entries or ones beyond
2**55, are left out; so are those of another length than the most frequent one (the longest of
equally frequent ones); a null id keeps its row; repeated rows are scored each, and count once in
the fit; components with no variance beyond rounding are not returned (so none of a single
vector); an empty table gives an empty result; other columns are not looked at.  ``deviation`` is
exact and null only where it passes 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.tables import saved

COMPONENTS = 4
SCALE = 256
#: Entries beyond this have no 64-bit fixed-point form.
LARGEST = float(1 << 55)
#: Partial sums added by one task, and rows of the matrix in one block.
FAN_IN, BLOCK = 16, 64


# ---------------------------------------------------------------------------
# Leading eigenpairs of a symmetric matrix
# ---------------------------------------------------------------------------
def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors v_j with A = H_0 H_1 ... T ... H_1 H_0."""
    a = a.astype(np.float64).copy()
    d = len(a)
    reflectors = []
    for j in range(d - 2):
        v = a[j + 1:, j].copy()
        norm = np.linalg.norm(v)
        if norm > 0:
            v[0] += np.copysign(norm, v[0])
            v /= np.linalg.norm(v)
            a[j + 1:, j:] -= 2 * np.outer(v, v @ a[j + 1:, j:])
            a[j:, j + 1:] -= 2 * np.outer(a[j:, j + 1:] @ v, v)
        reflectors.append(v if norm > 0 else np.zeros_like(v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diag: np.ndarray, off: np.ndarray, x: float) -> int:
    """Eigenvalues of the tridiagonal matrix below ``x``: negative pivots of T - xI."""
    tiny = np.finfo(float).tiny ** 0.5
    q, count = 1.0, 0
    for i in range(len(diag)):
        q = diag[i] - x - (off[i - 1] ** 2 / q if i else 0.0)
        if abs(q) < tiny:
            q = -tiny
        count += q < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection to the last bit."""
    d = len(diag)
    reach = np.abs(np.append(off, 0)) + np.abs(np.insert(off, 0, 0))
    low, high = float((diag - reach).min()), float((diag + reach).max())
    pad = np.finfo(float).eps * max(abs(low), abs(high)) + np.finfo(float).tiny
    found = []
    for i in range(k):
        a, b = low - pad, (found[-1] if found else high) + pad
        while True:
            mid = (a + b) / 2
            if not a < mid < b:
                break
            # At least i + 1 eigenvalues at or above mid: the wanted one is not below it.
            a, b = (mid, b) if d - sturm_count(diag, off, mid) > i else (a, mid)
        found.append((a + b) / 2)
    return np.array(found)


def _solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray, small: float) -> np.ndarray:
    """(T - shift I)^-1 rhs by elimination with partial pivoting; pivots of zero become ``small``."""
    d = len(diag)
    a, b, c, x = diag - shift, np.append(off, 0.0), np.zeros(d), rhs.copy()
    low = off.copy()
    for i in range(d - 1):
        if abs(low[i]) > abs(a[i]):  # swap rows i and i + 1
            pivot, after, second = low[i], a[i + 1], b[i + 1]
            f = a[i] / pivot
            a[i + 1], b[i + 1] = b[i] - f * after, -f * second
            a[i], b[i], c[i] = pivot, after, second
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
        else:
            a[i] = a[i] if abs(a[i]) > small else small
            f = low[i] / a[i]
            a[i + 1] -= f * b[i]
            x[i + 1] -= f * x[i]
    a[-1] = a[-1] if abs(a[-1]) > small else small
    for i in range(d - 1, -1, -1):
        x[i] -= (b[i] * x[i + 1] if i + 1 < d else 0.0) + (c[i] * x[i + 2] if i + 2 < d else 0.0)
        x[i] /= a[i]
    return x


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    A cluster is a run of eigenvalues closer than a thousandth of the norm: its vectors are kept
    orthogonal to each other in every step of the inverse iteration."""
    d = len(matrix)
    k = min(k, d)
    scale = np.abs(matrix).max() if d else 0.0
    if not k or scale == 0:
        return np.zeros(k), np.eye(d)[:, :k]
    diag, off, reflectors = tridiagonalise(matrix / scale)
    values = leading_eigenvalues(diag, off, k)
    norm = max(np.abs(diag).max(), np.abs(off).max() if d > 1 else 0.0)
    small, random = np.finfo(float).eps * norm, np.random.default_rng(0)
    vectors = np.zeros((d, k))
    start = 0
    for i in range(k):
        if i and values[i - 1] - values[i] > 1e-3 * norm:
            start = i
        shift = values[i] - (i - start) * small  # equal eigenvalues: slightly different shifts
        v = random.standard_normal(d)
        for _ in range(6):
            for _ in range(2):
                v -= vectors[:, start:i] @ (vectors[:, start:i].T @ v)
            v /= np.linalg.norm(v)
            v = _solve_shifted(diag, off, shift, v, small)
            v /= np.abs(v).max()
        for _ in range(2):
            v -= vectors[:, start:i] @ (vectors[:, start:i].T @ v)
        vectors[:, i] = v / np.linalg.norm(v)
    for j in range(d - 3, -1, -1):
        vectors[j + 1:] -= 2 * np.outer(reflectors[j], reflectors[j] @ vectors[j + 1:])
    vectors *= np.where(vectors[np.abs(vectors).argmax(0), np.arange(k)] < 0, -1, 1)
    return values * scale, vectors


# ---------------------------------------------------------------------------
# Rows, sums and covariance
# ---------------------------------------------------------------------------
def fixed_point(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the usable rows: finite vectors of the most frequent length."""
    c = F.col(vector_col)
    good = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: F.coalesce(F.abs(v.cast("double")) < LARGEST, F.lit(False)))
    x = F.transform(c, lambda v: F.when(F.abs(v.cast("double")) < LARGEST, F.floor(v.cast("double") * SCALE)).cast("long"))
    some = rows.filter(good).select(F.col(id_col).cast("long").alias(id_col), x.alias("x"))
    lengths = some.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    d = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return some.filter(F.size("x") == (d["d"] if d else 0))


def _matrix(column) -> np.ndarray:
    """The equally long lists of an Arrow column as one array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 1), np.int64)


def _filled(batches):
    return (b for b in batches if len(b))


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and the per-dimension sums of x, exact whatever their size."""
    def run(batches):
        n, total = 0, 0
        for b in _filled(batches):
            x = _matrix(b.column(0))
            safe = len(x) * float(np.abs(x.astype(np.float64)).max()) < 2**62
            total = total + (x.sum(0).astype(object) if safe else x.astype(object).sum(0))
            n += len(x)
        if n:
            from decimal import Decimal
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([[Decimal(int(v)) for v in total]], pa.list_(pa.decimal128(38, 0)))], names=["n", "s"])

    parts = fit.select("x").mapInArrow(run, "n long, s array<decimal(38,0)>")
    rows = (parts.select("n", F.posexplode("s")).groupBy("pos")
            .agg(F.sum("n").alias("n"), F.sum("col").cast("decimal(38,0)").alias("s")).orderBy("pos").collect())  # one row per dimension
    return (int(rows[0]["n"]), [int(r["s"]) for r in rows]) if rows else (0, [])


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the fit list, divisor n: rows are centred, then multiplied, and partials added up a tree."""
    d = len(sums)
    mean = np.array([s / n for s in sums])
    whole, part = np.array([s // n for s in sums], dtype=np.float64), np.array([(s % n) / n for s in sums])
    schema = "k long, block int, m binary"

    def partial(batches):
        total = np.zeros((d, d))
        for b in _filled(batches):
            c = (_matrix(b.column(0)) - whole) - part if np.abs(mean).max() < 2**50 else _matrix(b.column(0)) - mean
            total += c.T @ c
        starts = range(0, d, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()] * len(starts)), pa.array([s // BLOCK for s in starts], pa.int32()),
             pa.array([total[s:s + BLOCK].tobytes() for s in starts], pa.binary())], names=["k", "block", "m"])

    def add(key, pdf):
        return pd.DataFrame({"k": [key[0]], "block": [key[1]], "m": [sum(np.frombuffer(m) for m in pdf["m"]).tobytes()]})

    left = fit.rdd.getNumPartitions()
    parts = fit.select("x").mapInArrow(partial, schema)
    while left > 1:
        parts = parts.select(F.floor(F.col("k") / FAN_IN).alias("k"), "block", "m").groupBy("k", "block").applyInPandas(add, schema)
        left = -(-left // FAN_IN)
    blocks = {r["block"]: np.frombuffer(r["m"]).reshape(-1, d) for r in parts.collect()}  # d x d doubles in all
    return np.vstack([blocks[i] for i in sorted(blocks)]) / n


@dataclass
class Whitening:
    """A fitted whitening: n and sums of the fit list, eigenvalues, components (d x k), trace, and the error of identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def scores(self, rows: DataFrame) -> DataFrame:
        """The columns of ``rows`` (one of them x) before x, then deviation and whitened (an array, one entry per component)."""
        others = [c for c in rows.columns if c != "x"]
        shared = rows.sparkSession.sparkContext.broadcast((self.n, self.sums, self.components / np.sqrt(self.values)))

        def run(batches):
            n, sums, weights = shared.value
            mean = np.array([s / n for s in sums])
            wide = any(abs(s) >= 2**62 for s in sums)
            s = np.array(sums, dtype=object if wide else np.int64)
            for b in _filled(batches):
                x = _matrix(b.column(b.num_columns - 1))
                largest = n * float(np.abs(x.astype(np.float64)).max(initial=0)) + float(max((abs(v) for v in sums), default=0))
                if not wide and largest**2 * len(sums) < 2**62:
                    deviation = pa.array(((n * x - s) ** 2).sum(1))
                else:
                    big = ((n * x.astype(object) - s) ** 2).sum(1)
                    deviation = pa.array([int(v) if v < 2**63 else None for v in big], pa.int64())
                white = (x - mean) @ weights
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], white.ravel())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], deviation, lists], names=[*others, "deviation", "whitened"])

        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "x"]
        return rows.select(*others, "x").mapInArrow(run, ", ".join([*fields, "deviation long, whitened array<double>"]))


def fit_whitening(points: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """Fit on the different x of ``points``; None if nothing varies (or there are no rows)."""
    fit = saved(points.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "whitening-fit")
    n, sums = exact_sums(fit)
    if not n:
        return None
    v = covariance(fit, n, sums)
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, components = leading_eigenpairs(v, k)
    real = values > trace * len(v) * 1e-13
    if not real.any():
        return None
    model = Whitening(n, sums, values[real], components[:, real], trace)
    white = model.scores(fit).select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(int(real.sum()))])
    means = white.agg(*[F.avg(c).alias(c) for c in white.columns]).first()
    centred = [F.col(c) - F.lit(means[c]) for c in white.columns]
    pairs = [(i, j) for i in range(len(centred)) for j in range(i + 1)]
    second = white.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    model.identity_error = float(max(abs(s - (i == j)) for s, (i, j) in zip(second, pairs)))
    return model


def whiten(rows: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    points = saved(fixed_point(rows, id_col, vector_col), "whitening-points")
    model = fit_whitening(points, k)
    schema = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    each = model.scores(points).select(id_col, "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return each.select(id_col, (F.col("_i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       shares[F.col("_i")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))
