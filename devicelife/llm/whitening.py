"""Embedding whitening: principal components with unit variance.

Entries become whole numbers first (``floor(64 c) + 1000000``), so sums are
exact. Each distinct vector counts once in mean and covariance.

* Sums, then the covariance of centred entries: every task adds up its own
  ``C'C``, one row of the matrix is one row of the shuffle, and the tasks'
  rows are added pairwise in a fixed order.
* Eigenvalues: Householder reflections bring the matrix to tridiagonal form;
  Sturm counts bisect for each of the leading eigenvalues.
* Eigenvectors: inverse iteration on the tridiagonal matrix; vectors whose
  eigenvalues lie close together are made orthogonal to each other after
  each step; the reflections carry them back.
* The components (dimensions x ``k``) go to all tasks, which project rows.

The driver holds one dimensions x dimensions matrix, never rows of the table.

Edge cases: a vector that is null or empty, or holds null or non-finite
entries, or an entry whose whole number is beyond 2**53, is dropped, and so
are vectors of another length than most (ties: the longer); repeated rows
and ids are projected each, null ids too; components without variance (one
distinct vector, constant or dependent dimensions) are left out, so there
may be fewer than ``k``, down to none; a deviation that does not fit a long
is null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import cut

SCALE, SHIFT = 64, 1_000_000
_MOST = float(1 << 53)


@dataclass
class Whitening:
    """Mean as ``sums / n``, components in columns with their eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the Householder reflections (first index, unit vector) of a symmetric matrix."""
    a = a.copy()
    d = len(a)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0.0 or not np.any(x[1:]):
            continue
        x[0] += norm if x[0] >= 0 else -norm
        v = x / np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = 2.0 * (block @ v)
        w = p - (v @ p) * v
        block -= np.outer(v, w) + np.outer(w, v)
        edge = a[k + 1:, k]
        edge -= 2.0 * (v @ edge) * v
        a[k, k + 1:] = edge
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diag: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix are smaller than each x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = diag[0] - x
    count = (q < 0).astype(np.int64)
    for i in range(1, len(diag)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diag[i] - x - off[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of Gershgorin's interval down to neighbouring doubles."""
    d = len(diag)
    radius = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = float((diag - radius).min()), float((diag + radius).max())
    pad = 1e-12 * max(abs(low), abs(high)) + np.finfo(float).tiny
    lo, hi = np.full(k, low - pad), np.full(k, high + pad)
    index = d - 1 - np.arange(k)                      # the eigenvalue with this many smaller ones
    for _ in range(1100):
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        right = below(diag, off, mid) <= index
        lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)
    return lo + (hi - lo) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """Solution of (T - shift) y = b by elimination with row exchanges; vanishing pivots become ``floor``."""
    d = len(diag)
    p, q, r = np.zeros(d), np.zeros(d), np.zeros(d)   # the upper triangle's three diagonals
    y = b.copy()
    p[0], q[0] = diag[0] - shift, off[0] if d > 1 else 0.0
    for i in range(1, d):
        sub, here, after = off[i - 1], diag[i] - shift, off[i] if i < d - 1 else 0.0
        if abs(p[i - 1]) < abs(sub):
            f = p[i - 1] / sub
            p[i - 1], nq, nr = sub, q[i - 1] - f * here, -f * after
            q[i - 1], r[i - 1] = here, after
            p[i], q[i] = nq, nr
            y[i - 1], y[i] = y[i], y[i - 1] - f * y[i]
        else:
            f = sub / (p[i - 1] if p[i - 1] else floor)
            p[i], q[i] = here - f * q[i - 1], after
            y[i] -= f * y[i - 1]
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            y[i] -= q[i] * y[i + 1]
        if i + 2 < d:
            y[i] -= r[i] * y[i + 2]
        y[i] /= p[i] if abs(p[i]) > floor else (floor if p[i] >= 0 else -floor)
        if abs(y[i]) > 1e150:                         # only the direction matters
            y /= abs(y[i])
    return y / np.linalg.norm(y)


def leading_eigenvectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 7) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration. Those of a cluster are kept orthogonal in each step."""
    d, k = len(diag), len(values)
    size = max(float(np.abs(diag).max(initial=0.0)), float(np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    floor = np.finfo(float).eps * size
    rng = np.random.default_rng(seed)
    out = np.zeros((d, k))
    first = 0
    shift = None
    for j in range(k):
        if j and values[j - 1] - values[j] > 1e-3 * size:
            first, shift = j, None
        # equal eigenvalues get shifts of their own, else all solves give one direction
        shift = values[j] if shift is None else min(values[j], shift - 10 * floor)
        y = rng.standard_normal(d)
        y /= np.linalg.norm(y)
        for _ in range(6):
            y = _solve(diag, off, shift, y, floor)
            for _ in range(2):
                y -= out[:, first:j] @ (out[:, first:j].T @ y)
            norm = np.linalg.norm(y)
            if norm < 1e-8:                           # all of it lay in the vectors found: start from another direction
                y = rng.standard_normal(d)
                y -= out[:, first:j] @ (out[:, first:j].T @ y)
                norm = np.linalg.norm(y)
            y /= norm
        out[:, j] = y
    return out


def eigen(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues of a symmetric matrix, falling, and their unit eigenvectors in columns."""
    k = min(k, len(a))
    if not k:
        return np.zeros(0), np.zeros((len(a), 0))
    size = float(np.abs(a).max())
    if size == 0.0:
        return np.zeros(k), np.eye(len(a))[:, :k]
    diag, off, reflections = tridiagonal(a / size)
    values = leading_eigenvalues(diag, off, k)
    vectors = leading_eigenvectors(diag, off, values)
    for at, v in reversed(reflections):
        vectors[at:] -= 2.0 * np.outer(v, v @ vectors[at:])
    return values * size, vectors


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _x array of long) of the vectors that take part, all of one length."""
    c = F.col("_v")
    entry = lambda e: F.floor(e.cast("double") * SCALE)
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * SCALE) < _MOST))
    src = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v")).filter(c.isNotNull() & (F.size(c) > 0))
    src = src.filter(F.coalesce(fine, F.lit(False))).select("_id", F.transform(c, lambda e: entry(e) + SHIFT).alias("_x"))
    usual = src.groupBy(F.size("_x").alias("_n")).count().agg(F.max_by("_n", F.struct("count", "_n")).alias("_n"))
    return src.filter(F.size("_x") == usual.scalar())


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, from the exact whole part and fraction of the mean."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - part


def _summed(rows: DataFrame, d: int, width: int, task) -> np.ndarray:
    """Sum over tasks of the (d x width) arrays that ``task(batches)`` gives, one matrix row a row of the shuffle."""
    schema = StructType([StructField("row", IntegerType()), StructField("part", IntegerType()), StructField("sums", BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        total = task(batches)
        if total is not None:
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([at] * d, pa.int32()),
                                              pa.array([r.tobytes() for r in total], pa.binary())], names=schema.fieldNames())

    def add(_, group):
        group = group.sort_values("part")
        level = [np.frombuffer(b) for b in group["sums"]]
        while len(level) > 1:                         # pairwise, in the tasks' order
            level = [level[i] + level[i + 1] if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        import pandas as pd
        return pd.DataFrame({"row": [int(group["row"].iloc[0])], "part": [0], "sums": [level[0].tobytes()]})

    partial = rows.mapInArrow(run, schema)
    # two levels: no task reads a row of every task before
    first = partial.withColumn("_lot", F.floor(F.col("part") / 64).cast("int")).groupBy("row", "_lot").applyInPandas(
        lambda k, g: add(k, g.drop(columns="_lot")).assign(part=int(k[1])), schema)
    whole = first.groupBy("row").applyInPandas(add, schema)
    out = np.zeros((d, width))
    for r in whole.toLocalIterator():
        out[r.row] = np.frombuffer(bytes(r.sums))
    return out


def fit(x_rows: DataFrame, k: int = 16) -> Whitening:
    """Mean, leading components and eigenvalues of the distinct vectors of ``whole_numbers``."""
    points = cut(x_rows.select("_x").distinct())
    head = points.select(F.size("_x").alias("d")).first()
    if head is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    d = head.d
    dims = points.select(F.posexplode("_x").alias("dim", "x")).groupBy("dim").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")).orderBy("dim").collect()  # d rows
    n, sums = int(dims[0].n), [int(r.s) for r in dims]

    def covariance(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                c = _centred(_matrix(batch.column(0), d), n, sums)
                total = c.T @ c if total is None else total + c.T @ c
        return total

    v = _summed(points, d, d, covariance) / n
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, vectors = eigen(v, k)
    live = values > 1e-12 * d * max(trace, 0.0)
    out = Whitening(n, sums, values[live], vectors[:, live], trace)
    m = len(out.values)
    if m:
        scaled = out.components / np.sqrt(out.values)

        def check(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    w = _centred(_matrix(batch.column(0), d), n, sums) @ scaled
                    w = np.hstack([w, np.ones((len(w), 1))])
                    total = w.T @ w if total is None else total + w.T @ w
            return total

        second = _summed(points, m + 1, m + 1, check) / n
        mean = second[m, :m]
        out.identity_error = float(np.abs(second[:m, :m] - np.outer(mean, mean) - np.eye(m)).max())
    return out


def project(x_rows: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    id_field = StructField(id_col, x_rows.schema["_id"].dataType)
    schema = StructType([id_field, StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()),
                         StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])
    m, d, n, sums = len(model.values), len(model.sums), model.n, model.sums
    scaled = model.components / np.sqrt(model.values) if m else None
    explained = model.values / model.trace if m else None
    error = model.identity_error

    def deviations(x: np.ndarray) -> list:
        """Sums over dimensions of (n x - S)^2, exactly."""
        whole = np.array([s // n for s in sums], dtype=np.int64)
        rest = np.array([s % n for s in sums], dtype=np.int64)
        apart = x - whole                             # n x - S = n (x - whole) - rest
        bound = (np.abs(apart).max(initial=0) + 1) * float(n)
        if bound < 2 ** 31 and bound * bound * d < 2 ** 62:
            y = n * apart - rest
            return (y * y).sum(axis=1).tolist()
        exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest.tolist())) for row in apart.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not m:
                continue
            x = _matrix(batch.column(1), d)
            w = _centred(x, n, sums) @ scaled
            rows = len(x)
            at = pa.array(np.repeat(np.arange(rows), m))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)), pa.array(np.full(rows * m, n)),
                 pa.array(deviations(x), pa.int64()).take(at), pa.array(w.reshape(-1)), pa.array(np.tile(explained, rows)),
                 pa.array(np.full(rows * m, error))], names=schema.fieldNames())

    return x_rows.select("_id", "_x").mapInArrow(run, schema)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16) -> DataFrame:
    x_rows = whole_numbers(vectors, id_col, vector_col)
    return project(x_rows, fit(x_rows, k), id_col)
