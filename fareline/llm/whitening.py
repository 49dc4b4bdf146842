"""Embedding whitening: distributed covariance, a symmetric eigensolver, broadcast projection.

1. Every component c becomes the integer x = floor(64 * c) + 1000000. The fit list is
   each distinct x vector once (a grouped distinct: copies of a hot vector collapse
   within each map task).
2. Two passes over the fit list: counts and per-dimension sums S, exact; then the
   covariance of (n * x - S) / n, whose numerators are exact integers. A task emits its
   partial sums by matrix row, and rows are added up before the driver sees one d x d
   matrix, whatever the number of tasks.
3. On that one matrix: Householder reflections to tridiagonal form, bisection with Sturm
   counts for the leading eigenvalues, inverse iteration for their vectors with
   reorthogonalisation within clusters of close eigenvalues, and the reflections back.
4. The projection (d x components) is broadcast; a third pass over the fit list measures
   how far the whitened covariance is from the identity.

Defined results: vectors that are null, empty, or hold a null or non-finite component
take no part, and neither do vectors of another length than most rows have (of equally
common lengths the longest counts). Null and repeated ids keep one set of rows per input
row. A direction without variance (below 1e-12 of the largest) can't be whitened and is
left out, so a fit list of one vector gives no rows; nor does an empty table.
``deviation`` is null where it doesn't fit 64 bits; components whose x doesn't fit 64
bits count as the nearest one that does. Texts don't occur; other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import materialize

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
NO_VARIANCE = 1e-12
LONG_MAX = (1 << 63) - 1
OUT_ROWS = 1 << 16


def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """(diagonal, off-diagonal, reflection vectors) of a symmetric matrix."""
    a, n, vectors = a.astype(float, copy=True), len(a), []
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        size = float(np.linalg.norm(x))
        if size == 0 or not x[1:].any():
            off[k] = x[0]
            vectors.append(None)
            continue
        off[k] = -np.copysign(size, x[0])
        x[0] -= off[k]
        v = x / np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        p -= v * (v @ p)
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        vectors.append(v)
    return np.diag(a).copy(), off, vectors


def sturm_counts(d: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value of ``at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for i in range(len(d)):
        q = d[i] - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval can't shrink."""
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    # so many eigenvalues lie below the wanted one
    below = len(d) - 1 - np.arange(k)
    while True:
        mid = low + (high - low) / 2
        going = (mid > low) & (mid < high)
        if not going.any():
            return mid
        up = sturm_counts(d, off, mid) <= below
        low, high = np.where(going & up, mid, low), np.where(going & ~up, mid, high)


def solve_shifted(d: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x of (T - shift) x = b by elimination with row exchanges; zero pivots become ``tiny``."""
    n = len(d)
    # rows of the upper factor: pivot, next and next but one column
    u0, u1, u2, y = (d - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n, b.tolist()
    lower = off.tolist()
    for i in range(n - 1):
        if abs(lower[i]) > abs(u0[i]):
            factor = u0[i] / lower[i]
            u0[i], u0[i + 1], u1[i], u1[i + 1], u2[i] = lower[i], u1[i] - factor * u0[i + 1], u0[i + 1], -factor * u1[i + 1], u1[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(u0[i]) < tiny:
                u0[i] = tiny
            factor = lower[i] / u0[i]
            u0[i + 1] -= factor * u1[i]
            y[i + 1] -= factor * y[i]
    x = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        pivot = u0[i] if abs(u0[i]) >= tiny else tiny
        x[i] = (y[i] - u1[i] * x[i + 1] - u2[i] * x[i + 2]) / pivot
    return np.array(x[:n])


def tridiagonal_vectors(d: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; those of a cluster are kept orthogonal."""
    n, norm = len(d), float(max(np.abs(d).max(), np.abs(off).max(initial=0), np.finfo(float).tiny))
    eps, rng = np.finfo(float).eps, np.random.default_rng(1)
    out = np.zeros((n, len(values)))
    first, shift = 0, 0.0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # equal eigenvalues are told apart by a shift of a few roundings
        shift = min(value, shift - 4 * eps * norm) if j > first else value
        x = rng.normal(size=n)
        for _ in range(rounds):
            x = solve_shifted(d, off, shift, x / np.abs(x).max(), eps * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors (columns)."""
    k = min(k, len(a))
    scale = float(np.abs(a).max(initial=0))
    if k == 0 or scale == 0:
        return np.zeros(k), np.eye(len(a), k)
    d, off, reflections = tridiagonalise(a / scale)
    values = leading_eigenvalues(d, off, k)
    vectors = tridiagonal_vectors(d, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        if (v := reflections[i]) is not None:
            vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    return values * scale, vectors


def _matrix(column) -> np.ndarray:
    """(rows, dimensions) of a list column whose lists are equally long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _wide(x: np.ndarray, times: int) -> np.ndarray:
    """``x``, as Python integers where ``times`` its largest entry could leave 64 bits."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return x if 4 * times * largest < LONG_MAX else x.astype(object)


def _sums(batches):
    n, total = 0, None
    for b in batches:
        if b.num_rows:
            x = _matrix(b.column(0))
            part = [int(s) for s in _wide(x, len(x)).sum(axis=0)]
            total = part if total is None else [s + t for s, t in zip(total, part)]
            n += len(x)
    if n:
        yield pa.record_batch(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(np.full(len(total), n)), pa.array([Decimal(s) for s in total], pa.decimal128(38, 0))],
            names=["i", "n", "s"],
        )


def _numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: 64-bit integers where those suffice, else Python integers."""
    x = _wide(x, n)
    return n * x - (sums.astype(np.int64) if x.dtype != object else sums)


def _rows(i, m: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.asarray(i, np.int32)), pa.array(list(m), pa.list_(pa.float64()))], names=["i", "v"])


def _moments(shared, projected: bool):
    """A task's sum of outer products of the centred (or projected) vectors, by matrix row; row -1 is their sum."""

    def run(batches):
        n, sums, projection = shared.value
        total = 0.0
        for b in batches:
            if b.num_rows:
                y = (_numerators(_matrix(b.column(0)), n, sums) / n).astype(float)
                y = y @ projection if projected else y
                total = total + np.vstack([y.T @ y, y.sum(axis=0)])
        if not np.isscalar(total):
            yield _rows([*range(len(total) - 1), -1], total)

    return run


def _add_rows(batches):
    total: dict[int, np.ndarray] = {}
    for b in batches:
        m = _matrix(b.column(1)) if b.num_rows else ()
        for i, v in zip(b.column(0).to_pylist(), m):
            total[i] = total[i] + v if i in total else v.copy()
    if total:
        yield _rows(list(total), np.array(list(total.values())))


def _summed(parts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, sum) over all tasks: rows are added up by row index, d + 1 rows reach the driver."""
    rows = parts.repartition("i").mapInArrow(_add_rows, "i int, v array<double>").collect()
    by = {r.i: r.v for r in rows}
    return np.array([by[i] for i in range(len(by) - 1)]), np.array(by[-1])


def _project(shared, explained, identity_error: float):
    def run(batches):
        n, sums, projection = shared.value
        k = projection.shape[1]
        for whole in batches:
            step = max(1, OUT_ROWS // k)
            for a in range(0, whole.num_rows, step):
                b = whole.slice(a, step)
                y, m = _numerators(_matrix(b.column(1)), n, sums), b.num_rows
                square = (_wide(y, max(1, int(np.abs(y).max())) * y.shape[1]) ** 2).sum(axis=1)
                deviation = pa.array([int(s) if s <= LONG_MAX else None for s in square], pa.int64())
                white = (y / n).astype(float) @ projection
                row = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch(
                    [
                        b.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation.take(row),
                        pa.array(white.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, identity_error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


OUT_SCHEMA = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def fixed_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows that take part, written."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    # what doesn't fit 64 bits stops at their ends, whatever the session's overflow rule
    x = F.transform(v, lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-9e18)), F.lit(9e18))), F.lit(-LONG_MAX)), F.lit(LONG_MAX - OFFSET)) + OFFSET)
    good = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("v").isNotNull())
    good = good.select("id", F.col("v").alias(vector_col)).where(finite & (F.size(vector_col) > 0))
    return materialize(good.select("id", x.alias("x")), "vectors")


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened leading components per row and component, with n, deviation, explained share and identity error."""
    spark = rows.sparkSession
    xs = fixed_vectors(rows, id_col, vector_col)
    lengths = xs.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    empty = spark.createDataFrame([], OUT_SCHEMA).withColumnRenamed("id", id_col)
    if not lengths:
        return empty
    xs = xs.where(F.size("x") == lengths[0].d)
    fit = materialize(xs.select("x").distinct(), "fit")
    by = {r.i: r for r in fit.mapInArrow(_sums, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    n, sums = by[0].n, np.array([int(by[i].s) for i in range(len(by))], object)

    send = spark.sparkContext.broadcast
    gram, _ = _summed(fit.mapInArrow(_moments(send((n, sums, None)), False), "i int, v array<double>"))
    covariance = gram / n
    values, vectors = leading_components(covariance, components)
    kept = values > NO_VARIANCE * max(values[0], 0)
    if not kept.any():
        return empty
    values, vectors = values[kept], vectors[:, kept]
    shared = send((n, sums, vectors / np.sqrt(values)))
    square, mean = _summed(fit.mapInArrow(_moments(shared, True), "i int, v array<double>"))
    mean = mean / n
    identity_error = float(np.abs(square / n - np.outer(mean, mean) - np.eye(len(values))).max())
    return xs.mapInArrow(_project(shared, values / np.trace(covariance), identity_error), OUT_SCHEMA).withColumnRenamed("id", id_col)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 16 whitened components of every embedding."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
