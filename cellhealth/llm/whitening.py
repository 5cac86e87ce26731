"""Embedding whitening: projection on the leading eigenvectors of the covariance, scaled to unit variance.

Entries become whole numbers x = floor(scale * c) + offset, so that sums and squared deviations
are exact.  One pass adds up the vectors, a second the products of the centred vectors; tasks
hold one matrix each, whose rows are added up by row and column in Spark.  The driver sees the
covariance, a table of dimensions by dimensions whatever the number of vectors.  It is brought
to tridiagonal form by Householder reflections; the leading eigenvalues are found by bisection
on Sturm counts, their vectors by inverse iteration, in which vectors of one cluster of close
eigenvalues are made orthogonal to each other.  The few components go with the tasks of a third
pass, which projects every vector.

Defined cases: a vector that is null or holds a null or non-finite entry, or one whose whole
number does not fit 62 bits, takes no part, nor does one of another length than most have (of
equally common lengths the larger counts); without a vector, or where vectors have no entries or
do not vary, there is no row.  An eigenvalue that rounding cannot tell from zero has no component,
so fewer than ``k`` may come.  A deviation beyond 63 bits is null.  A null or repeated id is
projected like any other, each row by itself; further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhealth.llm.common import prepare, reread, write_stage

#: Rows whose products are added up at once; bounds a task's memory beside its matrix.
ROWS = 4096
#: Eigenvalues nearer to each other than this share of the largest form a cluster.
CLUSTER = 1e-3
EPS = float(np.finfo(np.float64).eps)
LIMIT = 1 << 62


def whole_numbers(vectors: DataFrame, vec: str, vec_id: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, xs): the vectors that take part, as arrays of whole numbers of any length."""
    each = F.col(vec).cast("array<double>")
    scaled = F.transform(each, lambda c: F.floor(c * F.lit(float(scale))))
    fits = F.forall(each, lambda c: F.coalesce(F.abs(c) * float(scale) < float(LIMIT - offset), F.lit(False)))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(fits, each).alias("_each"))
            .filter("_each is not null").select("vec_id", F.col("_each"))
            .select("vec_id", F.transform("_each", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset).cast("long"))
                    .alias("xs")))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.asarray(batch.column("xs").flatten(), dtype=np.int64).reshape(-1, d)


def _added(rows: DataFrame, partial, d: int) -> np.ndarray:
    """Sums over all tasks of the matrix (lines of ``d`` numbers) that ``partial`` makes of a task's batches."""

    def lines(batches):
        total = partial(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist())],
                                             names=["i", "line"])

    kind = "array<long>" if partial.__name__ == "sums" else "array<double>"
    cells = rows.mapInArrow(lines, f"i int, line {kind}").select("i", F.posexplode("line").alias("j", "v"))
    out = np.zeros((d + 1, d), np.int64 if kind == "array<long>" else np.float64)
    got = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("v").to_numpy()
    return out


def totals(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """(n, S): the number of vectors and their sum by dimension, exact."""

    def sums(batches):
        out = np.zeros((2, d), np.int64)
        for batch in batches:
            out[0] += _matrix(batch, d).sum(axis=0)
            out[1, 0] += batch.num_rows
        return out

    got = _added(rows, sums, d)
    return int(got[1, 0]), got[0]


def covariance(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Products of the centred vectors, divided by n."""
    d, mean = len(sums), sums / n

    def products(batches):
        out = np.zeros((d, d))
        for batch in batches:
            xs = _matrix(batch, d)
            for at in range(0, len(xs), ROWS):
                own = xs[at:at + ROWS] - mean
                out += own.T @ own
        return out

    v = _added(rows, products, d)[:d] / n
    return (v + v.T) / 2


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix by Householder reflections.

    Row j of the reflectors is the unit vector u of the reflection 1 - 2 u u' that clears
    column j below the off-diagonal (zero where there is nothing to clear).
    """
    a, d = a.copy(), len(a)
    units = np.zeros((max(0, d - 2), d))
    for j in range(d - 2):
        x = a[j + 1:, j]
        size = np.abs(x[1:]).max(initial=0.0)
        if size == 0.0:
            continue
        u = x / max(size, abs(x[0]))
        u[0] += np.copysign(np.sqrt(u @ u), u[0])
        u /= np.sqrt(u @ u)
        units[j, j + 1:] = u
        # Both sides at once: A - u q' - q u' with q = 2 (A u - (u' A u) u).
        part = a[j + 1:, j + 1:]
        p = part @ u
        q = 2.0 * (p - (u @ p) * u)
        part -= np.outer(u, q) + np.outer(q, u)
        a[j + 1:, j] -= 2.0 * u * (u @ a[j + 1:, j])
        a[j, j + 1:] = a[j + 1:, j]
    return np.diag(a).copy(), np.diag(a, -1).copy(), units


def below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each value of ``at``."""
    least = np.finfo(np.float64).tiny * max(1.0, float((off ** 2).max(initial=0.0)))
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for i, x in enumerate(diag):
        q = x - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its bounds are neighbours."""
    d = len(diag)
    reach = np.abs(np.concatenate(([0.0], off))) + np.abs(np.concatenate((off, [0.0])))
    low, high = np.full(k, (diag - reach).min()), np.full(k, (diag + reach).max())
    high += EPS * np.abs(high) + np.finfo(np.float64).tiny
    rank = d - np.arange(k)  # the j-th largest has this many eigenvalues at or below it
    for _ in range(2100):
        mid = low + (high - low) / 2
        if np.all((mid <= low) | (mid >= high)):
            break
        over = below(diag, off, mid) >= rank
        high, low = np.where(over, mid, high), np.where(over, low, mid)
    return low + (high - low) / 2


def _solver(diag: np.ndarray, off: np.ndarray, value: float):
    """Solves (T - value) x = b by elimination with row exchanges; a zero pivot counts as rounding."""
    d = len(diag)
    scale = max(np.abs(diag).max(), np.abs(off).max(initial=0.0), np.finfo(np.float64).tiny)
    main, up, up2 = diag - value, np.append(off, 0.0), np.zeros(d)
    factor, swapped = np.zeros(d), np.zeros(d, bool)
    for i in range(d - 1):
        low = off[i]
        if abs(low) > abs(main[i]):
            swapped[i] = True
            factor[i] = main[i] / low
            main[i], up[i], up2[i], main[i + 1], up[i + 1] = (
                low, main[i + 1], up[i + 1], up[i] - factor[i] * main[i + 1], -factor[i] * up[i + 1])
        else:
            if main[i] == 0.0:
                main[i] = EPS * scale
            factor[i] = low / main[i]
            main[i + 1] -= factor[i] * up[i]
    if abs(main[-1]) < EPS * scale:
        main[-1] = np.copysign(EPS * scale, main[-1])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(d - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i] - factor[i] * x[i + 1]
            else:
                x[i + 1] -= factor[i] * x[i]
        for i in range(d - 1, -1, -1):
            rest = x[i]
            if i + 1 < d:
                rest -= up[i] * x[i + 1]
            if i + 2 < d:
                rest -= up2[i] * x[i + 2]
            x[i] = rest / main[i]
        return x

    return solve


def eigenvectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix by inverse iteration.

    A vector is made orthogonal to those before it in its cluster on every step, twice, so that
    equal eigenvalues get independent vectors.
    """
    rng, out = np.random.default_rng(13), np.zeros((len(values), len(diag)))
    scale = max(np.abs(diag).max(), np.abs(off).max(initial=0.0))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * scale:
            first = k
        # Values of one cluster are kept apart, or the same solve would give the same direction.
        solve = _solver(diag, off, value - (k - first) * 4 * EPS * scale)
        x = rng.standard_normal(len(diag))
        for _ in range(6):
            for _ in range(2):
                x -= out[first:k].T @ (out[first:k] @ x)
            x = solve(x / np.abs(x).max())
        for _ in range(2):
            x -= out[first:k].T @ (out[first:k] @ x)
        out[k] = x / np.sqrt(x @ x)
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of a symmetric matrix, the ``k`` largest, falling.

    Values that rounding cannot tell from zero are left out.
    """
    size = float(np.abs(a).max(initial=0.0))
    if size == 0.0:
        return np.zeros(0), np.zeros((0, len(a)))
    diag, off, units = tridiagonal(a / size)
    values = leading_eigenvalues(diag, off, min(k, len(a)))
    values = values[values > len(a) * EPS * max(values.max(), 0.0) * 8]
    vectors = eigenvectors(diag, off, values)
    for j in range(len(units) - 1, -1, -1):  # the last reflection first
        vectors -= 2.0 * np.outer(vectors @ units[j], units[j])
    return values * size, vectors


def _deviations(xs: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sum of (n x - S)^2 by row; None where it does not fit 63 bits."""
    rough = ((xs.astype(np.float64) * n - sums) ** 2).sum(axis=1)
    safe = np.abs(xs).max(initial=0) * float(n) < 2.0 ** 62
    out: list[int | None] = []
    if safe:
        own = xs * n - sums
        out = [int(v) for v in np.where(rough < 2.0 ** 62, (own * own).sum(axis=1), 0)]
    for i in np.flatnonzero(rough >= 2.0 ** 62) if safe else range(len(xs)):
        v = sum((int(x) * n - int(s)) ** 2 for x, s in zip(xs[i], sums, strict=True))
        v = v if v < 1 << 63 else None
        if safe:
            out[i] = v
        else:
            out.append(v)
    return out


def whiten(vectors: DataFrame, k: int = 8, scale: int = 1024, offset: int = 100_000, vec: str = "embedding",
           vec_id: str = "vec_id") -> DataFrame:
    """One row per vector that takes part and component: vec_id, component, n, deviation, whitened,
    explained, identity_error (as the module describes them)."""
    prepare(vectors, vec, vec_id)
    empty = vectors.sparkSession.createDataFrame([], (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"))
    rows = write_stage(whole_numbers(vectors, vec, vec_id, scale, offset), "vectors")
    most = rows.groupBy(F.size("xs").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None or most.d == 0:
        return empty
    rows = rows.filter(F.size("xs") == most.d)
    n, sums = totals(rows, most.d)
    v = covariance(rows, n, sums)
    values, axes = leading(v, k)
    if not len(values):
        return empty
    mean, weights = sums / n, (axes / np.sqrt(values)[:, None]).T.copy()

    def project(batches):
        for batch in batches:
            if batch.num_rows:
                xs = _matrix(batch, len(sums))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(_deviations(xs, n, sums), pa.int64()),
                     pa.array(((xs - mean) @ weights).tolist(), pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "z"])

    out = write_stage(rows.mapInArrow(project, "vec_id long, deviation long, z array<double>"), "whitened")
    error = identity_error(out, len(values))
    shares = F.array(*[F.lit(float(x)) for x in values / np.trace(v)])
    return reread(out).select("vec_id", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", shares[F.col("i")].alias("explained"), F.lit(error).alias("identity_error"))


def identity_error(whitened: DataFrame, k: int, z: str = "z") -> float:
    """Largest absolute entry of the covariance of ``z`` minus the identity, centred first."""
    def entry(i: int) -> Column:
        return F.col(z)[i]

    means = whitened.agg(*[F.avg(entry(i)).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = whitened.agg(*[F.avg((entry(i) - means[i]) * (entry(j) - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, got, strict=True))
