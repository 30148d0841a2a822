"""Whitening of vectors by FEAST contour integration.

The covariance of the scaled vectors is summed on the executors, centred first. Its
eigenvalues are cut into intervals at gaps, the number in each known from the
inertia of the shifted covariance (Sturm counts of its tridiagonal form). Each interval is
a task of its own: complex shifted solves at the nodes of a half circle
around it, weighted by Gauss-Legendre quadrature, project a random block onto the
interval's eigenspace, Rayleigh-Ritz takes the components from it, and the two
are repeated until the residuals are at rounding level. An interval that
does not hold as many components as its inertia count says stops the job, so
none is missed.

What reaches the driver is bounded by the width of the vectors: a sum per
dimension and the covariance, which executors add up in two levels.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this, far above what a double holds exactly, count as this.
HUGE = 1 << 61
#: Rows of the covariance in one block, partial sums of one block, nodes of a half circle, eigenvalues aimed at per interval.
BLOCK, SALT, NODES, FEW = 64, 32, 8, 8


# --------------------------------------------------------------------------- eigenpairs
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections."""
    a, n = np.array(v, float), len(v)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        norm = np.sqrt(x @ x)
        if norm == 0 or np.all(x[1:] == 0):
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.sqrt(x @ x)
        p = a[k + 1:, k + 1:] @ x
        w = p - (x @ p) * x
        a[k + 1:, k + 1:] -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, 1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, np.abs(off).max(initial=0.0)) ** 2
    count, pivot = np.zeros(len(shifts), int), np.ones(len(shifts))
    for i, d in enumerate(diagonal):
        pivot = d - shifts - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def intervals(v: np.ndarray, most: int, steps: int = 24) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top down, which together hold at least the ``most`` largest
    eigenvalues above rounding level, or all there are."""
    d, off = tridiagonal(v)
    reach = np.zeros(len(d))
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    top = float((d + reach).max())
    zero = max(top, 0.0) * len(d) * 1e-14  # what rounding makes of a zero eigenvalue stays below
    rank = int(above(d, off, np.array([zero]))[0]) if top > 0 else 0
    if not rank:
        return []
    wanted = np.arange(1, min(rank, most + FEW) + 1)
    low, high = np.full(len(wanted), zero), np.full(len(wanted), top * (1 + 1e-9))
    for _ in range(steps):  # the k-th largest lies in (low, high]
        mid = (low + high) / 2
        over = above(d, off, mid) >= wanted
        low, high = np.where(over, mid, low), np.where(over, high, mid)
    gaps = low[:-1] - high[1:]  # between an eigenvalue and the next, where they are told apart
    clear = np.flatnonzero(gaps > 4 * top * 2.0 ** -steps) + 1
    ends = [k for k in clear if k >= min(rank, most)]
    last = int(ends[0]) if ends else len(wanted)
    if last == len(wanted) and last < rank:  # a cluster reaches beyond what was looked at: take all of it
        below = float(low[-1]) - 4 * top * 2.0 ** -steps
        bottom = max(below, zero)
    else:
        bottom = zero if last == rank else float((high[last] + low[last - 1]) / 2)

    def split(a: int, b: int) -> list[int]:
        inner = [int(k) for k in clear if a < k < b]
        if b - a <= FEW or not inner:
            return []
        cut = max(inner, key=lambda k: gaps[k - 1] * min(k - a, b - k))
        return [*split(a, cut), cut, *split(cut, b)]

    marks = [float(top * (1 + 1e-6)), *[float((high[k] + low[k - 1]) / 2) for k in split(0, last)], bottom]
    counts = above(d, off, np.array(marks))
    return [(lo, hi, int(n - m)) for hi, lo, m, n in zip(marks, marks[1:], counts, counts[1:]) if n > m]


def feast(v: np.ndarray, low: float, high: float, count: int, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` between ``low`` and ``high``, falling, and their unit eigenvectors as columns."""
    size, centre, radius = len(v), (low + high) / 2, (high - low) / 2
    block = min(size, max(count + 4, 2 * count))
    y = np.random.default_rng(size).normal(size=(size, block))
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    scale, best, found = np.abs(v).sum(1).max(), np.inf, None
    for _ in range(rounds):
        q = np.zeros((size, block))
        for x, w in zip(nodes, weights):
            turn = np.exp(-0.5j * np.pi * (x - 1))
            q += w / 2 * (radius * turn * np.linalg.solve((centre + radius * turn) * np.eye(size) - v, y)).real
        q, _ = np.linalg.qr(q)
        values, turns = np.linalg.eigh(q.T @ v @ q)
        vectors = q @ turns
        residual = np.sqrt(((v @ vectors - vectors * values) ** 2).sum(0))
        inside = np.flatnonzero((values > low) & (values <= high))
        if len(inside) >= count:  # mixtures of components on both sides may lie inside too, with large residuals
            inside = np.sort(inside[np.argsort(residual[inside], kind="stable")[:count]])[::-1]
            off = residual[inside].max()
            if off >= best / 2 and best < 1e-10 * scale:
                break
            if off < best:
                best, found = off, (values[inside], vectors[:, inside])
            if off < 1e-15 * scale:
                break
        y = vectors
    if found is None or best > 1e-9 * scale:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high} by inertia, not all found by contour integration")
    return found


def eigenpairs(rows: DataFrame, v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of ``v`` above rounding level and their eigenvectors; one task per interval.

    ``rows`` names the session. A last Rayleigh-Ritz step over all components makes
    those of neighbouring intervals orthogonal to rounding level.
    """
    todo = intervals(v, most)
    if not todo:
        return np.zeros(0), np.zeros((len(v), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, count in zip(*(b.column(c).to_pylist() for c in ("low", "high", "count"))):
                values, vectors = feast(v, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array([x.tobytes() for x in vectors.T], pa.binary())], ["value", "vector"])

    spark = rows.sparkSession
    spread = spark.createDataFrame(todo, "low double, high double, count int").repartition(len(todo), "low")
    found = spread.mapInArrow(run, "value double, vector binary").collect()
    if len(found) != sum(n for *_, n in todo):
        raise ArithmeticError("components and inertia counts differ")
    basis, _ = np.linalg.qr(np.stack([np.frombuffer(r.vector) for r in sorted(found, key=lambda r: -r.value)], axis=1))
    values, turns = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values)[:most]
    return values[order], (basis @ turns)[:, order]


# --------------------------------------------------------------------------- sums over the table
def _scaled(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return np.clip(np.floor(SCALE * x), -HUGE, HUGE).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""

    def run(batches):
        n, total = 0, [0] * width
        for b in batches:
            x = _scaled(b.column("vector"), width)
            n += len(x)
            parts = ((x >> 31).sum(0).tolist(), (x & (2 ** 31 - 1)).sum(0).tolist())
            total = [t + (hi << 31) + lo for t, hi, lo in zip(total, *parts)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array(map(Decimal, [n, *total]), pa.decimal128(38, 0))], ["i", "s"])

    found = rows.select("vector").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = {r.i: int(r.s) for r in found}
    return sums[-1], [sums[i] for i in range(width)]


def _centred(column: pa.Array, width: int, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n as doubles, the whole part of S / n taken off exactly."""
    whole, rest = zip(*(divmod(s, n) for s in sums))
    return (_scaled(column, width) - np.array(whole, np.int64)).astype(float) - np.array([r / n for r in rest])


def _covariance(rows: DataFrame, width: int, n: int, sums: list[int], turn: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, multiplied by ``turn`` if given. Blocks of rows of the
    matrix are added up in tasks, then in ``SALT`` parts, then whole."""
    size = width if turn is None else turn.shape[1]
    schema = T._parse_datatype_string("block int, salt int, sums binary")
    starts = range(0, size, BLOCK)

    def batch(blocks):
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in blocks], pa.int32()), pa.array([k[1] for k in blocks], pa.int32()),
                                           pa.array([m.tobytes() for m in blocks.values()], pa.binary())], schema.names)

    def multiply(batches):
        total = np.zeros((size, size))
        for b in batches:
            y = _centred(b.column("vector"), width, n, sums)
            y = y if turn is None else y @ turn
            total += y.T @ y
        salt = TaskContext.get().partitionId() % SALT
        yield batch({(i, salt): total[i: i + BLOCK] for i in starts})

    def add(batches):
        found = {}
        for b in batches:
            for i, salt, sums in zip(*(b.column(c).to_pylist() for c in schema.names)):
                found[i, salt] = found.get((i, salt), 0) + np.frombuffer(sums)
        if found:
            yield batch(found)

    parts = rows.select("vector").mapInArrow(multiply, schema)
    parts = parts.repartition("block", "salt").mapInArrow(add, schema).withColumn("salt", F.lit(0))
    found = {r.block: np.frombuffer(r.sums).reshape(-1, size) for r in parts.repartition("block").mapInArrow(add, schema).collect()}
    whole = np.concatenate([found[i] for i in starts]) / n
    return (whole + whole.T) / 2


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    An entry c counts as x = floor(64 c) + 1000000. Vectors that are null or hold null or non-finite
    entries are left out, and so are vectors of another length than most (of equally frequent
    lengths the smaller counts): the rest is the fit list of n vectors. ``component`` numbers the principal components
    from 1 by falling variance, ``whitened`` is the centred vector's part along one over its standard deviation,
    ``explained`` its share of all variance, ``deviation`` the exact sum over dimensions of (n x - S)^2, null where
    a long can't hold it, and ``identity_error`` how far the covariance of all whitened rows is from the identity.

    Components without variance beyond rounding (constant or dependent dimensions, fewer vectors than
    dimensions, equal vectors) are not returned; without any, and from an empty table, there are no
    rows. Of equal variances any basis may come. Entries beyond 2^61 once scaled count as that. Repeated rows
    and null ids are rows like others; further columns are ignored, whatever their names.
    """
    key = T.StructField(id_col, vectors.schema[id_col].dataType)
    schema = T.StructType([key, *T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    usable = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(usable)
    most = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    nothing = vectors.sparkSession.createDataFrame([], schema)
    if most is None or most.width == 0:
        return nothing
    width = most.width
    rows = rows.where(F.size("vector") == width)
    n, sums = _sums(rows, width)
    v = _covariance(rows, width, n, sums)
    values, axes = eigenpairs(rows, v, components)
    if not len(values):
        return nothing
    turn, explained = axes / np.sqrt(values), values / np.trace(v)
    error = float(np.abs(_covariance(rows, width, n, sums, turn) - np.eye(len(values))).max())

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                x, k = _scaled(b.column("vector"), width), len(values)
                out = _centred(b.column("vector"), width, n, sums) @ turn
                again = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(again), n)),
                     pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(again)), pa.array(out.ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(len(again), error))], schema.names)

    return rows.mapInArrow(run, schema)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None] | np.ndarray:
    far = max(abs(n * int(lim) - s) for s, lims in zip(sums, zip(x.min(0), x.max(0))) for lim in lims)
    if max(n * int(np.abs(x).max()), far * far * x.shape[1], max(map(abs, sums))) < 1 << 62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1)
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]
