"""Whitening of embeddings: principal components from a pivoted Cholesky factor, turned by one-sided Jacobi rotations.

1. Every entry c becomes the long floor(scale * c) + offset. The fit list holds each distinct vector of longs once, so copies
   of a vector, however many, weigh as one; Spark drops them before and after the shuffle.
2. Tasks add up counts and sums, then the scatter of the centred vectors, and send one partial sum per matrix entry.
3. The covariance (dimensions squared, whatever the number of rows) is factored on the driver: Cholesky with the largest remaining
   diagonal as pivot gives V = L L', L triangular up to the order of its rows; it ends where nothing but rounding is left, so
   its columns are as many as the rank. One-sided Jacobi rotates pairs of columns of L until all are orthogonal: the squared norms
   are the eigenvalues of V and the normalised columns its eigenvectors, since V = (L J)(L J)' for every rotation J.
4. Rows are projected in tasks; the covariance of the whitened fit list is measured the same way and reported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.staging_area import stage

SWEEPS = 100  # of rotations; ten or so are enough, more than this stops the job
SMALL = 1e-15  # cosine of two columns that counts as orthogonal


class Whitening(NamedTuple):
    n: int  # vectors of the fit list
    sums: np.ndarray  # long, per dimension
    trace: float
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # one component per column
    error: float  # largest entry of the whitened fit list's covariance minus the identity


def usable(vector: str = "embedding") -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    entry = F.col(vector)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.coalesce(entry.isNotNull() & (F.size(entry) > 0) & ~bad, F.lit(False))


def whole_entries(vectors: DataFrame, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, x): vectors as longs, without those that are NULL, empty, or hold NULL or non-finite entries."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))
    return vectors.where(usable()).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as one matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[tuple[int, int], float]:
    """Entries of the sum of part(matrix) over all rows: one matrix per task, added by Spark per entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    sums = rows.select("x").mapInArrow(run, f"i long, j long, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r.i, r.j): r.v for r in sums.collect()}  # as many rows as the matrix has entries


def _square(entries: dict[tuple[int, int], float], d: int) -> np.ndarray:
    out = np.zeros((d, d))
    for (i, j), v in entries.items():
        out[i, j] = v
    return (out + out.T) / 2


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A factor L with V = L L': as many columns as V has rank, triangular when the rows are put in the order of the pivots."""
    d = len(v)
    left, chosen, factor = np.diag(v).copy(), np.zeros(d, bool), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(float(left.max(initial=0.0)), 0.0)
    for k in range(d):
        pivot = int(np.argmax(np.where(chosen, -np.inf, left)))
        if not left[pivot] > least:
            return factor[:, :k]
        column = (v[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[chosen] = 0.0
        column[pivot] = np.sqrt(left[pivot])
        factor[:, k] = column
        chosen[pivot] = True
        left -= column ** 2
    return factor


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs (each column meets every other once)."""
    seats = np.arange(n + n % 2)
    for _ in range(len(seats) - 1):
        a, b = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
        real = (a < n) & (b < n)
        yield a[real], b[real]
        seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of factor @ factor.T, eigenvalues falling: columns are rotated until orthogonal."""
    a = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in _rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            cosine = np.abs(xy) / np.sqrt(np.maximum(xx * yy, np.finfo(float).tiny))
            turn = cosine > SMALL
            worst = max(worst, float(cosine.max(initial=0.0)))
            with np.errstate(divide="ignore", over="ignore"):
                zeta = (yy - xx) / (2 * np.where(turn, xy, 1.0))
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if worst <= 4 * SMALL:
            break
    else:
        raise ArithmeticError(f"columns are not orthogonal after {SWEEPS} sweeps: cosine {worst}")
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], a[:, order] / np.sqrt(values[order])


def common_length(entries: DataFrame) -> DataFrame:
    """The vectors of the most frequent length (of equal counts, the smaller length)."""
    best = entries.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return entries.where(F.size("x") == (best.d if best else 0))


def fit(entries: DataFrame, components: int = 16) -> Whitening | None:
    """Components of the vectors of `whole_entries`, which must be of one length; None where there are none."""
    distinct = stage(entries.select("x").distinct(), "whitening")
    sums = _added(distinct, lambda x: np.concatenate([[len(x)], x.sum(0)]).reshape(1, -1), "long")
    if not sums:
        return None
    n, total = sums[0, 0], np.array([sums[0, j] for j in range(1, len(sums))], np.int64)
    mean = total / n

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = _square(_added(distinct, scatter, "double"), len(mean)) / n
    values, axes = one_sided_jacobi(pivoted_cholesky(covariance))
    values, axes = values[:components], axes[:, :components]
    model = Whitening(n, total, float(np.trace(covariance)), values, axes, 0.0)
    return model._replace(error=_identity_error(distinct, model)) if len(values) else model


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, measured over all its vectors."""
    sums = _added(distinct, lambda x: project(x, model).sum(0).reshape(1, -1), "double")
    mean = np.array([sums[0, j] for j in range(len(model.values))]) / model.n

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = project(x, model) - mean
        return centred.T @ centred

    covariance = _square(_added(distinct, scatter, "double"), len(mean)) / model.n
    return float(np.abs(covariance - np.eye(len(mean))).max())


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values, one row per vector and one column per component."""
    return ((x - model.sums / model.n) @ model.axes) / np.sqrt(model.values)


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - sums) ** 2 of every vector, exact; None where it is no 64-bit number."""
    away = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    most = model.n * away + max(map(abs, model.sums.tolist()), default=0)
    if most < 1 << 62 and x.shape[1] * int(np.abs(model.n * x - model.sums).max(initial=0)) ** 2 < 1 << 63:
        return ((model.n * x - model.sums) ** 2).sum(1).tolist()
    sums = model.sums.tolist()
    exact = (sum((model.n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [e if e < 1 << 63 else None for e in exact]


WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """vec_id and WHITENED: one row per usable vector and component, components numbered from 1 by falling eigenvalue.

    Vectors that are NULL, empty, hold NULL or non-finite entries, or are of another length than most (the smaller length if two are
    equally frequent) are left out. Rows that repeat a vec_id or a vector stay rows of their own; NULL ids stay. Columns other than
    vec_id and embedding are not read, whatever their names. There are at most as many components as the rank: none for an empty table
    or equal vectors. Components of equal eigenvalues are any orthogonal set. `deviation` is NULL where the exact sum is
    no 64-bit number; an entry whose long does not fit 64 bits stops the job.
    """
    entries = common_length(whole_entries(vectors, scale, offset))
    model = fit(entries, components)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    k = 0 if model is None else len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if k else 0, 4096):
                part = batch.slice(start, 4096)
                x, m = _matrix(part.column(1)), len(part)
                rows = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array(deviations(x, model), pa.int64()).take(rows),
                    pa.array(project(x, model).ravel()), pa.array(np.tile(model.values / model.trace, m)),
                    pa.array(np.full(m * k, model.error)),
                ], names=["vec_id", *(c.split()[0] for c in WHITENED.split(", "))])

    return entries.mapInArrow(run, f"vec_id {kind}, {WHITENED}")
