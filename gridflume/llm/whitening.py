"""Embedding whitening: exact distributed moments, and eigenvectors refined from single to double precision.

Entries become integers, so sums and sums of products are exact, whatever their order. Tasks add up
what is left of a vector after a whole-number centre is taken off, with one matrix product a batch, and
Spark adds their parts by matrix row. The covariance is then a matrix of exact fractions, no larger
than the dimension squared, of which the driver takes eigenvectors in float32. Ogita's and Aishima's
iteration corrects them with products in extended precision: it measures how far the vectors are from
orthonormal and from diagonalising, and takes both errors off to second order. Eigenvalues too close
for that are a cluster: their own small problem is solved about their mean, which tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

COMPONENTS = 4
SCALE = 256.0
#: Rows whose products are added at once.
ROWS = 4096
ROUNDS = 40
#: A component of less than this part of the largest variance has none.
LEAST_VARIANCE = 1e-14


def integers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dims`` finite entries whose integers fit a long, and those rows' integers."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float), nan=-1)
    entries = lists.flatten()
    values = entries.to_numpy(zero_copy_only=False).astype(float)
    values[entries.is_null().to_numpy(zero_copy_only=False)] = np.nan
    per_row = np.maximum(sizes, 0).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), per_row)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(values * SCALE)
        bad = ~(np.abs(x) < 2.0**63)
    good = sizes == dims
    good[row[bad]] = False
    return good, x[good[row]].reshape(-1, dims).astype(np.int64)


def _fit_rows(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, x = integers(b.column(0), dims)
            offsets = pa.array(np.arange(0, x.size + 1, dims, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))], names=["x"])

    return run


def _of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def _exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` in whole numbers of any size."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * len(a)
    if most < 2.0**53:
        return np.rint(a.T.astype(float) @ b.astype(float)).astype(np.int64).astype(object)
    return a.T.astype(object) @ b.astype(object)


def _moments(dims: int, centre: list[int]):
    """Sums of (1, d) (1, d)^T over a task's vectors, with d = x - centre; a row for each row of the matrix."""
    shift = np.array(centre, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1), object)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                x = _of(b.slice(at, ROWS), dims)
                d = x - shift.astype(np.int64) if np.abs(x.astype(float)).max() < 2.0**61 else x.astype(object) - shift
                d = np.concatenate([np.ones((len(d), 1), d.dtype), d], axis=1)
                total = total + _exact_product(d, d)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array([[str(v) for v in r] for r in total], pa.list_(pa.string()))], names=["i", "sums"])

    return run


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.array([int(v) for v in s], object) for s in parts["sums"])
    return pd.DataFrame({"i": parts["i"].iloc[:1], "sums": [[str(v) for v in total]]})


def _summed(fit: DataFrame, dims: int, centre: list[int]) -> np.ndarray:
    """The moments of all tasks; what arrives is as large as the dimension squared."""
    parts = fit.mapInArrow(_moments(dims, centre), "i int, sums array<string>")
    rows = parts.groupBy("i").applyInPandas(_added, "i int, sums array<string>").collect()
    out = np.zeros((dims + 1, dims + 1), object)
    for r in rows:
        out[r["i"]] = [int(v) for v in r["sums"]]
    return out


def _extended(above: int, below: int) -> np.longdouble:
    high = above / below
    return np.longdouble(high) + np.longdouble(float(Fraction(above, below) - Fraction(high)))


def covariance(n: int, first: list[int], second: np.ndarray) -> np.ndarray:
    """The covariance, divisor ``n``, from exact sums of centred vectors and of their products, in extended precision."""
    out = np.zeros(second.shape, np.longdouble)
    for i, j in zip(*np.triu_indices(len(first)), strict=True):
        out[i, j] = out[j, i] = _extended(n * second[i, j] - first[i] * first[j], n * n)
    return out


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    order = np.argsort(values)[::-1]
    cuts = np.flatnonzero(values[order][:-1] - values[order][1:] > apart) + 1
    return np.split(order, cuts)


def refined(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, as longdouble.

    From float32 eigenvectors by refinement in extended precision. Raises ArithmeticError where it
    does not settle to double precision.
    """
    size = float(np.abs(matrix).max(initial=0))
    if not size:
        return np.zeros(len(matrix), np.longdouble), np.eye(len(matrix), dtype=np.longdouble)
    scale = np.longdouble(2.0) ** -np.frexp(size)[1]
    a = matrix.astype(np.longdouble) * scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm = float(np.linalg.norm(a.astype(float), 2))
    eye = np.eye(len(a), dtype=np.longdouble)
    small = 4 * len(a) * float(np.finfo(np.longdouble).eps)
    before = np.inf
    for _ in range(ROUNDS):
        r, s = eye - x.T @ x, x.T @ a @ x
        # symmetric to the last bit, or the division by small gaps turns rounding into a loss of orthogonality
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        left = max(float(np.abs(off).max()) / norm, float(np.abs(r).max()))
        if left < small or (left < 1e-17 and left >= before / 2):
            break
        before = left
        apart = 2 * (float(np.linalg.norm(off.astype(float))) + norm * float(np.linalg.norm(r.astype(float))))
        error = r / 2
        clusters = _clusters(values, max(apart, small * norm))
        of = np.empty(len(a), int)
        for k, members in enumerate(clusters):
            of[members] = k
        far = of[:, None] != of[None, :]
        gap = np.where(far, values[None, :] - values[:, None], 1)
        error = np.where(far, (s + values[None, :] * r) / gap, error)
        x = x + x @ error
        for members in clusters:
            if len(members) > 1:
                x[:, members] = x[:, members] @ _turned(a, x[:, members])
    # what decides is the result, not how the rounds went
    values = np.diag(x.T @ a @ x).copy()
    wrong = max(float(np.abs(a @ x - x * values).max()), float(np.abs(x.T @ x - eye).max()))
    if wrong > 4e-16 * len(a):
        raise ArithmeticError(f"eigenvectors did not settle: {wrong:.1e}")
    order = np.argsort(values)[::-1]
    x = x[:, order]
    return values[order] / scale, x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])


def _turned(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The turn of a cluster's vectors that diagonalises their own problem, solved about its mean value."""
    # first to orthonormal, for the turn is not to take up what is wrong with the basis
    basis = x + x @ (np.eye(x.shape[1], dtype=np.longdouble) - x.T @ x) / 2
    own = basis.T @ (a @ basis)
    own = (own + own.T) / 2
    own = own - np.eye(len(own), dtype=np.longdouble) * (np.trace(own) / len(own))
    size = float(np.abs(own).max())
    if not size:
        return np.eye(len(own), dtype=np.longdouble)
    turn = np.linalg.eigh((own / size).astype(float))[1][:, ::-1].astype(np.longdouble)
    for _ in range(2):
        turn = turn + turn @ (np.eye(len(own), dtype=np.longdouble) - turn.T @ turn) / 2
    return turn


@dataclass
class Whitening:
    """A fitted transform: vectors of the fit list, their sums, and the components that have variance."""

    dims: int
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly; whole numbers of any size where a long may not hold them or their sum of squares."""
        most = self.n * np.abs(x.astype(float)).max(initial=0) + max((abs(float(s)) for s in self.sums), default=0)
        if self.dims * most**2 < 2.0**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(float) / self.n) @ self.components / np.sqrt(self.values)


def _whitened_moments(model: Whitening):
    """Sums of (1, y) (1, y)^T over a task's whitened vectors; their mean is zero but for rounding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values) + 1
        total = np.zeros((k, k))
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                y = model.whitened(model.centred(_of(b.slice(at, ROWS), model.dims)))
                y = np.concatenate([np.ones((len(y), 1)), y], axis=1)
                total += y.T @ y
        i, j = np.indices((k, k), np.int32).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], names=["i", "j", "total"])

    return run


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of each distinct vector once; None without a usable vector."""
    # the lengths that vectors have are as many as kinds of models; the one most of them have counts
    lengths = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).head()
    if lengths is None:
        return None
    dims = lengths["dims"]
    distinct = staged(vectors.select(column).mapInArrow(_fit_rows(dims), "x array<long>").distinct(), "fit_list")
    about_zero = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("mean")).collect()
    if not about_zero:
        return None
    centre = [0] * dims
    for r in about_zero:
        centre[r["i"]] = round(r["mean"])
    moments = _summed(distinct, dims, centre)
    n, first = int(moments[0, 0]), [int(v) for v in moments[0, 1:]]
    v = covariance(n, first, moments[1:, 1:])
    values, vectors_of = refined(v)
    kept = min(components, int((values > LEAST_VARIANCE * max(values[0], 0)).sum())) if values[0] > 0 else 0
    sums = [s + n * c for s, c in zip(first, centre, strict=True)]
    model = Whitening(dims, n, sums, vectors_of[:, :kept].astype(float), values[:kept].astype(float), float(np.trace(v)))
    if kept:
        rows = distinct.mapInArrow(_whitened_moments(model), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
        m = np.zeros((kept + 1, kept + 1))
        for r in rows:
            m[r["i"], r["j"]] = r["total"]
        mean = m[0, 1:] / n
        model.identity_error = float(np.abs(m[1:, 1:] / n - np.outer(mean, mean) - np.eye(kept)).max())
    return model


def _transformed(model: Whitening, ids: pa.DataType):
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, x = integers(b.column(1), model.dims)
            centred = model.centred(x)
            squares = (centred**2).sum(axis=1)
            fits = pa.array([int(s) if s < 2**63 else None for s in squares], pa.int64()) if squares.dtype == object else pa.array(squares)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).filter(pa.array(good)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, model.n)), fits.take(each), pa.array(model.whitened(centred).reshape(-1)),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def transformed(vectors: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """One row for each usable vector and component, as ``whitened`` has them."""
    ids = vectors.select("vec_id")
    schema = f"vec_id {ids.schema[0].dataType.simpleString()}, {_RESULT}"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    return vectors.select("vec_id", column).mapInArrow(_transformed(model, ids.schema[0].dataType), schema)


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows of vec_id, component, n, deviation, whitened, explained and identity_error.

    Vectors that are null or hold null or non-finite entries give no rows. Nor do those of another length
    than most have (of equally frequent lengths the larger one), empty ones, and those of entries beyond a
    long once scaled: they have no integers to be compared by. Equal vectors count once in the fit and give a row each,
    as do repeated rows; null ids stay. Components without variance are left out, so an empty table, a
    single vector or equal ones give no rows. ``deviation`` is null where it is beyond a long. Each
    component's sign makes its entry of largest magnitude positive; of equal eigenvalues any basis.
    """
    return transformed(vectors, fit(vectors, column, components), column)
