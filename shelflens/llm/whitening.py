"""Whitening components by shifted CholeskyQR.

The rows to fit on are the distinct whole-number vectors, staged once.  Their
exact sums give the mean; then each pass is one distributed Gram matrix: tasks
centre their rows, carry them through the triangular solves of the passes so
far, multiply, and emit one small matrix each.  The Cholesky factor of the sum
makes the rows orthogonal, up to rounding; the first pass is shifted, so that it
succeeds for any rows, and repeated passes mend what the shift and the
condition of the rows cost.  The product of the factors is the R of the centred
rows, and its SVD gives the components: no covariance is ever decomposed.

What is collected is bounded by the square of a vector's length, not by rows:
task matrices are summed in `REDUCERS` tasks first.

Defined cases: rows whose vector is null or holds null or non-finite entries are
dropped; equal vectors are fitted once, and every row is returned; vectors are
only compared with vectors of their own length, each length is fitted apart;
components without variance (beyond rounding) are left out, so rows of a length
with a single vector, and empty vectors, give no row; equal eigenvalues give
some basis of their space; an empty table gives an empty result; a `deviation`
that does not fit 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..staging import stage, unstage

SCALE = 256
PASSES = 4
REDUCERS = 8
#: Rows centred and solved at once.
BLOCK = 4096
_EPS = np.finfo(np.float64).eps


@dataclass(frozen=True)
class Whitening:
    """What was fitted on the vectors of one length; `sums` are exact."""

    dim: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray  # a row per component, falling eigenvalue
    trace: float
    identity_error: float  # largest entry of the whitened fit rows' covariance minus the identity, measured on them

    @property
    def mean(self) -> np.ndarray:
        return np.array([_ratio(s, self.n) for s in self.sums])


def _whole(scaled: Column) -> Column:
    """Floor as a double; `F.floor` goes through a 64-bit number, and from 2**52 on every double is whole."""
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)


def whole_vectors(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`vec_id`, `dim`, `x` (floor of scale times entry, as doubles) of the rows that remain."""
    v = vectors[vector_col].cast("array<double>")
    sound = v.isNotNull() & ~F.exists(
        v, lambda e: e.isNull() | F.isnan(e) | (F.abs(scale * e) == float("inf"))
    )
    rows = vectors.where(sound)
    return rows.select(
        vectors[id_col].alias("vec_id"), F.size(v).alias("dim"), F.transform(v, lambda e: _whole(scale * e)).alias("x")
    )


def fit(
    vectors: DataFrame, components: int = 4, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> list[Whitening]:
    """The model of each length of vector, over the distinct vectors of `whole_vectors`."""
    whole = whole_vectors(vectors, scale, id_col, vector_col).where("dim > 0")
    distinct = stage(whole.select("dim", "x").distinct(), "distinct-vectors")
    dims = sorted(row.dim for row in distinct.select("dim").distinct().collect())
    models = [_fit(distinct.where(F.col("dim") == d).select("x"), d, components) for d in dims]
    unstage(distinct)
    return models


def _fit(rows: DataFrame, dim: int, components: int) -> Whitening:
    n, sums = _exact_sums(rows, dim)
    mean = np.array([_ratio(s, n) for s in sums])
    factors: list[np.ndarray] = []
    for _ in range(PASSES):
        done = tuple(factors)
        gram = _summed(rows, lambda x: _gram(orthogonal_rows(x - mean, done)), dim, dim)
        if not gram.any():  # rows without variance
            return Whitening(dim, n, tuple(sums), np.zeros(0), np.zeros((0, dim)), 0.0, 0.0)
        if factors and np.abs(gram - np.eye(dim)).max() <= 4 * dim * _EPS:
            break
        # Shifted in the first pass, later only where rounding or missing rank asks for it.
        factors.append(shifted_cholesky(gram, n, shifted=not factors))
    r = np.eye(dim)
    for factor in factors:
        r = factor @ r
    _, sigma, axes = np.linalg.svd(r)
    eigenvalues = sigma**2 / n
    # A direction without variance is left with rounding alone, far below this.
    kept = min(components, int((sigma > sigma[0] * 1024 * dim * _EPS).sum()))
    axes, eigenvalues, trace = axes[:kept], eigenvalues[:kept], float(eigenvalues.sum())
    axes[axes[np.arange(kept), np.abs(axes).argmax(1)] < 0] *= -1
    error = 0.0
    if kept:
        basis = axes.T / np.sqrt(eigenvalues)
        white = _summed(rows, lambda x: _gram((x - mean) @ basis), kept, dim) / n
        error = float(np.abs(white - np.eye(kept)).max())
    return Whitening(dim, n, tuple(sums), eigenvalues, axes, trace, error)


def shifted_cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with RᵀR = gram, or gram plus a small multiple of one.

    The shift is that of shifted CholeskyQR, 11 (m n + n (n + 1)) u times the
    squared norm, kept below what would drown the small directions of huge tables.
    """
    dim = len(gram)
    norm = float(np.linalg.norm(gram, 2))
    shift = min(11 * (dim * n + dim * (dim + 1)) * _EPS / 2, 1e-8) * norm if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(dim)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 4 * dim * _EPS * norm)


def orthogonal_rows(rows: np.ndarray, factors: tuple[np.ndarray, ...]) -> np.ndarray:
    """`rows` times the inverse of each upper triangular factor in turn, by forward substitution."""
    for r in factors:
        solved = np.empty_like(rows)
        for j in range(rows.shape[1]):
            solved[:, j] = (rows[:, j] - solved[:, :j] @ r[:j, j]) / r[j, j]
        rows = solved
    return rows


def _gram(rows: np.ndarray) -> np.ndarray:
    return rows.T @ rows


def _ratio(total: int, n: int) -> float:
    return total / n  # of Python's whole numbers: rounded once


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], side: int, dim: int) -> np.ndarray:
    """Sum over all blocks of rows of a side x side matrix."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for at in range(0, len(x), BLOCK):
                part = of(x[at:at + BLOCK])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["m"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = _matrix(batch.column(0), side * side).sum(0)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["m"])

    parts = rows.mapInArrow(per_task, "m array<double>").repartition(REDUCERS).mapInArrow(together, "m array<double>")
    return sum((np.array(row.m) for row in parts.collect()), np.zeros(side * side)).reshape(side, side)


def _exact_sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and whole-number sum of every dimension, exact however large."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            n += len(x)
            if np.abs(x).max(initial=0) * len(x) < 2.0**62:
                part = x.astype(np.int64).sum(0).tolist()
            else:
                part = [sum(map(int, x[:, j])) for j in range(dim)]
            total = [a + b for a, b in zip(total, part, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([list(map(str, total))], pa.list_(pa.string()))], names=["n", "s"]
            )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            n += sum(batch.column(0).to_pylist())
            for sums in batch.column(1).to_pylist():
                total = [a + int(b) for a, b in zip(total, sums, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([list(map(str, total))], pa.list_(pa.string()))], names=["n", "s"]
            )

    kind = "n long, s array<string>"
    found = rows.mapInArrow(per_task, kind).repartition(REDUCERS).mapInArrow(together, kind).collect()
    return sum(row.n for row in found), [sum(int(row.s[j]) for row in found) for j in range(dim)]


def whiten(
    vectors: DataFrame, models: list[Whitening], scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row per row and component: `vec_id`, `dim`, `component`, `n`, `deviation`, `whitened`, `explained`,
    `identity_error`."""
    whole = whole_vectors(vectors, scale, id_col, vector_col)
    by_dim = {m.dim: m for m in models}
    schema = T.StructType([
        whole.schema["vec_id"], T.StructField("dim", T.IntegerType()), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")],
    ])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                kept = len(by_dim[dim].eigenvalues) if dim in by_dim else 0
                if not kept:
                    continue
                model = by_dim[dim]
                at = np.flatnonzero(dims == dim)
                x = _matrix(batch.column(2).take(pa.array(at)), dim)
                white = ((x - model.mean) @ model.components.T) / np.sqrt(model.eigenvalues)
                rows = len(at) * kept
                each = pa.array(np.repeat(np.arange(len(at)), kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)).take(each), pa.array(np.full(rows, dim, np.int32)),
                     pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(at))), pa.array(np.full(rows, model.n)),
                     deviations(x, model).take(each), pa.array(white.ravel()),
                     pa.array(np.tile(model.eigenvalues / model.trace, len(at))),
                     pa.array(np.full(rows, model.identity_error))],
                    names=schema.names,
                )

    return whole.mapInArrow(project, schema)


def deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over dimensions of (n x - S)², exact; null where it does not fit 64 bits."""
    if model.n * float(np.abs(x).max(initial=0)) + max(map(abs, model.sums)) < 2.0**62:
        away = model.n * x.astype(np.int64) - np.array(model.sums, np.int64)
        rough = np.square(away.astype(np.float64)).sum(1)
        # Where the sum fits, so does every square; where it does not, the products wrap and are not used.
        exact = np.square(away).sum(1)
    else:
        rough, exact = np.full(len(x), 2.0**63), np.zeros(len(x), np.int64)
    none = rough > 2.0**63 * (1 + 1e-9)
    for i in np.flatnonzero((rough > 2.0**63 * (1 - 1e-9)) & ~none):
        total = sum((model.n * int(e) - s) ** 2 for e, s in zip(x[i], model.sums, strict=True))
        none[i] = total >= 1 << 63
        exact[i] = 0 if none[i] else total
    return pa.array(exact, mask=none)
