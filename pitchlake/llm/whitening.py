"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

Entries become whole numbers x = floor(64 c) + 1000000. Sums and centred products of these are
whole numbers too and are added up by Spark without rounding, a row for each pair of
dimensions, so the covariance is exact whatever the order of the rows; only it reaches the
driver. Its eigenvectors are first taken in float32, then corrected there by the
matrix-multiplication iteration of Ogita and Aishima in extended precision: from R = I - X'X
and S = X'VX follow new eigenvalues and a correction of all vectors at once, and the
number of right digits doubles at each step. Where eigenvalues lie closer than the iteration
can part, the vectors of such a cluster span its space but may be any basis of it; a small
eigenproblem within that space parts them, and the iteration goes on.

Defined results: vectors that are null, hold null or non-finite entries, or entries beyond long
integers are dropped, and so are rows without a vec_id. Vectors of each length are whitened on
their own. Components without variance (eigenvalue not above rounding) are left out, so one row
or equal rows give no result. Repeated rows count as often as they come. deviation is null
where it does not fit in a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm import vectors

FACTOR, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Iterations of the refinement at most; it ends when corrections are at rounding.
STEPS = 12
#: Gaps below this share of the matrix's size are left to the small eigenproblem: the iteration
#: divides the rounding of its products by the gap.
GAP = 1e-12
WIDE = np.longdouble


# --- eigenvectors ------------------------------------------------------------------------
def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more sorted eigenvalues whose neighbours lie within the gap."""
    order = np.argsort(values, kind="stable")
    ends = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [run for run in np.split(order, ends) if len(run) > 1]


def refined(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of a symmetric matrix from rough eigenvectors ``x``.

    All products are in extended precision. Pairs of eigenvalues closer than the error of S
    get the symmetric correction alone (half of R); a cluster they form is parted by
    the eigenvectors of V within its space, relative to its own mean.
    """
    v, x = v.astype(WIDE), x.astype(WIDE)
    eye = np.eye(len(v), dtype=WIDE)
    size = np.sqrt((v * v).sum())
    eps = np.finfo(WIDE).eps
    last = np.inf
    for _ in range(STEPS):
        r = eye - x.T @ x
        s = x.T @ v @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        near = max(GAP * size, 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())))
        apart = values[None, :] - values[:, None]
        close = np.abs(apart) <= near
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, apart))
        np.fill_diagonal(e, np.diag(r) / 2)
        x = x + x @ e
        for run in clusters(values, float(near)):
            x[:, run] = x[:, run] @ parted(v, x[:, run])
        moved = float(np.abs(e).max())
        if moved <= 8 * eps or last < 1e-3 and moved > last / 2:
            break
        last = moved
    for _ in range(2):  # what the last corrections left of non-orthogonality
        x = x @ (1.5 * eye - x.T @ x / 2)
    values = np.diag(x.T @ v @ x) / np.diag(x.T @ x)
    return values, x / np.sqrt((x * x).sum(axis=0))


def parted(v: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rotation that makes nearly equal eigenvectors ``x`` eigenvectors of V within their space.

    The problem is taken relative to the cluster's mean eigenvalue, where the differences are
    large against rounding, and solved in double precision by the same refinement of an
    orthonormal start.
    """
    q = x.T @ x
    root = 1.5 * np.eye(len(q), dtype=WIDE) - q / 2  # nearly the inverse square root of q
    basis = x @ root
    inner = basis.T @ v @ basis
    mean = np.trace(inner) / len(inner)
    inner = inner - mean * np.eye(len(inner), dtype=WIDE)
    scale = np.abs(inner).max()
    if scale == 0:
        return root
    _, turn = np.linalg.eigh((inner / scale).astype(np.float64))
    turn = turn.astype(WIDE)
    turn = turn @ (1.5 * np.eye(len(q), dtype=WIDE) - turn.T @ turn / 2)
    return root @ turn


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) to double precision."""
    scale = float(np.abs(v).max()) if v.size else 0.0
    if not scale:
        return np.zeros(len(v)), np.eye(len(v))
    rough = np.linalg.eigh((v / scale).astype(np.float32))[1]
    values, x = refined(v / WIDE(scale), rough)
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    lead = np.abs(x).argmax(axis=0)
    x = x * np.where(x[lead, np.arange(x.shape[1])] < 0, -1.0, 1.0)  # either sign is right: the largest entry is positive
    return (values[order] * WIDE(scale)).astype(np.float64), x


# --- sums over the cluster ---------------------------------------------------------------
def _whole(values) -> pa.Array:
    """Whole numbers as decimals of 38 digits."""
    if isinstance(values, np.ndarray) and values.dtype == np.int64:
        return pa.array(values).cast(pa.decimal128(38, 0))
    from decimal import Decimal

    return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))


def _numbers(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) for each length in a batch of (vec_id, embedding)."""
    known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
    out = []
    for rows, c in vectors.matrices(batch.column(1)):
        x, fits = vectors.scaled(c, FACTOR)
        rows = rows[fits]
        out.append((rows[known[rows]], x[known[rows]] + SHIFT))
    return [(rows, x) for rows, x in out if x.size]


def _added(table: DataFrame, values, kind: str) -> DataFrame:
    """Sum over all rows of what ``values`` gives for the matrix of a length: (dim, i, j, v).

    Each task adds up its own rows first, so a few numbers for each pair of dimensions move.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple] = {}
        for batch in batches:
            for _, x in _numbers(batch):
                dim = x.shape[1]
                i, j, v = values(dim, x)
                if dim in total:
                    v = total[dim][2] + v
                    if v.dtype == np.int64 and vectors.largest(v) >= 1 << 61:
                        v = v.astype(object)  # the next sum might not fit
                total[dim] = (i, j, v)
        for dim, (i, j, v) in total.items():
            out = pa.array(v) if v.dtype == np.float64 else _whole(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), out],
                ["dim", "i", "j", "v"])

    sums = table.select("vec_id", "embedding").mapInArrow(run, f"dim int, i int, j int, v {kind}")
    return sums.groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))


@dataclass
class Fit:
    """What whitening needs of all vectors of one length."""

    n: int
    sums: np.ndarray
    #: Columns project n*x - S on the components, divided by n and by their spread.
    projection: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def moments(table: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and the sum of each dimension, by length."""

    def values(dim, x):
        at = np.arange(-1, dim)  # -1: the number of vectors
        sums = x.sum(axis=0) if vectors.largest(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
        return at, np.zeros(dim + 1, np.int32), np.concatenate([np.array([len(x)], sums.dtype), sums])

    out: dict[int, dict[int, int]] = {}
    for r in _added(table, values, "decimal(38,0)").collect():  # a row for each dimension
        out.setdefault(r["dim"], {})[r["i"]] = int(r["v"])
    return {dim: (v[-1], [v[i] for i in range(dim)]) for dim, v in out.items() if dim}


def covariances(table: DataFrame, found: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Covariance of each length in extended precision, from exact centred products.

    Centred on the mean rounded to a whole number; what is left of the mean is taken off exactly.
    """
    centre = {dim: np.array([round(Fraction(s, n)) for s in sums], dtype=object) for dim, (n, sums) in found.items()}
    shared = table.sparkSession.sparkContext.broadcast(centre)

    def values(dim, x):
        c = shared.value[dim]
        y = x - c.astype(np.int64) if max(map(abs, c)) < 1 << 62 else x.astype(object) - c
        i, j = np.triu_indices(dim)
        if y.dtype == object or vectors.largest(y) >= 1 << 62:
            return i, j, (y.astype(object).T @ y.astype(object))[i, j]
        return i, j, vectors.product(np.ascontiguousarray(y.T), y)[i, j]

    products: dict[int, dict] = {}
    for r in _added(table, values, "decimal(38,0)").collect():  # a row for each pair of dimensions
        products.setdefault(r["dim"], {})[r["i"], r["j"]] = int(r["v"])
    out = {}
    for dim, (n, sums) in found.items():
        rest = [s - n * int(c) for s, c in zip(sums, centre[dim])]
        v = np.zeros((dim, dim), WIDE)
        for (i, j), p in products[dim].items():
            exact = Fraction(n * p - rest[i] * rest[j], n * n)
            high = float(exact)
            v[i, j] = v[j, i] = WIDE(high) + WIDE(float(exact - Fraction(high)))
        out[dim] = v
    return out


def _projected(fit: Fit, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n*x - S, exact, and the whitened vectors."""
    top = vectors.largest(x)
    if fit.n * top < 1 << 61:
        d = fit.n * x - fit.sums.astype(np.int64)
    else:
        d = fit.n * x.astype(object) - fit.sums
    return d, d.astype(np.float64) @ fit.projection


def fits(table: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Statistics and projections by length of vector; three passes over the vectors."""
    found = moments(table)
    out = {}
    for dim, v in covariances(table, found).items():
        n, sums = found[dim]
        values, x = eigen(v)
        trace = float(np.trace(v))
        kept = int((values[:components] > values[0] * dim * 1e-15).sum()) if trace > 0 else 0
        spread = np.sqrt(values[:kept])
        out[dim] = Fit(n, np.array(sums, dtype=object), x[:, :kept] / (spread * n), values[:kept] / (trace or 1))
    shared = table.sparkSession.sparkContext.broadcast(out)

    def values_of(dim, x):
        w = _projected(shared.value[dim], x)[1]
        k = w.shape[1]
        i, j = np.triu_indices(k)
        return (np.concatenate([np.full(k, -1), i]), np.concatenate([np.arange(k), j]),
                np.concatenate([w.sum(axis=0), (w.T @ w)[i, j]]))

    measured: dict[int, dict] = {}
    for r in _added(table, values_of, "double").collect():  # a row for each pair of components
        measured.setdefault(r["dim"], {})[r["i"], r["j"]] = r["v"]
    for dim, sums in measured.items():
        n = out[dim].n
        out[dim].identity_error = max(
            (abs(v / n - sums[-1, i] / n * sums[-1, j] / n - (i == j)) for (i, j), v in sums.items() if i >= 0), default=0.0)
    return out


def whitened(table: DataFrame, found: dict[int, Fit] | None = None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each component."""
    found = fits(table) if found is None else found
    shared = table.sparkSession.sparkContext.broadcast(found)  # a matrix of one length squared
    kind = table.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _numbers(batch):
                fit = shared.value[x.shape[1]]
                d, w = _projected(fit, x)
                k = w.shape[1]
                if not k:
                    continue
                top = vectors.largest(d)
                if top * top * d.shape[1] < 1 << 63:
                    deviation = pa.array((d.astype(np.int64) ** 2).sum(axis=1))
                else:
                    exact = (d.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([int(e) if e < 1 << 63 else None for e in exact], pa.int64())
                again = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)).take(again),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(again), fit.n, np.int64)), deviation.take(again), pa.array(w.ravel()),
                    pa.array(np.tile(fit.explained, len(rows))), pa.array(np.full(len(again), fit.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.select("vec_id", "embedding").mapInArrow(
        run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
