"""Whitening of vectors: pivoted Cholesky of their centred scatter, then one-sided Jacobi on the triangular factor.

Entries become whole numbers floor(256 * c). The fit list holds each distinct vector of those once, found by a grouping
with map-side combining; its sums are exact, and the scatter is summed from differences to the mean, one matrix a task,
added up entry by entry in a shuffle. The driver gets numbers that depend on the dimension only: the sums, the scatter
and one matrix of the components' own covariance.

With P' A P = L L' (columns taken by the largest remaining diagonal entry), rotations J that make the columns of L J
orthogonal give L J = U S: column norms squared are the eigenvalues of A, normalised columns its eigenvectors, without
ever squaring L's condition.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped; shorter vectors count as if
they ended in zeros; whole numbers beyond +-2**62 stay at that; rows that repeat are scored each, ids of any kind, null
ones too; components of eigenvalue zero (within rounding) don't exist, so vectors that are all equal, a single vector
and an empty table give no rows; among equal eigenvalues any orthonormal choice may come; signs are such that a
component's largest entry is positive; a deviation that doesn't fit into a long is null; input columns besides the two
named are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, modest_batches
from .vectors import finite_rows, whole, widest

COMPONENTS = 4
BOUND = 1 << 62


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with a[order][:, order] = L L', L lower triangular with as many columns as a has rank."""
    a, size = np.array(a, np.float64), len(a)
    order, low = np.arange(size), np.zeros((size, size))
    least = size * np.finfo(np.float64).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(a.diagonal()[k:].argmax())
        if a[p, p] <= least:
            return order, low[:, :k]
        for rows in (order, low, a, a.T):
            rows[[k, p]] = rows[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return order, low


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns as rounds of disjoint pairs, as in a tournament."""
    ring = list(range(n)) + [n] * (n % 2)  # an odd column pauses
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:half], ring[half:][::-1]) if n not in (a, b)]
        yield np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """factor times a rotation that makes its columns orthogonal to working precision."""
    g = np.array(factor, np.float64)
    small = np.finfo(np.float64).eps * np.sqrt(max(len(g), 1))
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(g.shape[1]):
            x, y = g[:, p], g[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(c) > small * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            zeta = (b - a)[turn] / (2 * c[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cos = 1 / np.sqrt(1 + t * t)
            x, y = x[:, turn], y[:, turn]
            g[:, p[turn]], g[:, q[turn]] = cos * x - cos * t * y, cos * t * x + cos * y
        if not turned:
            break
    return g


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a positive semidefinite matrix above zero, falling, and its unit eigenvectors as columns."""
    order, low = pivoted_cholesky(scatter)
    g = one_sided_jacobi(low)
    norms = np.sqrt((g * g).sum(0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(g)
    vectors[order] = g[:, falling] / norms[falling]
    largest = np.abs(vectors).argmax(0)
    return norms[falling] ** 2, vectors * np.where(vectors[largest, np.arange(len(norms))] < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """n distinct vectors with sums per dimension; eigenvalues of their covariance and components as columns."""

    width: int
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - mean as doubles, rounded once, and n * x - sums exactly."""
        top = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        if top < BOUND // 2:
            exact = self.n * x - np.array(self.sums, np.int64)
        else:
            exact = self.n * x.astype(object) - np.array(self.sums, object)
        return (exact / self.n).astype(np.float64), exact

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whitened scores of each component, and n * x - sums."""
        c, exact = self.centred(x)
        return c @ self.components / np.sqrt(self.values), exact


def fit_list(rows: DataFrame, width: int) -> DataFrame:
    """(x): each distinct whole-number vector once, as bytes of 16-bit numbers where they fit, else of 64-bit ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = whole(b.column(0), width, BOUND)
            short = (np.abs(x) < 1 << 15).all(1)
            raw = [(r.astype("<i2") if s else r.astype("<i8")).tobytes() for r, s in zip(x, short)]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["x"])

    return materialize(rows.select("v").mapInArrow(run, "x binary").distinct(), "fit-list")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.array([np.frombuffer(r, "<i2" if len(r) == 2 * width else "<i8") for r in column.to_pylist()], np.int64).reshape(-1, width)


def _summed(fit: DataFrame, width: int, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over the fit list of of(x), a matrix for each batch: added up in each task, then entry by entry in a shuffle."""
    rows, columns = (a.ravel() for a in np.indices(shape))
    arrow = pa.float64() if kind == "double" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            part = of(_matrix(b.column(0), width))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(columns), pa.array(total.ravel(), arrow)], names=["i", "j", "s"])

    total = F.sum("s") if kind == "double" else F.sum(F.col("s").cast("decimal(38,0)"))
    out = np.zeros(shape, np.float64 if kind == "double" else object)
    for r in fit.mapInArrow(run, f"i long, j long, s {kind}").groupBy("i", "j").agg(total.alias("s")).collect():  # shape[0] * shape[1] rows
        out[r.i, r.j] = r.s if kind == "double" else int(r.s)
    return out


def fit(rows: DataFrame, width: int, components: int) -> tuple[Whitening, float]:
    """The whitening of rows (v), and the largest absolute entry of its scores' covariance minus the identity."""
    listed = fit_list(rows, width)
    n = listed.count()
    halves = lambda x: np.concatenate([x >> 32, x & 0xFFFFFFFF]).reshape(2, -1, width).sum(1)  # noqa: E731  sums that can't overflow
    high, low = _summed(listed, width, (2, width), halves, "long")
    model = Whitening(width, n, [int(h) * (1 << 32) + int(v) for h, v in zip(high, low)], np.zeros(0), np.zeros((width, 0)), 0.0)

    def scatter(x: np.ndarray) -> np.ndarray:
        c = model.centred(x)[0]
        return c.T @ c

    total = _summed(listed, width, (width, width), scatter, "double")
    values, vectors = eigen((total + total.T) / 2)
    model.trace = float(total.trace()) / n if n else 0.0
    model.values, model.components = values[:components] / max(n, 1), vectors[:, :components]
    kept = len(model.values)
    if not kept:
        return model, 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.scores(x)[0]
        return np.concatenate([w.T @ w, w.sum(0)[None]])

    summed = _summed(listed, width, (kept + 1, kept), moments, "double") / n
    return model, float(np.abs(summed[:-1] - np.outer(summed[-1], summed[-1]) - np.eye(kept)).max())


def _long_or_null(exact: np.ndarray) -> pa.Array:
    """Sums of squares of each row, null beyond a long."""
    top = int(np.abs(exact).max(initial=0))
    if exact.dtype != object and exact.shape[1] * top * top < 1 << 63:
        return pa.array((exact * exact).sum(1))
    sums = (sum(int(z) ** 2 for z in r) for r in exact)
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each remaining vector and component."""
    spark = vectors.sparkSession
    modest_batches(spark)
    rows = finite_rows(vectors, vector_col, id=id_col)
    kind = vectors.schema[id_col].dataType.simpleString()
    width = max(1, widest(rows))
    model, error = fit(rows, width, components)
    kept = len(model.values)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, exact = model.scores(whole(b.column(1), width, BOUND))
            at = pa.array(np.repeat(np.arange(b.num_rows), kept))
            times = b.num_rows * kept
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(at),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(times, model.n)),
                    _long_or_null(exact).take(at),
                    pa.array(w.ravel()),
                    pa.array(np.tile(model.values / model.trace, b.num_rows)),
                    pa.array(np.full(times, error)),
                ],
                names=names,
            )

    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return (rows if kept else rows.where("false")).mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
