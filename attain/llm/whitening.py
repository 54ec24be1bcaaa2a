"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Spark sums exact integers over all vectors; only a square of the dimension comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attain.llm.common import give_back

#: Entries become whole steps. The contract's constant of 100000 on top of them cancels in all that is returned.
SCALE = 1024.0
#: Steps beyond this are held at it: below it doubles are exact integers.
BOUND = 1 << 53
COMPONENTS = 8


@dataclass(frozen=True)
class Whitening:
    """Fitted on n vectors whose sums are 2**53-safe integers: mean = (whole * n + rest) / n in each dimension."""

    n: int
    whole: tuple[int, ...]
    rest: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit columns
    trace: float


def steps(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, integers): which rows hold a whole finite vector of dim entries, and floor(1024 * entry) of these."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(column) == 0:
        return np.zeros(0, np.int64), np.zeros((0, dim), np.int64)
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.values.cast(pa.float64())
    missing = values.is_null().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(missing | ~np.isfinite(flat))])
    size = np.diff(offsets)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]]) & (size == dim)
    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.zeros((0, dim), np.int64)
    at = offsets[:-1][rows][:, None] + np.arange(dim)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(flat[at] * SCALE), -BOUND, BOUND)
    return rows, scaled.astype(np.int64)


def _exact(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values.ravel()], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        column = batch.column("vec")
        sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes[sizes > 0]).tolist():
            _, x = steps(column, dim)
            n, total = found.get(dim, (0, 0))
            small = len(x) < 512 or np.abs(x).max() < 1 << 40
            found[dim] = [n + len(x), total + (x.sum(0).astype(object) if small else x.astype(object).sum(0))]
    for dim, (n, total) in found.items():
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(np.arange(dim), pa.int32()),
                                              pa.array([n] * dim, pa.int64()), _exact(total)], names=["d", "i", "n", "s"])
    give_back()


def _products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products: as doubles where no partial sum can lose a bit, as integers of any size elsewhere."""
    high = int(np.abs(y).max()) if y.size else 0
    if high and len(y) * high * high >= BOUND:
        if len(y) > 1 and high * high < BOUND:
            half = len(y) // 2
            return _products(y[:half]) + _products(y[half:])
        wide = y.astype(object)
        return wide.T @ wide
    y = y.astype(np.float64)
    return (y.T @ y).astype(np.int64).astype(object)


def _scatter(batches: Iterator[pa.RecordBatch], dim: int, whole: list[int]) -> Iterator[pa.RecordBatch]:
    base, out = np.array(whole, np.int64), np.zeros((dim, dim), object)
    for batch in batches:
        _, x = steps(batch.column("vec"), dim)
        if len(x):
            out = out + _products(x - base)
    i, j = np.triu_indices(dim)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _exact(out[i, j])], names=["i", "j", "s"])
    give_back()


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with L @ L.T = a (symmetric, positive semidefinite): lower triangular once its rows are put in pivot order.

    One column per pivot; a diagonal entry that is only the rounding of what it was no longer takes part, so columns are as
    many as the numerical rank, also where the dimensions have very different scales.
    """
    a = a.copy()
    d = len(a)
    out = np.zeros((d, 0))
    diagonal = np.diag(a).copy()
    floor = d * np.finfo(float).eps * diagonal
    columns = []
    while len(columns) < d:
        diagonal[diagonal <= floor] = -np.inf
        p = int(np.argmax(diagonal))
        if diagonal[p] == -np.inf:
            break
        column = a[:, p].copy()
        for c in columns:
            column -= c * c[p]
        column /= np.sqrt(diagonal[p])
        done = diagonal == -np.inf
        column[done] = 0.0
        column[p] = np.sqrt(diagonal[p])
        columns.append(column)
        diagonal = diagonal - column * column
        diagonal[done] = -np.inf
        diagonal[p] = -np.inf
    return np.stack(columns, 1) if columns else out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors) of factor @ factor.T, falling: columns are rotated until all are orthogonal.

    Their squared norms are the eigenvalues and the normalised columns the eigenvectors. Disjoint pairs of columns, in
    the order of a round-robin tournament, are rotated together.
    """
    g = factor.copy()
    r = g.shape[1]
    order = list(range(r + r % 2))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(max(len(order) - 1, 0)):
            pairs = [(min(p, q), max(p, q)) for p, q in zip(order[:len(order) // 2], reversed(order[len(order) // 2:])) if max(p, q) < r]
            order = [order[0], order[-1], *order[1:-1]]
            if not pairs:
                continue
            p, q = map(np.array, zip(*pairs))
            a, b = g[:, p], g[:, q]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, float(off.max()))
            turn = off > 1e-16
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            g[:, p], g[:, q] = c * a - s * b, s * a + c * b
        if worst < 1e-15 * max(r, 8):
            break
    norms = np.sqrt((g * g).sum(0))
    falling = np.argsort(-norms, kind="stable")
    return norms[falling] ** 2, g[:, falling] / norms[falling]


def fit(vectors: DataFrame, *, vec_col: str = "embedding", components: int | None = None) -> Whitening | None:
    """Mean and leading components of all whole finite vectors; None where there is none.

    Sums and products are exact integers summed by Spark, so that neither the order of rows nor the partitioning
    changes a bit of the result. Products are taken of steps less the whole part of their mean; the rest of the mean,
    less than one step, is taken off exactly.
    """
    only = vectors.select(F.col(vec_col).alias("vec"))
    first = (only.mapInArrow(_sums, "d int, i int, n long, s decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
             .groupBy("d").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "s"))).alias("sums"))
             .orderBy(F.desc("n"), F.desc("d")).first())
    if first is None:
        return None
    dim, n, sums = first["d"], first["n"], [int(r["s"]) for r in first["sums"]]
    whole, rest = [s // n for s in sums], [s % n for s in sums]
    rows = (only.mapInArrow(partial(_scatter, dim=dim, whole=whole), "i int, j int, s decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    cov = np.zeros((dim, dim))
    for r in rows:
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = float(Fraction(int(r["s"]) * n - rest[r["i"]] * rest[r["j"]], n * n))
    values, columns = one_sided_jacobi(pivoted_cholesky(cov))
    keep = min(len(values), dim if components is None else components)
    return Whitening(n, tuple(whole), tuple(rest), values[:keep], columns[:, :keep], float(np.trace(cov)))


def _white(x: np.ndarray, m: Whitening) -> np.ndarray:
    centred = (x - np.array(m.whole, np.int64)).astype(np.float64) - np.array(m.rest, np.float64) / m.n
    return centred @ (m.vectors / np.sqrt(m.values))


def _deviations(x: np.ndarray, m: Whitening) -> list[int | None]:
    """Exact sums of (n * entry - sum of entries)**2; null where a sum is beyond a long."""
    y = x - np.array(m.whole, np.int64)
    high = (int(np.abs(y).max(initial=0)) + 1) * m.n
    if x.shape[1] * high * high < 1 << 63:
        off = y * m.n - np.array(m.rest, np.int64)
        return (off * off).sum(1).tolist()
    off = y.astype(object) * m.n - np.array(m.rest, object)
    return [int(v) if v < 1 << 63 else None for v in (off * off).sum(1)]


def identity_error(vectors: DataFrame, m: Whitening, *, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of all whitened vectors less the identity, measured in a pass over them."""
    k = len(m.values)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _white(steps(batch.column("vec"), len(m.whole))[1], m)
            total += w.sum(0)
            products += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.arange(k), i]), pa.int32()),
                                          pa.array(np.concatenate([np.full(k, -1), j]), pa.int32()),
                                          pa.array(np.concatenate([total, products[i, j]]))], names=["i", "j", "s"])
        give_back()

    rows = vectors.select(F.col(vec_col).alias("vec")).mapInArrow(measure, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    mean, found = np.zeros(k), np.zeros((k, k))
    for r in rows:
        if r["j"] < 0:
            mean[r["i"]] = r["s"] / m.n
        else:
            found[r["i"], r["j"]] = found[r["j"], r["i"]] = r["s"] / m.n
    return float(np.abs(found - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each whole finite vector and component: id, component (from 1, by falling eigenvalue), n, deviation,
    whitened, explained, identity_error.

    Vectors that are null, empty or hold null or non-finite entries are left out, as are those of another length than
    most (the longer at a tie). Entries become floor(1024 * entry) + 100000, held within 2**53 either way. Ids are
    carried as they are, null or repeated; repeated rows count each time; other columns are ignored, whatever their names.
    Components whose eigenvalue is rounding (fewer independent vectors than components, or a single one) do not exist and
    have no rows. Equal eigenvalues have no order of their own: any basis of their space may come. deviation is null where it is beyond
    a long. An empty table, or one without a whole vector, gives no rows. Three passes, no shuffle of vectors.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    m = fit(vectors, vec_col=vec_col, components=components)
    if m is None or not len(m.values):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(vectors, m, vec_col=vec_col)
    explained = m.values / m.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(m.values)
        for batch in batches:
            at, x = steps(batch.column("vec"), len(m.whole))
            if not len(at):
                continue
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                pa.array(np.full(len(at) * k, m.n)), pa.array(_deviations(x, m), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                pa.array(_white(x, m).ravel()), pa.array(np.tile(explained, len(at))), pa.array(np.full(len(at) * k, error)),
            ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
        give_back()

    return (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).mapInArrow(rows, schema)
            .withColumnRenamed("id", id_col))
