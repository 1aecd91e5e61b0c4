"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Vectors become whole numbers (``floor(256 * c)``), so counts, sums and the
scatter are exact and do not depend on the order of rows. Two passes over the
distinct vectors gather them: sums first, then products of entries centred at
the mean's nearest whole number, which an exact term moves to the mean itself.
A task adds up its own rows with matrix products and hands on one row per pair
of dimensions; Spark sums those. Only tables of the dimension's size (sums, the
scatter) reach the driver, never rows.

The scatter's factor ``L`` comes from Cholesky steps with the largest remaining
diagonal entry as pivot, which stop at the rank. Plane rotations make the
columns of ``L`` orthogonal: the squared norms of the rotated columns are the
eigenvalues, the columns divided by their norms the components.

Odd input: rows whose vector is null or holds a null, NaN or infinite entry are
left out; shorter vectors count as filled up with zeros to the longest one's
length; entries beyond a long's range become its ends. Repeated rows and rows
with a null id each get a result. Components end at the rank, so one distinct
vector, or an empty table, gives no rows. ``deviation`` is null where its exact
value is beyond a long. Equal eigenvalues come in an order that the data alone
decide. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored

#: Entries become whole steps of 1 / SCALE.
SCALE = 256.0
#: Rows of one matrix product.
BLOCK_ROWS = 2048
#: Sums go through Spark in two parts of this many bits, so no decimal overflows.
LOW_BITS = 60
_DECIMAL = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """What the fit list teaches: exact sums, the leading components and all eigenvalues."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray  # dimensions x components, unit columns
    values: np.ndarray  # eigenvalue of each column
    explained: np.ndarray
    trace: float


def whole(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, x): ids and vectors of whole numbers, without rows that hold no finite vector."""
    entries = F.col(vector_column).cast("array<double>")
    usable = F.col(vector_column).isNotNull() & F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.where(usable)
            .select(F.col(id_column).alias("id"), F.transform(entries, lambda c: F.floor(c * F.lit(SCALE)).cast("long")).alias("x")))


def blocks(column: pa.ListArray, width: int) -> Iterator[np.ndarray]:
    """Matrices of at most ``BLOCK_ROWS`` rows; short vectors are filled up with zeros."""
    for start in range(0, len(column), BLOCK_ROWS):
        part = column.slice(start, BLOCK_ROWS)
        lengths = np.diff(part.offsets.to_numpy())
        flat = part.flatten().to_numpy()
        if len(flat) == len(part) * width:
            yield flat.reshape(len(part), width)
        else:
            out = np.zeros((len(part), width), np.int64)
            out[np.arange(width) < lengths[:, None]] = flat
            yield out


def exact_products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` without rounding: in doubles where all sums fit 53 bits, else in Python's integers."""
    largest = float(np.abs(x.astype(np.float64)).max(initial=0.0))
    if largest * largest * len(x) < 2.0 ** 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def _parts(values: list[int]) -> list[pa.Array]:
    low = (1 << LOW_BITS) - 1
    return [pa.array([int(v) >> LOW_BITS for v in values], _DECIMAL), pa.array([int(v) & low for v in values], _DECIMAL)]


def _total(high, low) -> int:
    return (int(high) << LOW_BITS) + int(low)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Exact number of rows and sum of each dimension."""

    def run(batches):
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            for x in blocks(batch.column(0), width):
                n += len(x)
                # The halves of an entry add up without overflow.
                total += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), *_parts([n, *total])], names=["i", "high", "low"])

    rows = (fit.select("x").mapInArrow(run, "i int, high decimal(38,0), low decimal(38,0)")
            .groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
    found = {r["i"]: _total(r["high"], r["low"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance matrix (divisor n), each entry exact up to its last rounding to a double."""
    width = len(sums)
    middle = [(2 * s + n) // (2 * n) for s in sums]  # the mean's nearest whole number
    upper = np.triu_indices(width)

    def run(batches):
        total, rows, centre = np.zeros((width, width), object), 0, np.array(middle, object)
        small = all(abs(m) < 1 << 62 for m in middle)
        for batch in batches:
            for x in blocks(batch.column(0), width):
                fits = small and np.abs(x.astype(np.float64)).max(initial=0.0) < 2.0 ** 61
                total += exact_products(x - centre.astype(np.int64) if fits else x.astype(object) - centre)
                rows += len(x)
        if rows:
            at = [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32())]
            yield pa.RecordBatch.from_arrays([*at, *_parts(list(total[upper]))], names=["i", "j", "high", "low"])

    rows = (fit.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toLocalIterator())
    off = [s - n * m for s, m in zip(sums, middle)]
    out = np.zeros((width, width))
    for r in rows:
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = (n * _total(r["high"], r["low"]) - off[i] * off[j]) / (n * n)
    return out


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with ``matrix = L @ L.T``: rows in the matrix's order, one column a pivot, as many as the rank."""
    size = len(matrix)
    left, factor = np.diag(matrix).astype(float).copy(), np.zeros((size, size))
    least = 4 * np.finfo(float).eps * size * left  # what rounding may leave of each diagonal entry
    for k in range(size):
        pivot = int(np.argmax(np.where(left > least, left, -np.inf)))
        if left[pivot] <= least[pivot]:
            return factor[:, :k]
        column = (matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / np.sqrt(left[pivot])
        column[left == -np.inf] = 0.0  # rows of earlier pivots are done
        column[pivot] = np.sqrt(left[pivot])
        factor[:, k] = column
        left = np.where(left == -np.inf, left, np.maximum(left - column * column, 0.0))
        left[pivot] = -np.inf
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of ``factor @ factor.T``.

    A sweep meets every pair of columns once, in rounds of disjoint pairs that
    are rotated together; sweeps end when no pair is off a right angle.
    """
    work = factor.copy()
    rank = work.shape[1]
    if rank == 0:
        return np.zeros(0), work
    if rank % 2:
        work = np.column_stack([work, np.zeros(len(work))])
    order = np.arange(work.shape[1])
    limit = np.finfo(float).eps * np.sqrt(len(work))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(max(len(order) - 1, 1)):
            half = len(order) // 2
            a, b = order[:half], order[half:][::-1]
            p, q = work[:, a], work[:, b]
            pp, qq, pq = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            size = np.sqrt(pp * qq)
            angle = np.divide(np.abs(pq), size, out=np.zeros_like(pq), where=size > 0)
            worst = max(worst, float(angle.max(initial=0.0)))
            turn = angle > limit
            zeta = np.divide(qq - pp, 2 * pq, out=np.zeros_like(pq), where=turn)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1.0 / np.hypot(1.0, t)
            s = c * t
            work[:, a], work[:, b] = c * p - s * q, s * p + c * q
            order = np.concatenate([order[:1], order[-1:], order[1:-1]])  # the round table turns by one seat
        if worst <= limit:
            break
    norms = np.sqrt((work * work).sum(0))
    by_size = np.argsort(-norms, kind="stable")[:rank]
    norms = norms[by_size]
    return norms * norms, np.divide(work[:, by_size], norms, out=np.zeros((len(work), rank)), where=norms > 0)


def fit_whitening(fit: DataFrame, components: int) -> Whitening | None:
    """Learn from a table of distinct vectors ``x``; None where it holds no spread."""
    width = fit.agg(F.max(F.size("x")).alias("w")).first()["w"] or 0
    if not width:
        return None
    n, sums = _sums(fit, width)
    matrix = covariance(fit, n, sums)
    values, axes = one_sided_jacobi(pivoted_cholesky(matrix))
    if not len(values):
        return None
    trace = float(np.trace(matrix))
    k = min(components, len(values))
    return Whitening(n, tuple(sums), axes[:, :k].copy(), values[:k].copy(), values[:k] / trace, trace)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - sums / n`` in doubles: whole parts are taken off as whole numbers first."""
    whole_part, rest = zip(*(divmod(s, n) for s in sums))
    return (x.astype(object) - np.array(whole_part, object)).astype(np.float64) - np.array(rest, np.float64) / n \
        if max(map(abs, whole_part)) >= 1 << 52 or np.abs(x.astype(np.float64)).max(initial=0.0) >= 2.0 ** 52 \
        else (x - np.array(whole_part, np.int64)).astype(np.float64) - np.array(rest, np.float64) / n


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums of ``(n * x - sums) ** 2``; None beyond a long."""
    about = ((x.astype(np.float64) * n - np.array(sums, np.float64)) ** 2).sum(axis=1)
    largest = float(np.abs(x.astype(np.float64)).max(initial=0.0)) * n + max(map(abs, sums))
    if largest < 2.0 ** 62 and about.max(initial=0.0) < 2.0 ** 62:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on the rows."""
    n, sums, width, k = model.n, model.sums, len(model.sums), len(model.values)
    project = model.axes / np.sqrt(model.values)

    def run(batches):
        total, first = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for x in blocks(batch.column(0), width):
                z = centred(x, n, sums) @ project
                total += z.T @ z
                first += z.sum(axis=0)
        values = np.concatenate([first, total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["i", "v"])

    rows = fit.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    found = np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])]) / n
    mean, square = found[:k], found[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


SCHEMA = "id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def whiten(vectors: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """A row a usable vector: its whitened coordinates along the leading components, with the fit's figures."""
    rows = whole(vectors, id_column, vector_column).select(F.col("id").cast("long").alias("id"), "x")
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    error, width = identity_error(fit, model), len(model.sums)
    project = model.axes / np.sqrt(model.values)

    def run(batches):
        for batch in batches:
            at = 0
            for x in blocks(batch.column(1), width):
                z = centred(x, model.n, model.sums) @ project
                count, k = z.shape
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, count), pa.array([model.n] * count, pa.int64()),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()), pa.array(list(z), pa.list_(pa.float64())),
                    pa.array([model.explained] * count, pa.list_(pa.float64())), pa.array([error] * count, pa.float64())],
                    names=["id", "n", "deviation", "whitened", "explained", "identity_error"])
                at += count

    return rows.mapInArrow(run, SCHEMA)


def report(whitened: DataFrame) -> DataFrame:
    """A row a vector and component."""
    return whitened.select("id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "value")).select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("value").alias("whitened"), F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error")
