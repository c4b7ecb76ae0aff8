"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Entries become whole numbers, so sums of products are exact: a task multiplies blocks in
pieces of 20 bits, whose products doubles hold exactly, and Spark adds the (i, j) sums of
all tasks as decimals.  n * sum(xy) - sum(x) * sum(y) is the centred scatter, without
cancellation.  It factors into P L L' P' with complete pivoting; rotations of L's columns make
them orthogonal, and then the columns' norms are the roots of the eigenvalues and the
normalised columns the components.  Working on L and not on L L' keeps the small ones accurate.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task turns into a matrix at a time (fewer of long vectors): 2**11 products of 20 by 20 bits stay below 2**53.
ROWS = 2048
ENTRIES = 1 << 19
PIECE = 20
#: Entries times ``scale`` must be below this, else no sum of theirs is sure to fit a decimal of 38 digits.
LARGEST = 1 << 44
#: The scatter has dimension ** 2 entries; larger vectors raise.
MOST_DIMENSIONS = 4096
OFFSET = 1_000_000


class Model(NamedTuple):
    """n rows, sums of the entries without OFFSET, eigenvalues, components as columns, trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float


# ---- whole numbers in tasks ---------------------------------------------------------------------------------------

def matrix(vectors: pa.Array, scale: int, dims: int) -> np.ndarray:
    """floor(scale * c) of vectors of one length, none null, as rows of int64."""
    values = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(values * float(scale)).astype(np.int64).reshape(-1, dims)


def pieces(y: np.ndarray) -> list[np.ndarray]:
    """Matrices of doubles, PIECE bits each, that give y as sum of piece k times 2 ** (PIECE * k); the last has the sign."""
    out = []
    while len(y) and np.abs(y).max() >= 1 << PIECE:
        out.append((y & ((1 << PIECE) - 1)).astype(float))
        y = y >> PIECE
    return [*out, y.astype(float)]


def products(y: np.ndarray) -> np.ndarray:
    """y'y, exact, as Python's whole numbers; y of ROWS rows at most."""
    parts, total = pieces(y), np.zeros((y.shape[1],) * 2, object)
    for a, left in enumerate(parts):
        for b, right in enumerate(parts):
            total = total + (left.T @ right).astype(np.int64).astype(object) * (1 << PIECE * (a + b))
    return total


def whole(batches: Iterator[pa.RecordBatch], column: int, dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches with the matrix of their vectors."""
    rows = max(1, min(ROWS, ENTRIES // max(1, dims)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, matrix(part.column(column), scale, dims)


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - sums, exact: int64 where that holds it, else Python's whole numbers."""
    most = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums), default=0)
    kind = np.int64 if most < 1 << 62 else object
    return y.astype(kind) * n - np.array(sums, kind)


def squared(t: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, exact."""
    if t.dtype == np.int64 and int(np.abs(t).max(initial=0)) ** 2 * t.shape[1] < 1 << 62:
        return (t * t).sum(axis=1)
    t = t.astype(object)
    return (t * t).sum(axis=1)


# ---- the factor and its rotations ---------------------------------------------------------------------------------

def pivoted_cholesky(v: np.ndarray, tolerance: float = 1e-14) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with v[order][:, order] = L L'; L has as many columns as pivots above tolerance * the first."""
    v = v.copy()
    d = len(v)
    order, low, rank = np.arange(d), np.zeros((d, d)), 0
    least = tolerance * float(np.diagonal(v).max(initial=0.0))
    while rank < d:
        k = rank + int(np.argmax(np.diagonal(v)[rank:]))
        if not v[k, k] > least:
            break
        if k != rank:
            for a in (v, v.T, low, order):
                a[[rank, k]] = a[[k, rank]]
        low[rank:, rank] = v[rank:, rank] / np.sqrt(v[rank, rank])
        column = low[rank + 1:, rank]
        v[rank + 1:, rank + 1:] -= np.outer(column, column)
        rank += 1
    return low[:, :rank], order


def jacobi(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns rotated until all pairs are orthogonal to working precision.

    Pairs of a round share no column, so a round is one step on arrays; the rounds of a
    sweep (a tournament) meet every pair once.
    """
    w = low.copy()
    k = w.shape[1]
    seats = np.arange(k + k % 2)
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[::-1][:len(seats) // 2]
            real = (p < k) & (q < k)
            p, q = p[real], q[real]
            x, y = w[:, p], w[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(c) > 1e-15 * np.sqrt(a * b)
            if turn.any():
                turned = True
                p, q, x, y, a, b, c = p[turn], q[turn], x[:, turn], y[:, turn], a[turn], b[turn], c[turn]
                zeta = (b - a) / (2 * c)
                tan = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, tan)
                w[:, p], w[:, q] = cos * x - cos * tan * y, cos * tan * x + cos * y
            seats[1:] = np.roll(seats[1:], 1)
        if not turned:
            break
    return w


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a covariance, without those of no variance.

    Each component's entry of largest size is positive.
    """
    low, order = pivoted_cholesky(v)
    w = jacobi(low)
    values = (w * w).sum(0)
    rank = np.argsort(-values, kind="stable")
    components = np.empty_like(w)
    components[order] = w / np.sqrt(values)
    values, components = values[rank], components[:, rank]
    if len(values):
        components = components * np.sign(components[np.abs(components).argmax(0), np.arange(len(values))])
    return values, components


# ---- over a table -------------------------------------------------------------------------------------------------

def usable(vector: Column, scale: int) -> Column:
    """Whether a vector is there and all its entries are finite numbers, small enough to count exactly."""
    entry = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * scale >= float(LARGEST)))
    return F.coalesce(vector.isNotNull() & ~entry, F.lit(False))


def fit_rows(table: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", scale: int = 64) -> tuple[DataFrame, int]:
    """(rows id, vector that can be fitted, their dimension): of usable vectors those of the commonest length (ties: the longest)."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).filter(usable(F.col("vector"), scale) & (F.size("vector") > 0))
    found = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = found["dims"] if found else 0
    if dims > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dims} entries; {MOST_DIMENSIONS} at most")
    return rows.filter(F.size("vector") == dims), dims


def added(parts: DataFrame) -> list[tuple]:
    """(i, j, sum) over all tasks; the driver gets dimension ** 2 / 2 rows at most."""
    return [tuple(r) for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator()]


def fit(rows: DataFrame, dims: int, scale: int = 64) -> Model:
    """The model of all rows (id, vector): one scan, (i, j) sums of each task added by Spark."""
    upper = np.triu_indices(dims)

    def scatter(batches):
        total, sums, n = np.zeros((dims, dims), object), np.zeros(dims, object), 0
        for _, y in whole(batches, 0, dims, scale):
            total, sums, n = total + products(y), sums + y.sum(axis=0).astype(object), n + len(y)
        if n:
            cells = [*zip(*upper, total[upper]), *((-1, j, s) for j, s in enumerate(sums)), (-1, -1, n)]
            i, j, s = zip(*cells)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(i), pa.int32()), pa.array(np.array(j), pa.int32()),
                                              pa.array([Decimal(int(x)) for x in s], pa.decimal128(38, 0))], ["i", "j", "s"])

    cells = added(rows.select("vector").mapInArrow(scatter, "i int, j int, s decimal(38,0)"))
    found = {(i, j): int(s) for i, j, s in cells}
    n, sums = found.get((-1, -1), 0), [found.get((-1, j), 0) for j in range(dims)]
    v = np.zeros((dims, dims))
    for (i, j), s in found.items():
        if i >= 0:
            v[i, j] = v[j, i] = (n * s - sums[i] * sums[j]) / (n * n)  # of whole numbers: rounded once
    values, components = principal(v) if n else (np.zeros(0), np.zeros((0, 0)))
    return Model(n, sums, values, components, float(np.trace(v)))


def projected(y: np.ndarray, model: Model, most: int) -> np.ndarray:
    """Whitened coordinates of the first ``most`` components."""
    t = centred(y, model.n, model.sums).astype(float) / model.n
    return t @ (model.components[:, :most] / np.sqrt(model.values[:most]))


def identity_error(rows: DataFrame, model: Model, dims: int, most: int, scale: int = 64) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, measured in one scan."""
    k = min(most, len(model.values))
    upper = np.triu_indices(k)

    def moments(batches):
        total, sums = np.zeros((k, k)), np.zeros(k)
        for _, y in whole(batches, 0, dims, scale):
            w = projected(y, model, most)
            total, sums = total + w.T @ w, sums + w.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(upper[0], np.full(k, -1)), pa.int32()), pa.array(np.append(upper[1], np.arange(k)), pa.int32()),
             pa.array(np.append(total[upper], sums))], ["i", "j", "s"])

    if not k:
        return 0.0
    mean, cov = np.zeros(k), np.zeros((k, k))
    for i, j, s in added(rows.select("vector").mapInArrow(moments, "i int, j int, s double")):
        if i < 0:
            mean[j] = s / model.n
        else:
            cov[i, j] = s / model.n
    cov[upper] -= mean[upper[0]] * mean[upper[1]]
    return float(np.abs((cov - np.eye(k))[upper]).max())


def whiten(table: DataFrame, most: int = 32, vector_col: str = "embedding", id_col: str = "vec_id", scale: int = 64) -> DataFrame:
    """One row per fitted row and component: id_col, component, n, deviation, whitened, explained, identity_error.

    An entry c counts as floor(scale * c) + OFFSET.  Rows are left out whose vector is null, empty, of another length than
    most are, or holds a null, a NaN, an infinity or an entry of LARGEST / scale or more.  Components
    of no variance (a pivot of 1e-14 of the first or less) are left out, so
    equal vectors, one vector or none give an empty table.  Null and repeated ids stay as they are;
    deviation is a decimal of 38 digits, null beyond.  Other columns are not read.
    """
    rows, dims = fit_rows(table, vector_col, id_col, scale)
    model = fit(rows, dims, scale)
    k = min(most, len(model.values))
    off = identity_error(rows, model, dims, most, scale)

    def coordinates(batches):
        for part, y in whole(batches, 1, dims, scale):
            if not k:
                continue
            deviation = squared(centred(y, model.n, model.sums))
            if deviation.dtype == np.int64:
                deviation = pa.array(deviation).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(x) if x < 10 ** 38 else None for x in deviation.tolist()], pa.decimal128(38, 0))
            take = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()),
                                              deviation.take(take), pa.array(projected(y, model, most).ravel())],
                                             ["id", "component", "deviation", "whitened"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, component int, deviation decimal(38,0), whitened double"
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values[:k])) if k else F.array(F.lit(0.0))
    return rows.mapInArrow(coordinates, schema).select(
        F.col("id").alias(id_col), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("component")).alias("explained"), F.lit(off).alias("identity_error"))


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """All of ``embeddings`` on the first 32 components; a deviation beyond a long is null."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")).withColumn(
        "deviation", F.expr("try_cast(deviation as bigint)"))
