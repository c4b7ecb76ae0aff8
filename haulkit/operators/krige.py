"""Ordinary kriging (I6) on tiles of samples.

All samples, value only: K a = z and K b = 1 are solved by preconditioned
conjugate gradients.  A round is one job: a task updates its tile's vectors, applies
the inverse of the tile's own covariance (the preconditioner) and sends its part
to the tiles within reach, which add up their products; the round's scalars come from
one aggregate, as the recurrences need no second one (Chronopoulos and Gear 1989).
Where loggers cluster, the nearly dependent ones share a tile, so its inverse takes care
of them.  The covariance of tiles farther apart than `cov_radius` is left out: below
`eps` = 1e-18 of the diagonal it changes no double.

All samples, value and variance: K = L L' by blocks of tiles, one job per tile
column, and every block of cells then passes forward through the rows of L.

Local neighbourhoods (`max_points`): the tiles around a block of cells are read from
the nearest on, until the k-th distance of every cell is covered, and each cell's system
of its k nearest samples is solved in arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tiles import directory, farthest, nearest, tiled
from .variogram import *  # noqa: F403
from .variogram import _I1_SMALL, _K1_LARGE, _K1_SMALL, cov_radius, xk1_np  # noqa: F401

# Samples of a tile: its covariance is a dense matrix of so many rows.
TILE = 512
# Cells of a block.
CELLS = 1024
# Numbers that a block of cells holds of its forward solution, or of its small systems.
ROOM = 1 << 22


def covariance(h: np.ndarray, nugget: float, psill: float, rng: float) -> np.ndarray:
    return np.where(h > 0, psill * xk1_np(h / rng), nugget + psill)


def _distance(x, y, u, v) -> np.ndarray:
    return np.hypot(x[:, None] - u, y[:, None] - v)


def _matrix(data: pa.Scalar | bytes, rows: int) -> np.ndarray:
    raw = data.as_buffer() if isinstance(data, pa.Scalar) else data
    return np.frombuffer(raw, float).reshape(rows, -1)


def _out(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in
                                       (c if isinstance(c, tuple) else (c, None) for c in columns)], names)


def _packed(tiles: DataFrame, arrays: list[str]) -> DataFrame:
    """(tile, data): the arrays of each tile as rows of one matrix."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.array([b.column(1 + k)[i].values.to_numpy() for k in range(len(arrays))]).tobytes() for i in range(b.num_rows)]
            yield _out(["tile", "data"], b.column(0), (rows, pa.binary()))

    return tiles.select("tile", *arrays).mapInArrow(pack, "tile long, data binary")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
    """(first column, other columns) row by row."""
    for b in batches:
        columns = [b.column(k) for k in range(b.num_columns)]
        for i in range(b.num_rows):
            yield columns[0][i].as_py(), tuple(c[i] for c in columns[1:])


# ---------------------------------------------------------------- all samples: conjugate gradients

# Rows of a tile's matrix: position, value, then for both systems solution, residual, direction, its product,
# preconditioned residual, its product.
_X, _Y, _Z, _SOL, _RES, _DIR, _DPROD, _PRE, _PROD = 0, 1, 2, 3, 5, 7, 9, 11, 13
_ROWS = 15


def solve(tiles: DataFrame, n: int, nugget: float, psill: float, rng: float, radius: float, tol: float = 1e-9,
          max_iter: int | None = None) -> tuple[DataFrame, int]:
    """(tiles as (tile, data) with the solutions of K a = z and K b = 1 in rows _SOL and _SOL + 1, rounds used)."""
    numbers, _, boxes = directory(tiles)

    def start(batches):
        for b in batches:
            rows = []
            for data in b.column(1):
                m = _matrix(data, 3)
                full = np.zeros((_ROWS, m.shape[1]))
                full[:3], full[_RES], full[_RES + 1] = m, m[_Z], 1.0
                rows.append(full.tobytes())
            yield _out(["tile", "data"], b.column(0), (rows, pa.binary()))

    state = _packed(tiles, ["xs", "ys", "zs"]).mapInArrow(start, "tile long, data binary")

    def round_of(state: DataFrame, alpha: np.ndarray, beta: np.ndarray) -> DataFrame:
        def send(batches):
            for tile, (data,) in _by_key(batches):
                m = _matrix(data, _ROWS).copy()
                for k in (0, 1):
                    m[_DIR + k] = m[_PRE + k] + beta[k] * m[_DIR + k]
                    m[_DPROD + k] = m[_PROD + k] + beta[k] * m[_DPROD + k]
                    m[_SOL + k] += alpha[k] * m[_DIR + k]
                    m[_RES + k] -= alpha[k] * m[_DPROD + k]
                own = covariance(_distance(m[_X], m[_Y], m[_X], m[_Y]), nugget, psill, rng)
                m[_PRE:_PRE + 2] = _applied_inverse(own, m[_RES:_RES + 2].T).T
                m[_PROD:_PROD + 2] = m[_PRE:_PRE + 2] @ own
                at = int(np.searchsorted(numbers, tile))
                near = numbers[(nearest(boxes[at], boxes) <= radius) & (numbers != tile)]
                part = m[[_X, _Y, _PRE, _PRE + 1]].tobytes()
                yield _out(["tile", "own", "data"], [tile], [0], ([m.tobytes()], pa.binary()))
                for a in range(0, len(near), 256):
                    to = near[a:a + 256]
                    yield _out(["tile", "own", "data"], to, np.ones(len(to), np.int64), ([part] * len(to), pa.binary()))

        def add(batches):
            def done():
                dots = [float(m[a + k] @ m[b + k]) for a, b in ((_RES, _PRE), (_PROD, _PRE), (_RES, _RES)) for k in (0, 1)]
                return _out(["tile", "data", "dots"], [at], ([m.tobytes()], pa.binary()), ([dots], pa.list_(pa.float64())))

            at, m = None, None
            for tile, (own, data) in _by_key(batches):
                if not own.as_py():
                    if at is not None:
                        yield done()
                    at, m = tile, _matrix(data, _ROWS).copy()
                else:
                    x, y, *p = _matrix(data, 4)
                    m[_PROD:_PROD + 2] += np.array(p) @ covariance(_distance(x, y, m[_X], m[_Y]), nugget, psill, rng)
            if at is not None:
                yield done()

        sent = state.mapInArrow(send, "tile long, own long, data binary").repartition("tile").sortWithinPartitions("tile", "own")
        return cut_lineage(sent.mapInArrow(add, "tile long, data binary, dots array<double>"))

    def dots_of(state: DataFrame) -> np.ndarray:
        return np.array(state.agg(*[F.sum(F.col("dots")[k]) for k in range(6)]).first(), float).reshape(3, 2)

    alpha, beta, rounds = np.zeros(2), np.zeros(2), 0
    done = round_of(state, alpha, beta)
    gamma, delta, first = dots_of(done)
    first = np.maximum(first, 1e-300)
    open_ = gamma > 0
    if (open_ & (delta <= 0)).any():
        raise ArithmeticError("kriging: the covariance matrix is not positive definite (coincident samples?)")
    alpha = np.where(open_, gamma / np.where(open_, delta, 1.0), 0.0)
    for rounds in range(1, (max_iter or n + 10) + 1):
        if not open_.any():
            return done, rounds - 1
        done = round_of(done.drop("dots"), alpha, beta)
        new, delta, rest = dots_of(done)
        open_ &= rest > tol * tol * first
        if not open_.any():
            return done, rounds
        beta = np.where(open_, new / gamma, 0.0)
        below = delta - beta * new / np.where(alpha == 0, 1.0, alpha)
        if (open_ & (below <= 0)).any():
            raise ArithmeticError("kriging: the covariance matrix is not positive definite (coincident samples?)")
        alpha = np.where(open_, new / np.where(open_, below, 1.0), 0.0)
        gamma = np.where(open_, new, gamma)
    raise ArithmeticError(f"kriging: residuals {(rest[0] / first[0]) ** 0.5:.1e}, {(rest[1] / first[1]) ** 0.5:.1e} after "
                          f"{rounds} iterations; tolerance {tol:g}")


def _applied_inverse(own: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of own * x = right; the diagonal grows by as little as makes the matrix positive definite."""
    for jitter in (0.0, 1e-12, 1e-10, 1e-8, 1e-6):
        try:
            low = np.linalg.cholesky(own + jitter * own[0, 0] * np.eye(len(own)))
        except np.linalg.LinAlgError:
            continue
        return np.linalg.solve(low.T, np.linalg.solve(low, right))
    return right / own[0, 0]


def _predicted(cells: DataFrame, weights: DataFrame, mean: float, nugget: float, psill: float, rng: float, radius: float,
               kind: str) -> DataFrame:
    """(id, X, Y, PRED) of tiles of cells from tiles (tile, data) of rows x, y, weight."""
    numbers, _, boxes = directory(cells)

    def to_cells(batches):
        for _, (data,) in _by_key(batches):
            x, y, _ = _matrix(data, 3)
            box = np.array([x.min(), x.max(), y.min(), y.max()])
            to = numbers[nearest(box, boxes) <= radius]
            raw = data.as_py()
            for a in range(0, len(to), 256):
                part = to[a:a + 256]
                yield _out(["tile", "own", "data"], part, np.ones(len(part), np.int64), ([raw] * len(part), pa.binary()))

    def predict(batches):
        def done():
            return pa.RecordBatch.from_arrays([ids, pa.array(x), pa.array(y), pa.array(sums + mean)], ["id", "X", "Y", "PRED"])

        ids = None
        for b in batches:
            for i in range(b.num_rows):
                if not b.column(1)[i].as_py():
                    if ids is not None:
                        yield done()
                    ids = b.column(3)[i].values
                    x, y = _matrix(b.column(2)[i], 2)
                    sums = np.zeros(len(x))
                else:
                    u, v, w = _matrix(b.column(2)[i], 3)
                    sums += covariance(_distance(x, y, u, v), nugget, psill, rng) @ w
        if ids is not None:
            yield done()

    own = _packed(cells, ["xs", "ys"]).join(cells.select("tile", "ids"), "tile").select("tile", F.lit(0).cast("long").alias("own"), "data", "ids")
    met = own.unionByName(weights.mapInArrow(to_cells, "tile long, own long, data binary"), allowMissingColumns=True)
    return (met.repartition("tile").sortWithinPartitions("tile", "own").select("tile", "own", "data", "ids")
            .mapInArrow(predict, f"id {kind}, X double, Y double, PRED double"))


# ---------------------------------------------------------------- all samples: a factor, for variances

def factor(tiles: DataFrame, nugget: float, psill: float, rng: float) -> tuple[DataFrame, int]:
    """(blocks (i, j, data) of L with K = L L', number of tiles).  i, j: places of tiles in ascending order.

    A block below the diagonal holds L_ij; one on it holds the inverse of L_ii and below that x, y, z of the
    tile.  One job per column: a row's task gets the row above it in the column's place and its own.
    """
    numbers, sizes, _ = directory(tiles)
    m = len(numbers)
    coords = cut_lineage(_packed(tiles, ["xs", "ys", "zs"]).mapInArrow(
        lambda bs: (_out(["i", "data"], np.searchsorted(numbers, b.column(0).to_numpy()), b.column(1)) for b in bs), "i long, data binary"))
    table = None
    for k in range(m):
        nk = int(sizes[k])

        def column(batches, k=k, nk=nk):
            """Rows by (i, j, pivot): positions first (j = -1: those of tile k, then its own), then L_kj and L_ij."""
            def done():
                try:
                    low = np.linalg.cholesky(top)
                except np.linalg.LinAlgError:
                    raise ArithmeticError("kriging: the covariance matrix is not positive definite (coincident samples?)") from None
                back = np.linalg.inv(low)
                block = np.vstack((back, own)) if at == k else rest @ back.T
                return _out(["i", "j", "data"], [at], [k], ([np.ascontiguousarray(block).tobytes()], pa.binary()))

            at = None
            for i, (j, pivot, data) in _by_key(batches):
                if j.as_py() < 0:
                    if pivot.as_py() == 0:
                        if at is not None:
                            yield done()
                        at, piv = i, _matrix(data, 3)
                        top, rest, own = covariance(_distance(piv[0], piv[1], piv[0], piv[1]), nugget, psill, rng), None, piv
                    else:
                        own = _matrix(data, 3)
                        rest = covariance(_distance(own[0], own[1], piv[0], piv[1]), nugget, psill, rng)
                elif pivot.as_py() == 0:
                    above = _matrix(data, nk)
                    top = top - above @ above.T
                else:
                    rest = rest - _matrix(data, own.shape[1]) @ above.T
            if at is not None:
                yield done()

        below = F.sequence(F.lit(k), F.lit(m - 1)).cast("array<long>")
        minus = F.lit(-1).cast("long")
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        rows = coords.where(F.col("i") == k).select(F.explode(below).alias("i"), minus.alias("j"), zero.alias("pivot"), "data")
        rows = rows.unionByName(coords.where(F.col("i") > k).select("i", minus.alias("j"), one.alias("pivot"), "data"))
        if table is not None:
            rows = rows.unionByName(table.where(F.col("i") == k).select(F.explode(below).alias("i"), "j", zero.alias("pivot"), "data"))
            rows = rows.unionByName(table.where(F.col("i") > k).select("i", "j", one.alias("pivot"), "data"))
        made = cut_lineage(rows.repartition("i").sortWithinPartitions("i", "j", "pivot").mapInArrow(column, "i long, j long, data binary"))
        table = made if table is None else table.unionByName(made)
    return table, m


def _with_variance(cells: DataFrame, blocks: DataFrame, nugget: float, psill: float, rng: float, kind: str) -> DataFrame:
    """(id, X, Y, PRED, PRED_VAR): each tile of cells passes forward through the rows of L, which its task reads one by one."""
    numbers, _, _ = directory(cells)

    def to_cells(batches):
        for i, (j, data) in _by_key(batches):
            raw = data.as_py()
            for a in range(0, len(numbers), 64):
                to = numbers[a:a + 64]
                yield _out(["tile", "i", "j", "data"], to, np.full(len(to), i), np.full(len(to), j.as_py()), ([raw] * len(to), pa.binary()))

    def forward(batches):
        def done():
            w = np.vstack(solved)
            one, z, cell = w[:, -2], w[:, -1], w[:, :-2]
            mean = (one @ z) / (one @ one)
            left = 1.0 - one @ cell
            value = mean + (z - mean * one) @ cell
            variance = nugget + psill - (cell * cell).sum(0) + left * left / (one @ one)
            return pa.RecordBatch.from_arrays([ids, pa.array(x), pa.array(y), pa.array(value), pa.array(np.maximum(variance, 0.0))],
                                              ["id", "X", "Y", "PRED", "PRED_VAR"])

        ids = None
        for b in batches:
            for r in range(b.num_rows):
                i, j = b.column(1)[r].as_py(), b.column(2)[r].as_py()
                if i < 0:
                    if ids is not None:
                        yield done()
                    ids, (x, y), solved, total = b.column(4)[r].values, _matrix(b.column(3)[r], 2), [], 0.0
                elif j < i:
                    total = total + np.frombuffer(b.column(3)[r].as_buffer(), float).reshape(-1, len(solved[j])) @ solved[j]
                else:
                    raw = np.frombuffer(b.column(3)[r].as_buffer(), float)
                    size = int(round((-3 + (9 + 4 * len(raw)) ** 0.5) / 2))
                    back, (u, v, z) = raw[:size * size].reshape(size, size), raw[size * size:].reshape(3, size)
                    right = np.column_stack((covariance(_distance(u, v, x, y), nugget, psill, rng), np.ones(size), z))
                    solved.append(back @ (right - total))
                    total = 0.0
        if ids is not None:
            yield done()

    own = _packed(cells, ["xs", "ys"]).join(cells.select("tile", "ids"), "tile").select(
        "tile", F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"), "data", "ids")
    met = own.unionByName(blocks.mapInArrow(to_cells, "tile long, i long, j long, data binary"), allowMissingColumns=True)
    return (met.repartition("tile").sortWithinPartitions("tile", "i", "j").select("tile", "i", "j", "data", "ids")
            .mapInArrow(forward, f"id {kind}, X double, Y double, PRED double, PRED_VAR double"))


# ---------------------------------------------------------------- local neighbourhoods

def _local(samples: DataFrame, cells: DataFrame, k: int, nugget: float, psill: float, rng: float, kind: str) -> DataFrame:
    """(id, X, Y, PRED, PRED_VAR) from the k nearest samples of each cell (ties: smaller x, then y).

    For a tile of cells, the tiles of samples whose farthest points are nearest hold k samples within a
    distance D; only tiles that come nearer than D are sent to it, and it reads them from the nearest
    on until no cell can gain.
    """
    numbers, counts, boxes = directory(samples)
    cell_numbers, _, cell_boxes = directory(cells)

    def wanted(at: int) -> np.ndarray:
        far = farthest(cell_boxes[at], boxes)
        order = np.argsort(far, kind="stable")
        covers = np.searchsorted(np.cumsum(counts[order]), k)
        reach = far[order[min(covers, len(order) - 1)]]
        return nearest(cell_boxes[at], boxes) <= reach

    def asked(batches):
        for b in batches:
            for tile in b.column(0).to_pylist():
                at = int(np.searchsorted(cell_numbers, tile))
                take = np.flatnonzero(wanted(at))
                gap = nearest(cell_boxes[at], boxes[take])
                yield _out(["tile", "sample", "gap"], np.full(len(take), tile), numbers[take], gap)

    def solved(batches):
        def take(x, y, found, u, v, z):
            """The k nearest of those found and the new ones, for each cell."""
            h = (x[:, None] - u) ** 2 + (y[:, None] - v) ** 2
            new = np.stack((h, *(np.broadcast_to(a, h.shape) for a in (u, v, z))), axis=-1)
            both = new if found is None else np.concatenate((found, new), axis=1)
            if both.shape[1] > k:
                part = np.partition(both[:, :, 0], k - 1, axis=1)[:, k - 1:k]
                near = both[:, :, 0] <= part  # ties at the k-th distance stay until they are sorted
                width = int(near.sum(axis=1).max())
                pick = np.argsort(~near, axis=1, kind="stable")[:, :width]
                both = np.take_along_axis(both, pick[:, :, None], axis=1)
                order = np.lexsort((both[:, :, 2], both[:, :, 1], both[:, :, 0]), axis=1)[:, :k]
                both = np.take_along_axis(both, order[:, :, None], axis=1)
            return both

        def systems(ids, x, y, found):
            step = max(1, ROOM // (found.shape[1] + 1) ** 2)
            for a in range(0, len(x), step):
                f = found[a:a + step]
                u, v, z = f[:, :, 1], f[:, :, 2], f[:, :, 3]
                size = f.shape[1]
                system = np.ones((len(f), size + 1, size + 1))
                system[:, -1, -1] = 0.0
                system[:, :size, :size] = covariance(np.hypot(u[:, :, None] - u[:, None, :], v[:, :, None] - v[:, None, :]), nugget, psill, rng)
                right = np.ones((len(f), size + 1, 1))
                right[:, :size, 0] = covariance(np.hypot(u - x[a:a + step, None], v - y[a:a + step, None]), nugget, psill, rng)
                w = np.linalg.solve(system, right)[:, :, 0]
                value = (w[:, :size] * z).sum(axis=1)
                variance = nugget + psill - (w * right[:, :, 0]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([ids.slice(a, len(f)), pa.array(x[a:a + step]), pa.array(y[a:a + step]), pa.array(value),
                                                  pa.array(np.maximum(variance, 0.0))], ["id", "X", "Y", "PRED", "PRED_VAR"])

        ids = None
        for b in batches:
            for r in range(b.num_rows):
                gap, data = b.column(1)[r].as_py(), _matrix(b.column(2)[r], 2 if b.column(1)[r].as_py() < 0 else 3)
                if gap < 0:
                    if ids is not None:
                        yield from systems(ids, x, y, found)
                    ids, (x, y), found, covered = b.column(3)[r].values, data, None, np.inf
                elif gap * gap <= covered:
                    for a in range(0, data.shape[1], 512):
                        found = take(x, y, found, *data[:, a:a + 512])
                    covered = found[:, -1, 0].max() if found.shape[1] >= k else np.inf
        if ids is not None:
            yield from systems(ids, x, y, found)

    pairs = cells.select("tile").mapInArrow(asked, "tile long, sample long, gap double")
    points = _packed(samples, ["xs", "ys", "zs"]).withColumnRenamed("tile", "sample")
    own = _packed(cells, ["xs", "ys"]).join(cells.select("tile", "ids"), "tile").select("tile", F.lit(-1.0).alias("gap"), "data", "ids")
    met = own.unionByName(pairs.join(points, "sample").select("tile", "gap", "data"), allowMissingColumns=True)
    return (met.repartition("tile").sortWithinPartitions("tile", "gap").select("tile", "gap", "data", "ids")
            .mapInArrow(solved, f"id {kind}, X double, Y double, PRED double, PRED_VAR double"))


# ---------------------------------------------------------------- I6

def krige(samples: DataFrame, targets: DataFrame, nugget: float | None, psill: float | None, rng: float | None,
          id_col: str = "ID", x: str = "X", y: str = "Y", z: str = "Z", target_id: str = "CELL",
          tol: float = 1e-9, max_iter: int | None = None, eps: float = 1e-18, variance: bool = False,
          max_points: int | None = None, tile: int = TILE) -> DataFrame:
    """Ordinary kriging prediction at `targets`: target_id, X, Y, PRED, and PRED_VAR with `variance`.

    By default every sample counts: with a = K^-1 z and b = K^-1 1, the mean is
    m = 1'a / 1'b and the prediction at x0 is m + sum_j C(x0, xj)(a_j - m b_j); at a sample
    C is nugget + psill, so its value is met.  Runs one job per round; raises when
    the residual is not below `tol` after `max_iter` rounds (default: samples + 10).
    `variance` adds the kriging variance, from a factor of K by blocks: n^3 / 3 work for n
    samples.  With `max_points` each target uses its nearest samples only, at any number of samples.
    Without a variogram (one sample: NULL), or with one of zero everywhere (a constant field),
    the samples' mean is returned, and no variance; without samples NULL.
    """
    nugget, psill, rng = float(nugget or 0.0), float(psill or 0.0), float(rng or 1.0)
    kind = targets.schema[target_id].dataType.simpleString()
    tiles, n = tiled(samples, tile, id_col, x, y, (z,))
    tiles = tiles.withColumnRenamed(f"{z.lower()}s", "zs")
    names = [target_id, "X", "Y", "PRED", *(["PRED_VAR"] if variance else [])]
    if n == 0 or nugget + psill <= 0:
        mean = samples.agg(F.avg(z)).first()[0]
        out = targets.select(F.col(target_id), F.col(x).alias("X"), F.col(y).alias("Y"), F.lit(mean).cast("double").alias("PRED"))
        return out.withColumn("PRED_VAR", F.lit(None).cast("double")) if variance else out
    if max_points or variance:
        width = min(max_points, n) + 1 if max_points else n
        cells, _ = tiled(targets, max(16, min(CELLS, ROOM // (4 * width))), target_id, x, y)
        if max_points:
            out = _local(tiles, cells, min(max_points, n), nugget, psill, rng, kind)
        else:
            blocks, _ = factor(tiles, nugget, psill, rng)
            out = _with_variance(cells, blocks, nugget, psill, rng, kind)
        return out.withColumnRenamed("id", target_id).select(*names)
    # a covariance below eps of the diagonal (nugget + psill) is left out
    radius = cov_radius(rng, eps * (nugget + psill) / psill) if psill > 0 else 0.0
    state, _ = solve(tiles, n, nugget, psill, rng, radius, tol, max_iter)

    def sums_of(batches):
        for b in batches:
            yield _out(["a", "b"], *[[float(_matrix(d, _ROWS)[_SOL + k].sum()) for d in b.column(0)] for k in (0, 1)])

    a, b = state.select("data").mapInArrow(sums_of, "a double, b double").agg(F.sum("a"), F.sum("b")).first()
    mean = a / b

    def weigh(batches):
        for t in batches:
            rows = [np.vstack((m[_X], m[_Y], m[_SOL] - mean * m[_SOL + 1])).tobytes() for m in (_matrix(d, _ROWS) for d in t.column(1))]
            yield _out(["tile", "data"], t.column(0), (rows, pa.binary()))

    cells, _ = tiled(targets, CELLS, target_id, x, y)
    out = _predicted(cells, state.select("tile", "data").mapInArrow(weigh, "tile long, data binary"), mean, nugget, psill, rng, radius, kind)
    return out.withColumnRenamed("id", target_id).select(*names)
