"""Bessel covariance, empirical variogram (I3, I4) and variogram fit.

Pair work is a tile equi-join (tile = search radius / SPLIT, each point listed
under the tiles it can reach), so only pairs within the radius are formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Modified Bessel function K1: polynomial approximations, Abramowitz & Stegun
# 9.8.3 (I1), 9.8.7 and 9.8.8 (K1).  FIXED published coefficients.
_I1_SMALL = [0.5, 0.87890594, 0.51498869, 0.15084934, 0.02658733, 0.00301532, 0.00032411]
_K1_SMALL = [1.0, 0.15443144, -0.67278579, -0.18156897, -0.01919402, -0.00110404, -0.00004686]
_K1_LARGE = [1.25331414, 0.23498619, -0.03655620, 0.01504268, -0.00780353, 0.00325614, -0.00068245]


def _poly(t, coefs):
    out = None
    for c in reversed(coefs):
        out = c if out is None else out * t + c
    return out


def xk1_np(x):
    """x * K1(x) for x >= 0 (x * K1(x) -> 1 as x -> 0)."""
    x = np.asarray(x, float)
    out = np.ones_like(x)
    small = (x > 0) & (x <= 2.0)
    xs = x[small]
    i1 = xs * _poly((xs / 3.75) ** 2, _I1_SMALL)
    out[small] = xs * np.log(xs / 2.0) * i1 + _poly((xs / 2.0) ** 2, _K1_SMALL)
    big = x > 2.0
    xb = x[big]
    out[big] = xb * _poly(2.0 / xb, _K1_LARGE) / (np.sqrt(xb) * np.exp(xb))
    return out


def xk1(x: Column) -> Column:
    """x * K1(x) as a column expression (same branches as `xk1_np`)."""
    t = (x / F.lit(3.75)) * (x / F.lit(3.75))
    h2 = (x / F.lit(2.0)) * (x / F.lit(2.0))
    small = x * F.log(x / F.lit(2.0)) * (x * _poly(t, _I1_SMALL)) + _poly(h2, _K1_SMALL)
    big = F.try_divide(x * _poly(F.try_divide(F.lit(2.0), x), _K1_LARGE), F.sqrt(x) * F.exp(x))
    return F.when(x <= F.lit(0.0), F.lit(1.0)).when(x <= F.lit(2.0), small).otherwise(big)


def bessel_cov(h: Column, nugget: float, psill: float, rng: float) -> Column:
    return F.when(h > F.lit(0.0), F.lit(psill) * xk1(h / F.lit(rng))).otherwise(F.lit(nugget + psill))


def cov_radius(rng: float, eps: float) -> float:
    """Distance beyond which xK1(h / range) is below eps."""
    t = 1.0
    while float(xk1_np(np.array([t]))[0]) > eps:
        t *= 1.25
    return t * rng


# ---------------------------------------------------------------- I3 / I4

def dedupe_samples(samples: DataFrame, x: str = "X", y: str = "Y", z: str = "Z", id_col: str = "ID") -> DataFrame:
    """Exact duplicate rows dropped, then coincident positions averaged
    (duplicate positions would make the kriging matrix singular)."""
    s = samples.select(x, y, z).distinct()
    s = s.groupBy(x, y).agg(F.avg(z).alias(z))
    return s.withColumn(id_col, F.xxhash64(x, y))


# Tiles per search radius: a pair's tiles are at most so many apart, plus one.
SPLIT = 4


def _tiles(df: DataFrame, x: str, y: str, size: float):
    return df.withColumns({"__tx": F.floor(F.col(x) / F.lit(size)).cast("bigint"),
                           "__ty": F.floor(F.col(y) / F.lit(size)).cast("bigint")})


def _reached(df: DataFrame, x: str, y: str, radius: float) -> DataFrame:
    """Each point under every tile of side radius / SPLIT that has a place
    within `radius` of the point's own tile: many small join keys."""
    reach = range(-SPLIT - 1, SPLIT + 2)
    near = [(i, j) for i in reach for j in reach
            if max(abs(i) - 1, 0) ** 2 + max(abs(j) - 1, 0) ** 2 <= SPLIT ** 2]
    offs = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i, j in near])
    t = _tiles(df, x, y, radius / SPLIT).withColumn("__o", F.explode(offs))
    return t.withColumns({"__tx": F.col("__tx") + F.col("__o.dx"), "__ty": F.col("__ty") + F.col("__o.dy")}).drop("__o")


def neighbour_pairs(points: DataFrame, radius: float, id_col: str = "ID", x: str = "X", y: str = "Y",
                    z: str | None = "Z", include_self: bool = False) -> DataFrame:
    """(i, j, dist[, zi, zj]) for i < j (or i <= j) within `radius`.

    Tiles of side radius / SPLIT; the right side is listed under the tiles it
    can reach, so each close pair meets in exactly one tile: an equi-join."""
    cols = [id_col, x, y] + ([z] if z else [])
    a = _tiles(points.select(*cols), x, y, radius / SPLIT)
    b = _reached(points.select(*cols), x, y, radius)
    b = b.select(*[F.col(c).alias(c + "_j") for c in cols], "__tx", "__ty")
    j = a.join(b, ["__tx", "__ty"])
    d = F.sqrt((F.col(x) - F.col(x + "_j")) ** 2 + (F.col(y) - F.col(y + "_j")) ** 2)
    order = (F.col(id_col) <= F.col(id_col + "_j")) if include_self else (F.col(id_col) < F.col(id_col + "_j"))
    j = j.withColumn("DIST", d).where(order & (F.col("DIST") <= F.lit(radius)))
    out = [F.col(id_col).alias("I"), F.col(id_col + "_j").alias("J"), "DIST"]
    if z:
        out += [F.col(z).alias("ZI"), F.col(z + "_j").alias("ZJ")]
    return j.select(*out)


def empirical_variogram(points: DataFrame, cutoff: float, width: float, id_col: str = "ID",
                        x: str = "X", y: str = "Y", z: str = "Z") -> DataFrame:
    """I4: per distance bin (width `width`, up to `cutoff`): pair count, mean
    distance, mean semivariance 0.5 (zi - zj)^2."""
    p = neighbour_pairs(points, cutoff, id_col, x, y, z)
    p = p.withColumn("BIN", F.floor(F.col("DIST") / F.lit(width)).cast("int"))
    return p.groupBy("BIN").agg(F.count(F.lit(1)).alias("NP"), F.avg("DIST").alias("DIST"),
                                F.avg(F.lit(0.5) * (F.col("ZI") - F.col("ZJ")) ** 2).alias("GAMMA"))


# Points of a leaf, children of a node, and nodes that the search starts from.
LEAF, FAN, START = 16, 4, 64


def _tree(leaves: np.ndarray) -> list[np.ndarray]:
    """Levels of nodes, the leaves first: rows n, sum z, sum z^2, x0, x1, y0, y1, sum x, sum y; FAN neighbours make one parent."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        cuts = np.arange(0, len(below), FAN)
        up = np.add.reduceat(below, cuts)
        for c, pick in ((3, np.minimum), (4, np.maximum), (5, np.minimum), (6, np.maximum)):
            up[:, c] = pick.reduceat(below[:, c], cuts)
        levels.append(up)
    return levels


def _walk(levels: list[np.ndarray], level: int, a: np.ndarray, b: np.ndarray, cutoff: float, width: float):
    """Pairs of nodes (a <= b) of a level down to the leaves: (bin, pairs, sum of semivariances, sum of distances of centres,
    sum of their bounds) of those that lie in one bin, and the pairs of leaves that must be opened."""
    bins = int(cutoff // width) + 1
    whole = np.zeros((4, bins))
    while len(a):
        p, q = levels[level][a], levels[level][b]
        dx = np.maximum(0.0, np.maximum(q[:, 3] - p[:, 4], p[:, 3] - q[:, 4]))
        dy = np.maximum(0.0, np.maximum(q[:, 5] - p[:, 6], p[:, 5] - q[:, 6]))
        low = np.hypot(dx, dy) * (1 - 1e-12)
        high = np.hypot(np.maximum(q[:, 4] - p[:, 3], p[:, 4] - q[:, 3]), np.maximum(q[:, 6] - p[:, 5], p[:, 6] - q[:, 5])) * (1 + 1e-12)
        at = np.floor(low / width).astype(int)
        one = (high <= cutoff) & (at == np.floor(high / width))
        same, n, m = a == b, p[:, 0], q[:, 0]
        pairs = np.where(same, n * (n - 1) / 2, n * m)
        gamma = 0.5 * np.where(same, n * p[:, 2] - p[:, 1] ** 2, m * p[:, 2] + n * q[:, 2] - 2 * p[:, 1] * q[:, 1])
        centre = np.where(same, (low + high) / 2, np.hypot(p[:, 7] / n - q[:, 7] / m, p[:, 8] / n - q[:, 8] / m))
        for k, v in enumerate((pairs, gamma, pairs * centre, pairs * (high - low))):
            whole[k] += np.bincount(at[one], v[one], bins)
        more = ~one & (low <= cutoff)
        a, b = a[more], b[more]
        if not level:
            return whole, a, b
        level -= 1
        size = len(levels[level])
        i, j = (x.ravel() for x in np.meshgrid(np.arange(FAN), np.arange(FAN), indexing="ij"))
        a, b = (a[:, None] * FAN + i).ravel(), (b[:, None] * FAN + j).ravel()
        there = (a < size) & (b < size) & (a <= b)
        a, b = a[there], b[there]
    return whole, a, b


def tree_variogram(points: DataFrame, cutoff: float, width: float, id_col: str = "ID", x: str = "X", y: str = "Y", z: str = "Z",
                   leaf: int = LEAF) -> DataFrame:
    """I4 by a tree of tiles: BIN, NP, GAMMA as `empirical_variogram`, exactly, and DIST with its bound, OPENED.

    Nodes carry their number of points, sums of z and z^2 and box.  A pair of nodes
    whose distances all lie in one bin adds its moments; the others are opened, down to
    leaves, and only points of opened pairs of leaves (OPENED of them) meet one by one.  DIST
    takes the distance of centres for pairs of whole nodes: the mean lies within DIST_ERROR of
    it.  The tree has 65,536 leaves at most, besides one per partition; it travels with the tasks,
    and pairs of its upper nodes are dealt out to them.
    """
    from .tiles import tiled
    mean = points.agg(F.avg(z)).first()[0] or 0.0
    tiles, _ = tiled(points.withColumn("__z", F.col(z) - F.lit(mean)).where(F.col("__z").isNotNull()), leaf, id_col, x, y, ("__z",))
    tiles = tiles.withColumnRenamed("__zs", "zs")

    def total(c, f=lambda v: v):
        return F.aggregate(c, F.lit(0.0), lambda a, v: a + f(v))
    rows = sorted(tuple(r) for r in tiles.select("tile", F.col("n").cast("double"), total("zs"), total("zs", lambda v: v * v),
                                                 "x0", "x1", "y0", "y1", total("xs"), total("ys")).collect())
    numbers, levels = [r[0] for r in rows], _tree(np.array([r[1:] for r in rows], float).reshape(-1, 9))
    top = next((k for k, nodes in enumerate(levels) if len(nodes) <= START), 0)
    spark = points.sparkSession
    schema = "a long, b long, BIN int, NP double, G double, D double, E double, OPENED long"

    def batch(**columns):
        n = max(len(v) for v in columns.values())
        kinds = {"a": pa.int64(), "b": pa.int64(), "BIN": pa.int32(), "OPENED": pa.int64()}
        names = ["a", "b", "BIN", "NP", "G", "D", "E", "OPENED"]
        return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds.get(c, pa.float64())) if c in columns else
                                           pa.nulls(n, kinds.get(c, pa.float64())) for c in names], names)

    def search(batches):
        for t in batches:
            for k in range(t.num_rows):
                whole, i, j = _walk(levels, top, *(np.array([t.column(c)[k].as_py()]) for c in (0, 1)), cutoff, width)
                found = np.flatnonzero(whole[0])
                if len(found):
                    yield batch(BIN=found, NP=whole[0][found], G=whole[1][found], D=whole[2][found], E=whole[3][found])
                for at in range(0, len(i), 10_000):
                    yield batch(a=[numbers[v] for v in i[at:at + 10_000]], b=[numbers[v] for v in j[at:at + 10_000]])

    def meet(batches):
        for t in batches:
            points_of = [[t.column(2 + 3 * s + c) for c in range(3)] for s in (0, 1)]
            bins = int(cutoff // width) + 1
            np_, g, d, opened = np.zeros(bins), np.zeros(bins), np.zeros(bins), 0
            for k in range(t.num_rows):
                (ax, ay, az), (bx, by, bz) = ([c[k].values.to_numpy() for c in side] for side in points_of)
                h, dz = np.hypot(ax[:, None] - bx, ay[:, None] - by), az[:, None] - bz
                use = h <= cutoff
                if t.column(0)[k].as_py() == t.column(1)[k].as_py():
                    use &= np.arange(len(ax))[:, None] < np.arange(len(ax))
                at, opened = np.floor(h[use] / width).astype(int), opened + h.size
                np_ += np.bincount(at, minlength=bins)
                g += np.bincount(at, 0.5 * dz[use] ** 2, bins)
                d += np.bincount(at, h[use], bins)
            found = np.arange(bins)
            yield batch(BIN=found, NP=np_, G=g, D=d, E=np.zeros(bins), OPENED=np.where(found == 0, opened, 0))

    n_top = len(levels[top])
    start = (spark.range(n_top).select(F.col("id").alias("a"), F.explode(F.sequence(F.col("id"), F.lit(n_top - 1).cast("long"))).alias("b"))
             if n_top else spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b")))
    deals = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = cut_lineage(start.repartition(deals, "a", "b").mapInArrow(search, schema))
    side = [tiles.select(F.col("tile").alias(s), *[F.col(c).alias(f"{s}{c}") for c in ("xs", "ys", "zs")]) for s in ("a", "b")]
    met = (found.where("BIN IS NULL").select("a", "b").join(side[0], "a").join(side[1], "b")
           .select("a", "b", "axs", "ays", "azs", "bxs", "bys", "bzs").mapInArrow(meet, schema))
    sums = found.where("BIN IS NOT NULL").unionByName(met).groupBy("BIN").agg(*[F.sum(c).alias(c) for c in ("NP", "G", "D", "E")], F.sum("OPENED").alias("OPENED"))
    return sums.where("NP > 0").select("BIN", F.round("NP").cast("long").alias("NP"), (F.col("D") / F.col("NP")).alias("DIST"),
                                       (F.col("E") / F.col("NP")).alias("DIST_ERROR"), (F.col("G") / F.col("NP")).alias("GAMMA"),
                                       F.coalesce("OPENED", F.lit(0)).alias("OPENED"))


# ---------------------------------------------------------------- I5

def _fit_for_ranges(b: DataFrame, ranges: Column) -> DataFrame:
    """For each candidate range the Bessel model is linear in (nugget, psill):
    solve the 2x2 weighted normal equations exactly (clipped to >= 0), then
    score the fit.  `b` holds the bins as one array."""
    g = b.select("bins", "dmax", F.explode(ranges).alias("RANGE"))
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("sw", "sf", "sff", "sg", "sfg")])

    def acc(a, bin_):
        h = bin_["DIST"]
        w = bin_["NP"].cast("double") / F.greatest(h * h, F.lit(1e-12))
        f = F.lit(1.0) - xk1(h / F.col("RANGE"))
        gm = bin_["GAMMA"]
        return F.struct((a["sw"] + w).alias("sw"), (a["sf"] + w * f).alias("sf"), (a["sff"] + w * f * f).alias("sff"),
                        (a["sg"] + w * gm).alias("sg"), (a["sfg"] + w * f * gm).alias("sfg"))

    g = g.withColumn("m", F.aggregate("bins", zero, acc))
    sw, sf, sff, sg, sfg = (F.col("m." + k) for k in ("sw", "sf", "sff", "sg", "sfg"))
    det = sw * sff - sf * sf
    # try_divide: Spark may evaluate shared subexpressions ahead of the `when`
    c0 = F.try_divide(sg * sff - sf * sfg, det)
    c1 = F.try_divide(sw * sfg - sf * sg, det)
    c1_only = F.greatest(F.coalesce(F.try_divide(sfg, sff), F.lit(0.0)), F.lit(0.0))
    c0_only = F.greatest(F.coalesce(F.try_divide(sg, sw), F.lit(0.0)), F.lit(0.0))
    g = g.withColumns({
        "NUGGET": F.when((det > 0) & (c0 >= 0) & (c1 >= 0), c0).when((det > 0) & (c0 < 0), F.lit(0.0)).otherwise(c0_only),
        "PSILL": F.when((det > 0) & (c0 >= 0) & (c1 >= 0), c1).when((det > 0) & (c0 < 0), c1_only).otherwise(F.lit(0.0)),
    })

    def err(a, bin_):
        h = bin_["DIST"]
        w = bin_["NP"].cast("double") / F.greatest(h * h, F.lit(1e-12))
        model = F.col("NUGGET") + F.col("PSILL") * (F.lit(1.0) - xk1(h / F.col("RANGE")))
        return a + w * (bin_["GAMMA"] - model) * (bin_["GAMMA"] - model)

    g = g.withColumn("SSE", F.aggregate("bins", F.lit(0.0), err))
    return g.select("bins", "dmax", "NUGGET", "PSILL", "RANGE", "SSE")


def fit_variogram(vario: DataFrame, n_range: int = 120, refine: int = 60, min_frac: float = 0.01,
                  max_frac: float = 3.0) -> DataFrame:
    """I5 (re-aimed): weighted least squares (weights N_j / h_j^2, gstat's
    default fit method) of the Bessel model.

    Nugget and partial sill are solved exactly per range; the range is
    searched on a geometric grid between `min_frac` and `max_frac` of the
    largest lag, then refined around the best; RANGE_AT_BOUND tells when the
    best one lies on an end of that grid, so that a better one may lie beyond.  The bins (bounded: cutoff /
    width of them) travel as one array; candidates are generated with
    `sequence` + `explode`; `min_by` picks the best.  No join, no driver loop
    over data."""
    b = vario.agg(F.collect_list(F.struct("NP", "DIST", "GAMMA")).alias("bins"), F.max("DIST").alias("dmax"))
    lo, hi = F.col("dmax") * F.lit(min_frac), F.col("dmax") * F.lit(max_frac)
    ratio = F.pow(hi / lo, F.lit(1.0 / (n_range - 1)))
    coarse = F.transform(F.sequence(F.lit(0), F.lit(n_range - 1)), lambda i: lo * F.pow(ratio, i))
    # the bins ride along through the first aggregate (same array on every row)
    b2 = _fit_for_ranges(b, coarse).agg(F.min_by("RANGE", "SSE").alias("best"), F.first("bins").alias("bins"),
                                        F.first("dmax").alias("dmax"))
    r0 = F.col("best") / ratio
    step = (F.col("best") * ratio - r0) / F.lit(float(refine - 1))
    fine = F.transform(F.sequence(F.lit(0), F.lit(refine - 1)), lambda i: r0 + step * i)
    best = _fit_for_ranges(b2, fine).agg(F.min_by(F.struct("NUGGET", "PSILL", "RANGE", "SSE"), "SSE").alias("m"),
                                         F.first("dmax").alias("dmax"))
    edge = (F.col("m.RANGE") <= F.col("dmax") * F.lit(min_frac) * 1.0001) | (F.col("m.RANGE") >= F.col("dmax") * F.lit(max_frac) * 0.9999)
    return best.select("m.NUGGET", "m.PSILL", "m.RANGE", "m.SSE", edge.alias("RANGE_AT_BOUND"))


def newton_fit(vario: DataFrame, start: DataFrame | None = None, rounds: int = 60, tol: float = 1e-10,
               min_frac: float = 0.01, max_frac: float = 3.0) -> DataFrame:
    """I5 by iteration: NUGGET, PSILL, RANGE, SSE, ITERATIONS, CONVERGED, RANGE_AT_BOUND, from a start (default: `fit_variogram`).

    Damped Gauss-Newton steps on (nugget, partial sill, log of the range): a step that
    does not lower the weighted error is shortened, so the error is never larger than the start's.
    Nugget and partial sill stay at 0 or above and the range between `min_frac` and `max_frac` of the
    largest lag, or the start's where that lies beyond.  CONVERGED: the last step changed the error by less than `tol` of it.  The bins travel
    as one array (cutoff / width of them) to one task.  Without bins or start all is null.
    """
    start = start if start is not None else fit_variogram(vario)
    bins = vario.agg(F.collect_list(F.struct(F.col("NP").cast("double").alias("n"), "DIST", "GAMMA")).alias("bins"))
    one = bins.withColumn("__one", F.lit(1)).join(start.select("NUGGET", "PSILL", "RANGE", F.lit(1).alias("__one")), "__one")
    schema = "NUGGET double, PSILL double, RANGE double, SSE double, ITERATIONS int, CONVERGED boolean, RANGE_AT_BOUND boolean"

    def model(p, h):
        x = h / np.exp(p[2])
        return p[0] + p[1] * (1.0 - xk1_np(x))

    def fitted(n, h, g, p):
        w = np.sqrt(n / np.maximum(h * h, 1e-12))
        least, most = np.log(h.max() * min_frac), np.log(h.max() * max_frac)
        low, high = np.array([0.0, 0.0, min(least, p[2])]), np.array([np.inf, np.inf, max(most, p[2])])
        p = np.clip(p, low, high)
        error, damp, converged, used = float(((w * (g - model(p, h))) ** 2).sum()), 1e-3, False, 0
        for used in range(1, rounds + 1):
            step = 1e-6
            slope = (xk1_np(h / np.exp(p[2] + step)) - xk1_np(h / np.exp(p[2] - step))) / (2 * step)
            j = w[:, None] * np.column_stack((np.ones_like(h), 1.0 - xk1_np(h / np.exp(p[2])), -p[1] * slope))
            rest = w * (g - model(p, h))
            a, b = j.T @ j, j.T @ rest
            better = False
            while damp < 1e12 and not better:
                new = np.clip(p + np.linalg.lstsq(a + damp * np.diag(np.diag(a) + 1e-300), b, rcond=None)[0], low, high)
                now = float(((w * (g - model(new, h))) ** 2).sum())
                better = now <= error
                damp = max(damp / 10, 1e-12) if better else damp * 10
            if not better:
                converged = True  # no step lowers the error
                break
            gain, p, error = error - now, new, now
            if gain <= tol * max(error, 1e-300):
                converged = True
                break
        at = bool(p[2] <= least + 1e-4 or p[2] >= most - 1e-4)
        return float(p[0]), float(p[1]), float(np.exp(p[2])), error, used, converged, at

    def task(batches):
        for t in batches:
            out = []
            for k in range(t.num_rows):
                rows = t.column(0)[k].as_py()
                n, h, g = (np.array([r[c] for r in rows], float) for c in ("n", "DIST", "GAMMA"))
                p = [t.column(c)[k].as_py() for c in (1, 2, 3)]
                ok = len(n) and all(v is not None for v in p) and p[2] > 0
                out.append(fitted(n, h, g, np.array([p[0], p[1], np.log(p[2])])) if ok else (None,) * 7)
            kinds = [pa.float64()] * 4 + [pa.int32(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)],
                                             ["NUGGET", "PSILL", "RANGE", "SSE", "ITERATIONS", "CONVERGED", "RANGE_AT_BOUND"])

    return one.select("bins", "NUGGET", "PSILL", "RANGE").mapInArrow(task, schema)


__all__ = ["xk1", "xk1_np", "bessel_cov", "cov_radius", "dedupe_samples", "neighbour_pairs", "empirical_variogram", "tree_variogram",
           "fit_variogram", "newton_fit"]
