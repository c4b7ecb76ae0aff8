"""Polygon cover, scan-line mask, nearest area, tree variogram and iterative fit against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulkit.operators import krige as KR
from haulkit.operators import spatial as SP

RINGS = {
    "holed": [[(0, 0), (100, 5), (95, 100), (-5, 90)], [(40, 40), (60, 42), (58, 61), (41, 60)]],
    "L": [[(200, 0), (300, 0), (300, 30), (230, 30), (230, 100), (200, 100)]],
    "star": [[(150 + 60 * (0.4 if k % 2 else 1) * np.cos(k * np.pi / 6), 200 + 60 * (0.4 if k % 2 else 1) * np.sin(k * np.pi / 6)) for k in range(12)]],
    "small": [[(110.2, 50.1), (110.9, 50.2), (110.5, 50.9)]],
}


def edges():
    for name, rings in RINGS.items():
        for ring in rings:
            for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
                yield name, a, b, c, d


def inside(x, y):
    odd = {}
    for name, x1, y1, x2, y2 in edges():
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd[name] = not odd.get(name, False)
    return {n for n, v in odd.items() if v}


def points(n=1500, seed=3):
    r = np.random.default_rng(seed)
    return [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(r.uniform(-40, 340, n), r.uniform(-40, 300, n)))]


@pytest.mark.parametrize("cell", [20.0, 1000.0])
def test_points_meet_the_cells_of_polygons(spark, cell):
    verts = SP.polygon_vertices(spark, RINGS, proj=None)
    pts = points()
    got = {}
    for r in SP.points_in_polygon(spark.createDataFrame(pts, "id int, X double, Y double"), verts, "id", band=cell).collect():
        got.setdefault(r.id, set()).add(r.poly_id)
    assert got == {i: s for i, x, y in pts if (s := inside(x, y))}


def test_covered_cells_hold_no_edges(spark):
    verts = SP.polygon_vertices(spark, RINGS, proj=None)
    cells = SP.cover(verts, 10.0).collect()
    free = [r for r in cells if not r.edges]
    assert len(free) > 50 and all(r.inside for r in free)
    # the edge rows that points meet: those of points in cells with edges
    pts = spark.createDataFrame(points(), "id int, X double, Y double")
    met = pts.withColumns({"cx": F.floor(F.col("X") / 10), "cy": F.floor(F.col("Y") / 10)}).join(SP.cover(verts, 10.0), ["cx", "cy"])
    n = met.agg(F.sum(F.size("edges"))).first()[0]
    near = met.where("size(edges) > 0").count()
    assert n <= 4 * near and near < len(points())


@pytest.mark.parametrize("res", [1.0, 40.0])
def test_mask_is_that_of_the_centres(spark, res):
    got = {(r.poly_id, r.IX, r.IY) for r in SP.mask_cells(SP.polygon_vertices(spark, RINGS, proj=None), res).collect()}
    span = range(int(-60 // res), int(360 // res) + 1)
    assert got == {(n, i, j) for i in span for j in span for n in inside((i + 0.5) * res, (j + 0.5) * res)}


def test_nearest_area_against_all_edges(spark, monkeypatch):
    monkeypatch.setattr(SP, "EDGES", 3)
    monkeypatch.setattr(SP, "POINTS", 50)
    pts = points(400) + [(9000, 5000.0, 5000.0), (9001, -3000.0, 40.0)]
    verts = SP.polygon_vertices(spark, RINGS, proj=None)
    got = {r.id: (r.poly_id, r.METRES) for r in SP.nearest_area(spark.createDataFrame(pts, "id int, X double, Y double"), verts, "id").collect()}
    want = {}
    for i, x, y in pts:
        if not inside(x, y):
            best = None
            for name, x1, y1, x2, y2 in edges():
                t = min(1.0, max(0.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
                d = np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1))
                if best is None or d < best[1] - 1e-12:
                    best = (name, d)
            want[i] = best
    assert got.keys() == want.keys()
    for i, (name, d) in want.items():
        assert got[i][0] == name and got[i][1] == pytest.approx(d)
    none = SP.nearest_area(spark.createDataFrame(pts[:3], "id int, X double, Y double"), verts.limit(0), "id")
    assert none.count() == 0


def lattice(spark, n, seed=1):
    r = np.random.default_rng(seed)
    xs, ys, zs = r.uniform(0, 10000, n), r.uniform(0, 10000, n), r.normal(50, 2, n)
    return xs, ys, zs, spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(xs, ys, zs))],
                                             "ID long, X double, Y double, Z double")


def test_tree_counts_every_pair_once(spark):
    xs, ys, zs, df = lattice(spark, 500)
    h = np.hypot(xs[:, None] - xs, ys[:, None] - ys)
    take = (np.arange(500)[:, None] < np.arange(500)) & (h <= 6000)
    at, g = np.floor(h[take] / 1500).astype(int), 0.5 * (zs[:, None] - zs)[take] ** 2
    got = {r.BIN: r for r in KR.tree_variogram(df, 6000.0, 1500.0, leaf=8).collect()}
    assert set(got) == set(at.tolist())
    for b in got:
        assert got[b].NP == (at == b).sum() and got[b].GAMMA == pytest.approx(g[at == b].mean(), rel=1e-9)
        assert abs(got[b].DIST - h[take][at == b].mean()) <= got[b].DIST_ERROR + 1e-9
    assert KR.tree_variogram(df.limit(0), 6000.0, 1500.0).count() == 0
    assert KR.tree_variogram(df.limit(1), 6000.0, 1500.0).count() == 0


def test_tree_opens_fewer_pairs_as_points_grow(spark):
    opened = {}
    for n in (2000, 8000):
        _, _, _, df = lattice(spark, n)
        rows = KR.tree_variogram(df, 12000.0, 6000.0, leaf=8).collect()
        opened[n] = sum(r.OPENED for r in rows)
        assert sum(r.NP for r in rows) <= n * (n - 1) // 2
    assert opened[2000] < 2000 * 1999 / 2 * 0.9 and opened[8000] < 10 * opened[2000]  # all pairs: 16 times as many


def bessel(h, nugget, psill, rng):
    return nugget + psill * (1.0 - KR.xk1_np(h / rng))


def test_newton_is_no_worse_than_the_grid_and_says_if_it_converged(spark):
    h = np.linspace(1000, 60000, 15)
    noise = np.random.default_rng(4).normal(0, 0.02, 15)
    for rng, at_bound in ((9000.0, False), (2000000.0, True)):
        bins = spark.createDataFrame([(i, 100, float(a), float(b)) for i, (a, b) in enumerate(zip(h, bessel(h, 0.2, 1.0, rng) + (0 if at_bound else noise)))],
                                     "BIN int, NP long, DIST double, GAMMA double").cache()
        start, m = KR.fit_variogram(bins).first(), KR.newton_fit(bins).first()
        assert m.SSE <= start.SSE * (1 + 1e-12) and m.CONVERGED and m.RANGE_AT_BOUND is at_bound and 0 < m.ITERATIONS <= 60
        far = spark.createDataFrame([(0.0, 0.5, 30000.0)], "NUGGET double, PSILL double, RANGE double")
        if not at_bound:
            assert KR.newton_fit(bins, far).first().SSE == pytest.approx(m.SSE, rel=1e-4)
            assert KR.newton_fit(bins, far, rounds=1).first().CONVERGED is False
    assert KR.newton_fit(bins.limit(0)).first().SSE is None
