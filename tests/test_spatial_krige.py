"""Projection, window, point-in-polygon, grid, variogram and kriging."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulkit.functions.geo import ALASKA_ALBERS as A
from haulkit.functions.geo import window_corners
from haulkit.operators import krige as KR
from haulkit.operators import spatial as SP


def bessel_gamma_np(h, nugget, psill, rng):
    return np.where(h > 0, nugget + psill * (1.0 - KR.xk1_np(h / rng)), 0.0)


def krige_np(sx, sy, sz, tx, ty, nugget, psill, rng):
    """Dense global ordinary kriging."""
    sx, sy, sz, tx, ty = (np.asarray(v, float) for v in (sx, sy, sz, tx, ty))

    def cov(h):
        return np.where(h > 0, psill * KR.xk1_np(h / rng), nugget + psill)

    k = cov(np.hypot(sx[:, None] - sx, sy[:, None] - sy))
    a, b = np.linalg.solve(k, sz), np.linalg.solve(k, np.ones_like(sz))
    m = a.sum() / b.sum()
    return m + cov(np.hypot(tx[:, None] - sx, ty[:, None] - sy)) @ (a - m * b)


def samples(spark, n, seed, size=40000):
    rng = np.random.default_rng(seed)
    xs, ys, zs = rng.uniform(0, size, n), rng.uniform(0, size, n), rng.normal(3, 1, n)
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(xs, ys, zs))]
    return xs, ys, zs, spark.createDataFrame(rows, "ID long, X double, Y double, Z double")


@pytest.mark.parametrize("n,nugget,psill,rng", [(12, 0.5, 1.0, 15000.0), (12, 10.4, 0.16, 5400.0), (300, 0.3, 1.0, 4000.0)])
def test_krige_with_a_nugget_equals_the_dense_solution(spark, n, nugget, psill, rng):
    xs, ys, zs, s = samples(spark, n, n)
    at = np.random.default_rng(1).uniform(0, 40000, (2, 5))
    cells = [(i, float(a), float(b)) for i, (a, b) in enumerate(at.T)] + [(99, float(xs[3]), float(ys[3]))]
    t = spark.createDataFrame(cells, "CELL long, X double, Y double")
    got = {r["CELL"]: r["PRED"] for r in KR.krige(s, t, nugget, psill, rng).collect()}
    ref = krige_np(xs, ys, zs, [c[1] for c in cells], [c[2] for c in cells], nugget, psill, rng)
    assert [got[c[0]] for c in cells] == pytest.approx(list(ref), abs=1e-6)
    assert got[99] == pytest.approx(zs[3], abs=1e-6)       # a sample's own value is met


def test_krige_that_does_not_converge_raises(spark):
    _, _, _, s = samples(spark, 30, 8)
    t = spark.createDataFrame([(1, 5.0, 5.0)], "CELL long, X double, Y double")
    with pytest.raises(ArithmeticError):
        KR.krige(s, t, 0.0, 1.0, 15000.0, max_iter=1, tile=4)


def test_krige_without_a_variogram_gives_the_mean(spark):
    t = spark.createDataFrame([(1, 5.0, 5.0)], "CELL long, X double, Y double")
    one = spark.createDataFrame([(1, 0.0, 0.0, 2.5)], "ID long, X double, Y double, Z double")
    assert KR.krige(one, t, None, None, None).first()["PRED"] == 2.5
    flat = spark.createDataFrame([(1, 0.0, 0.0, 2.0), (2, 9.0, 0.0, 2.0)], "ID long, X double, Y double, Z double")
    assert KR.krige(flat, t, 0.0, 0.0, 100.0).first()["PRED"] == 2.0
    assert KR.krige(one.limit(0), t, 0.0, 1.0, 100.0).first()["PRED"] is None


def test_fit_tells_when_the_range_lies_on_a_bound(spark):
    h = np.linspace(1000, 60000, 15)
    for rng, at_bound in ((9000.0, False), (2000000.0, True)):
        bins = spark.createDataFrame([(i, 100, float(a), float(b)) for i, (a, b) in enumerate(zip(h, bessel_gamma_np(h, 0.2, 1.0, rng)))],
                                     "BIN int, NP long, DIST double, GAMMA double")
        assert KR.fit_variogram(bins, max_frac=3.0).first()["RANGE_AT_BOUND"] is at_bound


def test_albers_origin_and_round_trip(spark):
    df = spark.createDataFrame([(-154.0, 50.0), (-160.5, 56.25), (-164.8, 54.5)], "lon double, lat double")
    x, y = A.forward("lon", "lat")
    p = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = A.inverse("x", "y")
    back = p.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert abs(back[0]["x"]) < 1e-6 and abs(back[0]["y"]) < 1e-6
    for r in back:
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9) and r["lat2"] == pytest.approx(r["lat"], abs=1e-7)
    nx, ny = A.forward_np([-160.5], [56.25])
    assert back[1]["x"] == pytest.approx(nx[0], abs=1e-6) and back[1]["y"] == pytest.approx(ny[0], abs=1e-6)


def test_window_corners_and_crop(spark):
    (x0, x1), (y0, y1) = window_corners()
    assert x0 < x1 and y0 < y1
    pts = spark.createDataFrame([(1, (x0 + x1) / 2, (y0 + y1) / 2), (2, x1 + 1, y0)], "id int, X double, Y double")
    assert [r[0] for r in SP.crop(pts).collect()] == [1]


def test_point_in_polygon_with_hole_and_concave(spark):
    verts = SP.polygon_vertices(spark, {
        "holed": [[(0, 0), (10, 0), (10, 10), (0, 10)], [(4, 4), (6, 4), (6, 6), (4, 6)]],
        "L": [[(20, 0), (30, 0), (30, 3), (23, 3), (23, 10), (20, 10)]],
    }, proj=None)
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 21.0, 8.0), (4, 27.0, 8.0), (5, 50.0, 5.0)],
                                "id int, X double, Y double")
    got = sorted(tuple(r) for r in SP.points_in_polygon(pts, verts, "id", band=3.0).collect())
    assert got == [(1, "holed"), (3, "L")]
    assert sorted(r[0] for r in SP.outside_areas(pts, verts, "id").collect()) == [2, 4, 5]


def test_grid_covers_extent(spark):
    ext = spark.createDataFrame([(0.0, 2500.0, 1000.0, 1999.0)], "xmin double, xmax double, ymin double, ymax double")
    g = SP.make_grid(ext, 1000.0).collect()
    assert len(g) == 3 and {r["X"] for r in g} == {500.0, 1500.0, 2500.0}


def test_xk1_against_tabulated_values():
    # K1(0.5)=1.656441120, K1(1)=0.601907230, K1(2)=0.139865882, K1(5)=0.004044613 (A&S Table 9.8)
    x = np.array([0.5, 1.0, 2.0, 5.0])
    assert KR.xk1_np(x) == pytest.approx(x * np.array([1.656441120, 0.601907230, 0.139865882, 0.004044613]), rel=2e-6)


def test_variogram_tiles_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(a), float(b), float(c)) for i, (a, b, c) in
           enumerate(zip(rng.uniform(0, 30000, 40), rng.uniform(0, 30000, 40), rng.normal(2, 1, 40)))]
    df = spark.createDataFrame(pts, "ID long, X double, Y double, Z double")
    v = {r["BIN"]: (r["NP"], r["GAMMA"]) for r in KR.empirical_variogram(df, 10000.0, 2000.0).collect()}
    ref = {}
    for i in range(40):
        for j in range(i + 1, 40):
            d = np.hypot(pts[i][1] - pts[j][1], pts[i][2] - pts[j][2])
            if d <= 10000.0:
                b = int(d // 2000.0)
                n, s = ref.get(b, (0, 0.0))
                ref[b] = (n + 1, s + 0.5 * (pts[i][3] - pts[j][3]) ** 2)
    assert set(v) == set(ref)
    for b, (n, s) in ref.items():
        assert v[b][0] == n and v[b][1] == pytest.approx(s / n)


def test_krige_equals_dense_solution_and_interpolates(spark):
    rng = np.random.default_rng(5)
    n = 10
    xs, ys, zs = rng.uniform(0, 40000, n), rng.uniform(0, 40000, n), rng.normal(3, 1, n)
    s = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(xs, ys, zs))],
                              "ID long, X double, Y double, Z double")
    tx, ty = rng.uniform(0, 40000, 6), rng.uniform(0, 40000, 6)
    cells = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(tx, ty))] + [(99, float(xs[0]), float(ys[0]))]
    t = spark.createDataFrame(cells, "CELL long, X double, Y double")
    got = {r["CELL"]: r["PRED"] for r in KR.krige(s, t, 0.0, 1.0, 15000.0).collect()}
    ref = krige_np(xs, ys, zs, [c[1] for c in cells], [c[2] for c in cells], 0.0, 1.0, 15000.0)
    for i, c in enumerate(cells):
        assert got[c[0]] == pytest.approx(ref[i], abs=1e-6)
    assert got[99] == pytest.approx(zs[0], abs=1e-6)      # exact at a sample (zero nugget)


def test_fit_recovers_model(spark):
    h = np.linspace(1000, 60000, 15)
    g = bessel_gamma_np(h, 0.2, 1.0, 9000.0)
    bins = spark.createDataFrame([(i, 100, float(a), float(b)) for i, (a, b) in enumerate(zip(h, g))],
                                 "BIN int, NP long, DIST double, GAMMA double")
    m = KR.fit_variogram(bins).first()
    assert m["NUGGET"] == pytest.approx(0.2, abs=0.01) and m["PSILL"] == pytest.approx(1.0, abs=0.02)
    assert m["RANGE"] == pytest.approx(9000.0, rel=0.02)
    assert F is not None
