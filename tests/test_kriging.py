"""Tiles, preconditioned solver, kriging variance and local neighbourhoods against dense algebra."""

import numpy as np
import pytest

from haulkit.operators import krige as KR
from haulkit.operators import tiles as TL


def table(spark, xs, ys, zs=None):
    zs = np.zeros(len(xs)) if zs is None else zs
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(xs, ys, zs))],
                                 "ID long, X double, Y double, Z double")


def cells(spark, xs, ys):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(xs, ys))], "CELL long, X double, Y double")


def cov(h, nugget, psill, rng):
    return np.where(h > 0, psill * KR.xk1_np(h / rng), nugget + psill)


def dense(sx, sy, sz, tx, ty, nugget, psill, rng):
    """Prediction and variance of ordinary kriging by the system with a Lagrange multiplier."""
    n = len(sx)
    a = np.ones((n + 1, n + 1))
    a[-1, -1] = 0.0
    a[:n, :n] = cov(np.hypot(sx[:, None] - sx, sy[:, None] - sy), nugget, psill, rng)
    right = np.vstack((cov(np.hypot(sx[:, None] - tx, sy[:, None] - ty), nugget, psill, rng), np.ones(len(tx))))
    w = np.linalg.solve(a, right)
    return sz @ w[:n], nugget + psill - (w * right).sum(0)


def test_tiles_hold_every_point_once_and_boxes_cover_them(spark):
    rng = np.random.default_rng(1)
    xs = np.concatenate((rng.normal(0, 1, 300), rng.uniform(0, 1e6, 100), np.full(40, 7.0)))
    ys = np.concatenate((rng.normal(0, 1, 300), rng.uniform(0, 1e6, 100), np.full(40, 7.0)))
    t, n = TL.tiled(table(spark, xs, ys, np.arange(440)).repartition(4), 16, values=("Z",))
    rows = t.collect()
    assert n == 440 and sorted(i for r in rows for i in r.ids) == list(range(440)) and max(r.n for r in rows) <= 16
    for r in rows:
        assert r.n == len(r.ids) and list(r.xs) == [xs[i] for i in r.ids] and list(r.zs) == [float(i) for i in r.ids]
        assert (r.x0, r.x1, r.y0, r.y1) == (min(r.xs), max(r.xs), min(r.ys), max(r.ys))
    numbers, counts, boxes = TL.directory(t)
    for a in range(0, len(numbers), 7):
        pa_, near, far = next(r for r in rows if r.tile == numbers[a]), TL.nearest(boxes[a], boxes), TL.farthest(boxes[a], boxes)
        for b in range(len(numbers)):
            pb = next(r for r in rows if r.tile == numbers[b])
            h = np.hypot(np.array(pa_.xs)[:, None] - pb.xs, np.array(pa_.ys)[:, None] - pb.ys)
            assert near[b] <= h.min() + 1e-9 and far[b] >= h.max() - 1e-9
    empty, none = TL.tiled(table(spark, [], []), 16)
    assert none == 0 and empty.count() == 0


@pytest.mark.parametrize(("tile", "nugget", "psill", "rng"), [(48, 0.3, 1.0, 9000.0), (512, 0.0, 1.0, 3000.0)])
def test_value_and_variance_equal_the_dense_system(spark, tile, nugget, psill, rng):
    r = np.random.default_rng(tile)
    sx, sy, sz = r.uniform(0, 40000, 200), r.uniform(0, 40000, 200), r.normal(3, 1, 200)
    tx, ty = np.append(r.uniform(-5000, 45000, 40), sx[3]), np.append(r.uniform(-5000, 45000, 40), sy[3])
    want, spread = dense(sx, sy, sz, tx, ty, nugget, psill, rng)
    s, t = table(spark, sx, sy, sz), cells(spark, tx, ty)
    got = {x.CELL: x for x in KR.krige(s, t, nugget, psill, rng, variance=True, tile=tile).collect()}
    assert [got[i].PRED for i in range(41)] == pytest.approx(list(want), abs=1e-8)
    assert [got[i].PRED_VAR for i in range(41)] == pytest.approx(list(spread), abs=1e-8)
    if not nugget:
        assert got[40].PRED_VAR == pytest.approx(0.0, abs=1e-9) and got[40].PRED == pytest.approx(sz[3])
    plain = {x.CELL: x.PRED for x in KR.krige(s, t, nugget, psill, rng, tile=tile).collect()}
    assert [plain[i] for i in range(41)] == pytest.approx(list(want), abs=1e-6)


def clustered(n_clusters=8, each=12, seed=5):
    r = np.random.default_rng(seed)
    cx, cy = r.uniform(0, 100000, (2, n_clusters))
    sx = np.concatenate([c + r.normal(0, 150, each) for c in cx])
    sy = np.concatenate([c + r.normal(0, 150, each) for c in cy])
    return sx, sy, r.normal(3, 1, len(sx))


def test_preconditioner_halves_the_rounds_on_clustered_loggers(spark):
    sx, sy, sz = clustered()
    rounds = {}
    for tile in (1, 24):  # a tile of one sample is the plain method: the diagonal is constant
        tiles, n = TL.tiled(table(spark, sx, sy, sz), tile, values=("Z",))
        _, rounds[tile] = KR.solve(tiles, n, 0.02, 1.0, 8000.0, KR.cov_radius(8000.0, 1e-18), max_iter=400)
    assert rounds[24] * 2 <= rounds[1], rounds


def nearest_dense(sx, sy, sz, tx, ty, k, *model):
    value, spread = [], []
    for x, y in zip(tx, ty):
        take = np.lexsort((sy, sx, (sx - x) ** 2 + (sy - y) ** 2))[:k]
        a, b = dense(sx[take], sy[take], sz[take], np.array([x]), np.array([y]), *model)
        value.append(a[0])
        spread.append(b[0])
    return value, spread


@pytest.mark.parametrize("k", [1, 16])
def test_local_neighbourhoods_equal_a_search_over_all_samples(spark, k):
    r = np.random.default_rng(k)
    sx, sy, sz = clustered(6, 30, k)
    gx, gy = (v.ravel().astype(float) for v in np.meshgrid(np.arange(8) * 9000, np.arange(8) * 9000))  # lattice: ties
    sx, sy, sz = np.append(sx, gx), np.append(sy, gy), np.append(sz, r.normal(3, 1, 64))
    tx = np.concatenate((r.uniform(-40000, 140000, 60), gx[:9] + 4500, gx[:3]))
    ty = np.concatenate((r.uniform(-40000, 140000, 60), gy[:9] + 4500, gy[:3]))
    model = (0.1, 1.0, 9000.0)
    want, spread = nearest_dense(sx, sy, sz, tx, ty, k, *model)
    got = {x.CELL: x for x in KR.krige(table(spark, sx, sy, sz), cells(spark, tx, ty), *model, max_points=k, variance=True, tile=8).collect()}
    assert len(got) == len(tx)
    assert [got[i].PRED for i in range(len(tx))] == pytest.approx(want, abs=1e-7)
    assert [got[i].PRED_VAR for i in range(len(tx))] == pytest.approx(spread, abs=1e-7)


def test_local_with_all_samples_is_the_global_answer(spark):
    r = np.random.default_rng(2)
    sx, sy, sz = r.uniform(0, 40000, 50), r.uniform(0, 40000, 50), r.normal(3, 1, 50)
    t = cells(spark, r.uniform(0, 40000, 20), r.uniform(0, 40000, 20))
    s = table(spark, sx, sy, sz)
    whole = {x.CELL: x.PRED for x in KR.krige(s, t, 0.1, 1.0, 9000.0).collect()}
    for k in (50, 80):
        local = {x.CELL: x.PRED for x in KR.krige(s, t, 0.1, 1.0, 9000.0, max_points=k, tile=8).collect()}
        assert all(local[i] == pytest.approx(whole[i], abs=1e-6) for i in whole)


def test_variance_without_a_model_is_null(spark):
    t = cells(spark, [1.0], [1.0])
    one = table(spark, [0.0], [0.0], [2.5])
    row = KR.krige(one, t, None, None, None, variance=True).first()
    assert row.PRED == 2.5 and row.PRED_VAR is None
    assert KR.krige(one.limit(0), t, 0.0, 1.0, 5.0, variance=True, max_points=3).first().PRED is None
    assert KR.krige(one, t.limit(0), 0.0, 1.0, 5.0).count() == 0
