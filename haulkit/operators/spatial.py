"""Geometry on DataFrames: point-in-polygon (I7), areas check (I10), 1 km
grid (I2), window crop (I9) and projection (I1, via functions.geo).

Polygons are vertex tables (poly_id, ring, seq, x, y) in projected metres.
Point-in-polygon is an equi-join of a point's cell with the cells that a polygon
covers or touches: no nested-loop or cross join, edges are looked at in cells
that they touch only, and holes work because every ring's edges count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.geo import ALASKA_ALBERS, Albers, in_window


def project(df: DataFrame, lon: str = "LON_DD", lat: str = "LAT_DD", proj: Albers = ALASKA_ALBERS,
            x: str = "X", y: str = "Y", digits: int | None = 2) -> DataFrame:
    """lon/lat -> projected x/y columns (rounded to cm by default)."""
    from ..functions.scalar import fix
    px, py = proj.forward(lon, lat)
    if digits is not None:
        px, py = fix(px, digits), fix(py, digits)
    return df.withColumns({x: px, y: py})


def crop(df: DataFrame, x: str = "X", y: str = "Y", corners=None) -> DataFrame:
    """Keep points inside the projected plot window."""
    return df.where(in_window(x, y, corners))


def polygon_vertices(spark: SparkSession, rings: dict, proj: Albers | None = ALASKA_ALBERS) -> DataFrame:
    """Vertex table from {poly_id: [ring0 [(lon, lat), ...], ring1 ...]}; lon/lat
    projected when `proj` is given.  Layers are bounded in size by design."""
    rows = []
    for pid, rs in rings.items():
        for ri, ring in enumerate(rs):
            for si, (a, b) in enumerate(ring):
                if proj is not None:
                    xa, yb = proj.forward_np([a], [b])
                    a, b = xa[0], yb[0]
                rows.append((pid, ri, si, float(a), float(b)))
    return spark.createDataFrame(rows, "poly_id string, ring int, seq int, x double, y double")


def polygon_edges(vertices: DataFrame) -> DataFrame:
    """Ring edges (closing edge included) from a vertex table."""
    w = Window.partitionBy("poly_id", "ring").orderBy("seq")
    v = vertices.select("poly_id", "ring", "seq", "x", "y",
                        F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2"),
                        F.first("x").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("fx"),
                        F.first("y").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("fy"))
    return v.select("poly_id", "ring", F.col("x").alias("x1"), F.col("y").alias("y1"),
                    F.coalesce("x2", "fx").alias("x2"), F.coalesce("y2", "fy").alias("y2"))


def mask_cells(vertices: DataFrame, res: float, at: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """I7 for a raster: (poly_id, IX, IY) of every cell of `res` metres whose centre (or place `at`) lies inside, by scan lines.

    Each row of cells has the crossings of its centre line with the polygon's edges; sorted,
    they bound runs of cells, which are listed.  No cell is tested."""
    r = F.lit(float(res))
    e = polygon_edges(vertices).where("y1 <> y2")
    rows = F.sequence(F.floor(F.least("y1", "y2") / r - 1).cast("bigint"), F.floor(F.greatest("y1", "y2") / r).cast("bigint"))
    e = e.withColumn("IY", F.explode(rows)).withColumn("__y", (F.col("IY") + F.lit(at[1])) * r)
    e = e.where((F.col("y1") > F.col("__y")) != (F.col("y2") > F.col("__y")))
    cross = F.col("x1") + (F.col("__y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    runs = e.groupBy("poly_id", "IY").agg(F.sort_array(F.collect_list(cross)).alias("c"))
    runs = runs.select("poly_id", "IY", "c", F.explode(F.sequence(F.lit(0), F.size("c") - 2, F.lit(2))).alias("k"))
    runs = runs.select("poly_id", "IY", F.col("c")[F.col("k")].alias("c0"), F.col("c")[F.col("k") + 1].alias("c1"))
    # one cell more on either side, as the bounds are rounded; then the centres themselves decide
    cells = runs.select("poly_id", "IY", "c0", "c1", F.explode(F.sequence(F.floor(F.col("c0") / r - 1).cast("bigint"),
                                                                          F.ceil(F.col("c1") / r).cast("bigint"))).alias("IX"))
    x = (F.col("IX") + F.lit(at[0])) * r
    return cells.where((x >= F.col("c0")) & (x < F.col("c1"))).select("poly_id", "IX", "IY")


# Place in a cell that stands for it, in parts of its width: about the middle, and off the
# round numbers on which edges tend to lie.
MIDDLE = (0.487130291, 0.519271843)


def cover(vertices: DataFrame, cell: float) -> DataFrame:
    """(poly_id, cx, cy, inside, edges): the cells of `cell` metres that a polygon meets.

    inside: whether the cell's MIDDLE is; edges: those that touch the cell, none where the polygon covers it."""
    r = F.lit(float(cell))
    e = polygon_edges(vertices)
    e = e.withColumn("cy", F.explode(F.sequence(F.floor(F.least("y1", "y2") / r).cast("bigint"), F.floor(F.greatest("y1", "y2") / r).cast("bigint"))))
    # the edge within the row of cells, and its cells there
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    low, high = F.greatest(F.least("y1", "y2"), F.col("cy") * r), F.least(F.greatest("y1", "y2"), (F.col("cy") + 1) * r)
    ends = [F.when(slope.isNull(), F.col(end)).otherwise(F.col("x1") + (at - F.col("y1")) * slope) for at, end in ((low, "x1"), (high, "x2"))]
    reach = F.lit(1e-9) * r  # rounding of the ends
    span = F.sequence(F.floor((F.least(*ends) - reach) / r).cast("bigint"), F.floor((F.greatest(*ends) + reach) / r).cast("bigint"))
    touched = e.select("poly_id", F.explode(span).alias("cx"), "cy", F.struct("x1", "y1", "x2", "y2").alias("edge"), F.lit(False).alias("inside"))
    middles = mask_cells(vertices, cell, MIDDLE).select("poly_id", F.col("IX").alias("cx"), F.col("IY").alias("cy"), F.lit(True).alias("inside"))
    return (touched.unionByName(middles, allowMissingColumns=True).groupBy("poly_id", "cx", "cy")
            .agg(F.max("inside").alias("inside"), F.collect_list("edge").alias("edges")))


def points_in_polygon(points: DataFrame, vertices: DataFrame, id_col: str, x: str = "X", y: str = "Y",
                      band: float = 10_000.0) -> DataFrame:
    """(point id, poly_id) for every point inside a polygon (even-odd rule).

    A point meets the polygons of its own cell (`band` metres wide) only.  In a cell that
    a polygon covers no edge is looked at; in a cell with edges the point is where the
    cell's MIDDLE is unless the way there crosses an odd number of the cell's edges."""
    r = F.lit(float(band))
    p = points.select(F.col(id_col), F.col(x).alias("__px"), F.col(y).alias("__py"),
                      F.floor(F.col(x) / r).cast("bigint").alias("cx"), F.floor(F.col(y) / r).cast("bigint").alias("cy"))
    px, py = F.col("__px"), F.col("__py")
    mx, my = (F.col("cx") + F.lit(MIDDLE[0])) * r, (F.col("cy") + F.lit(MIDDLE[1])) * r

    def left(ax, ay, bx, by, cx, cy):
        return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax) > 0

    def crossed(e):
        between = left(px, py, mx, my, e["x1"], e["y1"]) != left(px, py, mx, my, e["x2"], e["y2"])
        return between & (left(e["x1"], e["y1"], e["x2"], e["y2"], px, py) != left(e["x1"], e["y1"], e["x2"], e["y2"], mx, my))
    odd = F.size(F.filter("edges", crossed)) % 2 == 1
    return p.join(cover(vertices, band), ["cx", "cy"]).where(F.col("inside") != odd).select(id_col, "poly_id")


def outside_areas(points: DataFrame, vertices: DataFrame, id_col: str, x: str = "X", y: str = "Y") -> DataFrame:
    """Points that fall in none of the polygons (stray coordinates)."""
    inside = points_in_polygon(points, vertices, id_col, x, y).select(id_col).distinct()
    return points.join(inside, id_col, "left_anti")


# Edges of a tile, points of a block.
EDGES, POINTS = 64, 1024


def nearest_area(points: DataFrame, vertices: DataFrame, id_col: str, x: str = "X", y: str = "Y") -> DataFrame:
    """id_col, X, Y, poly_id, METRES: the polygon with the nearest edge, for points in none; 0 inside a polygon needs no edge.

    Edges lie in tiles along a curve.  For a block of points some tile of edges has all its
    edges within a distance D; only tiles that come nearer than D are sent to the block, which reads them
    from the nearest on and stops when no point can gain.  Ties go to the smaller poly_id; without
    polygons the result is empty.
    """
    import numpy as np
    import pyarrow as pa

    from .tiles import directory, farthest, nearest, tiled
    e = polygon_edges(vertices).withColumns({"__mx": (F.col("x1") + F.col("x2")) / 2, "__my": (F.col("y1") + F.col("y2")) / 2})
    edges, n = tiled(e, EDGES, "poly_id", "__mx", "__my", ("x1", "y1", "x2", "y2"))
    blocks, _ = tiled(points.select(id_col, x, y), POINTS, id_col, x, y)
    kind = points.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, X double, Y double, poly_id string, METRES double"
    if not n:
        return points.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    ends = {"x0": F.least(F.array_min("x1s"), F.array_min("x2s")), "x1": F.greatest(F.array_max("x1s"), F.array_max("x2s")),
            "y0": F.least(F.array_min("y1s"), F.array_min("y2s")), "y1": F.greatest(F.array_max("y1s"), F.array_max("y2s"))}
    edges = edges.select("tile", "n", *[v.alias(k) for k, v in ends.items()], F.col("ids").cast("array<string>").alias("polys"), "x1s", "y1s", "x2s", "y2s")
    numbers, _, boxes = directory(edges)

    def asked(batches):
        for b in batches:
            for k in range(b.num_rows):
                box = np.array([b.column(c)[k].as_py() for c in range(1, 5)])
                gap = nearest(box, boxes)
                take = np.flatnonzero(gap <= farthest(box, boxes).min())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(take), b.column(0)[k].as_py())), pa.array(numbers[take]), pa.array(gap[take])],
                                                 ["tile", "edge_tile", "gap"])

    def searched(batches):
        def done():
            return pa.RecordBatch.from_arrays([ids, pa.array(px), pa.array(py), pa.array(poly.tolist(), pa.string()), pa.array(best)],
                                              ["id", "X", "Y", "poly_id", "METRES"])

        ids = None
        for b in batches:
            for k in range(b.num_rows):
                gap = b.column(1)[k].as_py()
                if gap < 0:
                    if ids is not None:
                        yield done()
                    ids, px, py = b.column(2)[k].values, *(b.column(c)[k].values.to_numpy() for c in (3, 4))
                    best, poly = np.full(len(px), np.inf), np.full(len(px), None, object)
                elif gap <= best.max():
                    x1, y1, x2, y2 = (b.column(c)[k].values.to_numpy() for c in range(6, 10))
                    names = np.array(b.column(5)[k].as_py(), object)
                    dx, dy = x2 - x1, y2 - y1
                    size = dx * dx + dy * dy
                    u, v = px[:, None] - x1, py[:, None] - y1
                    t = np.clip((u * dx + v * dy) / np.where(size > 0, size, 1.0), 0.0, 1.0)
                    d = np.sqrt((u - t * dx) ** 2 + (v - t * dy) ** 2)
                    low = d.min(axis=1)
                    for i in np.flatnonzero(low <= best):
                        name = min(names[d[i] == low[i]])
                        if low[i] < best[i] or name < poly[i]:
                            best[i], poly[i] = low[i], name
        if ids is not None:
            yield done()

    pairs = blocks.select("tile", "x0", "x1", "y0", "y1").mapInArrow(asked, "tile long, edge_tile long, gap double")
    sent = pairs.join(edges.select(F.col("tile").alias("edge_tile"), "polys", "x1s", "y1s", "x2s", "y2s"), "edge_tile").drop("edge_tile")
    own = blocks.select("tile", F.lit(-1.0).alias("gap"), "ids", "xs", "ys")
    met = own.unionByName(sent, allowMissingColumns=True).select("tile", "gap", "ids", "xs", "ys", "polys", "x1s", "y1s", "x2s", "y2s")
    far = met.repartition("tile").sortWithinPartitions("tile", "gap").mapInArrow(searched, schema).withColumnRenamed("id", id_col)
    inside = points_in_polygon(points, vertices, id_col, x, y).select(id_col).distinct()
    return far.join(inside, id_col, "left_anti")


def make_grid(extent: DataFrame, res: float = K.GRID_RES_M, partitions: int | None = None) -> DataFrame:
    """Cells of `res` metres covering the extent row(s) (xmin, xmax, ymin,
    ymax columns), aligned to multiples of `res`; one row per cell centre.

    The extent comes from Spark (an aggregate), so no value passes through the
    driver; columns are generated with `sequence` + `explode`, repartitioned
    on the column index before the rows are expanded."""
    r = F.lit(float(res))
    e = extent.select(F.floor(F.col("xmin") / r).cast("bigint").alias("ix0"),
                      F.floor(F.col("xmax") / r).cast("bigint").alias("ix1"),
                      F.floor(F.col("ymin") / r).cast("bigint").alias("iy0"),
                      F.floor(F.col("ymax") / r).cast("bigint").alias("iy1"))
    cols = e.select(F.explode(F.sequence("ix0", "ix1")).alias("IX"), "iy0", "iy1")
    if partitions:
        cols = cols.repartition(partitions, "IX")
    cells = cols.select("IX", F.explode(F.sequence("iy0", "iy1")).alias("IY"))
    return cells.select("IX", "IY", ((F.col("IX") + F.lit(0.5)) * r).alias("X"),
                        ((F.col("IY") + F.lit(0.5)) * r).alias("Y"))


def extent_of(points: DataFrame, x: str = "X", y: str = "Y") -> DataFrame:
    return points.agg(F.min(x).alias("xmin"), F.max(x).alias("xmax"), F.min(y).alias("ymin"), F.max(y).alias("ymax"))


# Test polygon layers in lon/lat (a square, a square with a hole, a concave L):
# FIXED layer definitions standing in for the strata / closure-area layers.
TEST_LAYERS = {
    "strata": [[(-164.0, 55.0), (-161.0, 55.0), (-161.0, 57.0), (-164.0, 57.0)]],
    "savings_area": [[(-163.5, 55.5), (-160.0, 55.5), (-160.0, 58.0), (-163.5, 58.0)],
                     [(-162.5, 56.2), (-161.0, 56.2), (-161.0, 57.2), (-162.5, 57.2)]],
    "closure_L": [[(-164.5, 54.7), (-162.0, 54.7), (-162.0, 55.5), (-163.5, 55.5), (-163.5, 56.8), (-164.5, 56.8)]],
}


def layer_edges_sql(rings: dict = TEST_LAYERS, proj: Albers = ALASKA_ALBERS) -> str:
    """The same layers as a SQL VALUES edge list (oracle)."""
    vals = []
    for pid, rs in rings.items():
        for ring in rs:
            pts = [tuple(float(v[0]) for v in proj.forward_np([a], [b])) for a, b in ring]
            for i, (x1, y1) in enumerate(pts):
                x2, y2 = pts[(i + 1) % len(pts)]
                vals.append(f"('{pid}', {x1!r}, {y1!r}, {x2!r}, {y2!r})")
    return "(SELECT * FROM (VALUES " + ", ".join(vals) + ") t(poly_id, x1, y1, x2, y2))"


__all__ = ["project", "crop", "polygon_vertices", "polygon_edges", "points_in_polygon", "outside_areas",
           "mask_cells", "cover", "nearest_area", "make_grid", "extent_of", "TEST_LAYERS", "layer_edges_sql"]
