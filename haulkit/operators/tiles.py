"""Tiles: points in runs along a space-filling curve, and a directory of their boxes.

Points are sorted by a curve that keeps neighbours together and cut into runs of
a given size, so a tile is compact and no tile is large, however the points are
clustered.  A tile is one row that holds its points as arrays.  The directory has the
box of every tile; its size is bounded (`DIRECTORY` and one more per partition),
so it may travel with a task, which then knows which tiles are near which.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Tiles of a table at most, besides one per partition: runs grow beyond that.
DIRECTORY = 1 << 16
BOX = ["x0", "x1", "y0", "y1"]


def _spread(v: np.ndarray) -> np.ndarray:
    """Bits of 31-bit numbers, every second place empty."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | v << np.uint64(shift)) & np.uint64(mask)
    return v


def curve(x: np.ndarray, y: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Place of points along the curve through the box (x0, x1, y0, y1)."""
    scale = float((1 << 31) - 1) / max(box[1] - box[0], box[3] - box[2], 1e-300)
    a, b = (np.clip((v - low) * scale, 0, (1 << 31) - 1).astype(np.uint64) for v, low in ((x, box[0]), (y, box[2])))
    return (_spread(a) | _spread(b) << np.uint64(1)).astype(np.int64)


def tiled(points: DataFrame, size: int, id_col: str = "ID", x: str = "X", y: str = "Y", values: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(tiles, number of points): one row per tile, checkpointed: tile, n, box, ids, xs, ys and one array per value column.

    Points without coordinates are left out.  Ids keep their type.
    """
    p = points.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                      *[F.col(v).cast("double").alias(f"v{k}") for k, v in enumerate(values)]).where("x is not null and y is not null")
    p = cut_lineage(p)
    *box, n = p.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count(F.lit(1))).first()
    size = max(size, -(-n // DIRECTORY))
    names = ["x", "y", *[f"v{k}" for k in range(len(values))]]
    arrays = ["xs", "ys", *[f"{v.lower()}s" for v in values]]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = curve(b.column(1).to_numpy(), b.column(2).to_numpy(), tuple(box))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], [*b.schema.names, "at"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, first = [], 0, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

        def tile(number: int):
            t = pa.Table.from_batches(held).combine_chunks()
            xs, ys = t.column("x").to_numpy(), t.column("y").to_numpy()
            one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), c)
            lists = [one(t.column(c).chunk(0)) for c in ["id", *names]]
            return pa.RecordBatch.from_arrays(
                [pa.array([first + number]), pa.array([len(t)], pa.int64()), *[pa.array([float(v)]) for v in (xs.min(), xs.max(), ys.min(), ys.max())], *lists],
                ["tile", "n", *BOX, "ids", *arrays])

        made = 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, size - count)
                held.append(part)
                count += part.num_rows
                b = b.slice(part.num_rows)
                if count == size:
                    yield tile(made)
                    held, count, made = [], 0, made + 1
        if count:
            yield tile(made)

    kind = p.schema["id"].dataType.simpleString()
    fields = ", ".join(f"`{a}` array<double>" for a in arrays)
    ordered = (p.mapInArrow(placed, f"id {kind}, {', '.join(f'{c} double' for c in names)}, at long")
               .repartitionByRange("at", "x", "y").sortWithinPartitions("at", "x", "y"))
    tiles = ordered.mapInArrow(cut, f"tile long, n long, x0 double, x1 double, y0 double, y1 double, ids array<{kind}>, {fields}")
    return cut_lineage(tiles), n


def directory(tiles: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile numbers, points of each, boxes as rows x0, x1, y0, y1), ascending by number: one small row per tile."""
    rows = sorted(tuple(r) for r in tiles.select("tile", "n", *BOX).collect())
    return (np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64),
            np.array([r[2:] for r in rows], float).reshape(-1, 4))


def nearest(box: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Least distance of points of one box to points of each of the others."""
    dx = np.maximum(0.0, np.maximum(boxes[:, 0] - box[1], box[0] - boxes[:, 1]))
    dy = np.maximum(0.0, np.maximum(boxes[:, 2] - box[3], box[2] - boxes[:, 3]))
    return np.hypot(dx, dy)


def farthest(box: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Largest distance of points of one box to points of each of the others."""
    dx = np.maximum(boxes[:, 1] - box[0], box[1] - boxes[:, 0])
    dy = np.maximum(boxes[:, 3] - box[2], box[3] - boxes[:, 2])
    return np.hypot(dx, dy)


__all__ = ["tiled", "directory", "nearest", "farthest", "curve", "DIRECTORY"]
