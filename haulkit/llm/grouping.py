"""Connected groups of linked ids: union-find within each task, then star contraction between tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulkit.llm.shared import materialise

#: Links that a task unites at a time.
LINKS = 1 << 18


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of a task as (u, v) with v the smallest id that u reaches through LINKS of them."""
    def united(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        parent = list(range(len(ids)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        roots = np.array([root(x) for x in range(len(ids))], np.int64)
        child = roots != np.arange(len(ids))
        return pa.RecordBatch.from_arrays([pa.array(ids[child], pa.int64()), pa.array(ids[roots[child]], pa.int64())], ["u", "v"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(a) for a, _ in held) >= LINKS:
            yield united(*map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        yield united(*map(np.concatenate, zip(*held, strict=True)))


def groups(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(id, group) for every id of a link, group being the smallest id it reaches; ids are longs, links without null.

    Every round points ids to the smallest neighbour, from both ends (large and small
    stars); rounds grow with the logarithm of a group's size.  An id with many
    links is the key of sums and joins only, which Spark pre-aggregates or splits.
    """
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v")
    edges = materialise(edges.mapInArrow(forest, "u long, v long").distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        found = edges.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialise(found.select("e.u", "e.v").filter("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every id points to one id, which points to none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("in")),
                                          F.struct(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("in")))).alias("e"))
    counts = ends.groupBy("e.id").agg(F.sum("e.out").alias("outs"), F.sum("e.in").alias("ins"))
    return counts.filter("outs > 1 or outs > 0 and ins > 0").isEmpty()
