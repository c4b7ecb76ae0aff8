"""Mixing sources to target weights with weighted sampling without replacement.

Every document draws an exponential key, -ln(u) / weight, from a uniform number
that its id alone fixes (Efraimidis and Spirakis).  A source whose target is e
whole epochs and a rest takes every document e times, and then documents in key
order until their prefix sum meets the rest.

No source is sorted in one task: keys are counted in 4096 bins, the bin that
holds the rest's edge in 4096 finer ones, and only that finer bin is sorted.  A
source of n documents sorts about n / 16 million of them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulkit.llm.shared import WORD, materialise, text_of

BINS = 4096


def uniform(id_col: str) -> Column:
    """A number in (0, 1) from the first 52 bits of md5(id as text); a null id counts as ''."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, shares: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2) -> DataFrame:
    """(source, source_size) with target: percent of all sizes, shared by weight, at most ``most`` times a source's size.

    Weights repeat over sources by code point, null last.  What a source can't
    take is shared again by weight until none is above its limit.  That is one
    level, the target being min(weight x level, limit): sources fill up in order of
    limit / weight, and the level is the first that fills no further source.
    One row per source passes a single task here, not one per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, shares)), (F.pmod(rank - 1, F.lit(len(shares))) + 1).cast("int")).cast("long")
    s = sizes.withColumn("share", weight).withColumn("limit", F.col("source_size") * most)
    by_fill = Window.orderBy(F.col("limit") / F.col("share"), F.col("source").asc_nulls_last())
    every = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(every) * percent - F.coalesce(F.sum("limit").over(before), F.lit(0)) * 100
    shared = F.sum("share").over(every) - F.coalesce(F.sum("share").over(before), F.lit(0))
    s = s.withColumn("level", rest / (shared * 100))
    fits = F.when(F.col("level") * F.col("share") <= F.col("limit"), F.col("level"))
    s = s.withColumn("level", F.first(fits, ignorenulls=True).over(every))
    target = F.least(F.col("level") * F.col("share"), F.col("limit").cast("double"))
    return s.select("source", "source_size", F.coalesce(target, F.col("limit").cast("double")).alias("target"))


def mix_sources(docs: DataFrame, size: Column, weight: Column, id_col: str = "doc_id", source_col: str = "source",
                shares: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col, source, size, source_size, target, copies, taken, and the columns of ``carry``.

    ``size``, ``weight`` and those of ``carry`` are expressions over ``docs``; a weight that is null or
    not positive counts as the smallest positive one in use, 1e-6.  ``copies`` is the number of
    epochs, and one more where the fractional part takes the document, and taken is copies x
    size.  The fractional part takes documents in key
    order (ties by id) as long as at least half of it fits the rest, so a source
    misses its target by at most half a document.  Null sources are a source; a
    source of size 0 has target 0.  Reruns agree, as keys depend on ids only.
    """
    carry = carry or {}
    clean = F.when(weight > 0, weight).otherwise(F.lit(1e-6))
    key = -F.log(uniform("id")) / F.col("weight")
    place = (1 - F.exp(-key)) * BINS  # grows with the key: from 0 to BINS
    fine = F.floor((place - F.floor(place)) * BINS).cast("int")
    rows = materialise(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                    clean.cast("double").alias("weight"), *(c.alias(n) for n, c in carry.items()))
        .select("id", "source", "size", *carry, key.alias("key"), F.floor(place).cast("int").alias("bin"), fine.alias("fine")), "mix-keys")

    coarse = materialise(rows.groupBy("source", "bin").agg(F.sum("size").alias("size")), "mix-bins")
    targets = source_targets(coarse.groupBy("source").agg(F.sum("size").alias("source_size")), shares, percent, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = materialise(targets.withColumn("epochs", epochs)
                          .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    def edge(bins: DataFrame, name: str, start: Column) -> DataFrame:
        """Per source the bin in which the rest ends, and the words before that bin."""
        w = Window.partitionBy("source").orderBy(name)
        bins = bins.withColumn("before", start + F.sum("size").over(w) - F.col("size"))
        return (bins.filter((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("size")))
                .select(F.col("source").alias("s"), F.col(name).alias(f"edge_{name}"), F.col("before").alias(f"before_{name}")))

    def with_source(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
        return left.join(right, left["source"].eqNullSafe(right["s"]), how).drop("s")

    t = targets.withColumnRenamed("source", "s")
    first = edge(with_source(coarse, t, "inner"), "bin", F.lit(0))
    t = t.join(first.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2")
    inside = with_source(rows, t, "inner").filter("bin = edge_bin")
    finer = inside.groupBy("source", "fine").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before_bin").alias("b"))
    second = edge(finer, "fine", F.col("b"))
    t = materialise(t.join(second.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2"), "mix-edges")

    placed = with_source(rows, t, "inner")
    edged = (F.col("bin") == F.col("edge_bin")) & (F.col("fine") == F.col("edge_fine"))
    before = F.sum("size").over(Window.partitionBy("source").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    sorted_ = (placed.filter(edged).withColumn("before", F.col("before_fine") + before)
               .withColumn("in", 2 * F.col("before") + F.col("size") <= 2 * F.col("rest")).drop("before"))
    below = (F.col("bin") < F.col("edge_bin")) | (F.col("bin") == F.col("edge_bin")) & (F.col("fine") < F.col("edge_fine"))
    others = placed.filter(~F.coalesce(edged, F.lit(False))).withColumn("in", F.coalesce(below, F.lit(False)))
    out = sorted_.unionByName(others)
    copies = (F.col("epochs") + F.when(F.col("in"), 1).otherwise(0)).cast("int")
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).cast("long").alias("taken"), *carry)


def clean_share(size: Column) -> Column:
    """A weight for quality: words over words plus four times the characters of ``#*$%&|<>``; 1 without words."""
    symbols = F.length(text_of()) - F.length(F.translate(text_of(), "#*$%&|<>", ""))
    return F.when(size > 0, size / (size + 4 * symbols)).otherwise(F.lit(1.0))


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` mixed to 150 % of their words, weights 3, 1, 2 by source, at most twice each source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    docs = docs.withColumn("size", F.regexp_count(text_of(), F.lit(WORD)))
    return mix_sources(docs, F.col("size"), clean_share(F.col("size"))).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols,
             (('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
k AS (SELECT *, -ln(u) / (CASE WHEN size > 0 THEN size::DOUBLE / (size + 4 * symbols) ELSE 1.0 END) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY 1),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::BIGINT AS share FROM s),
f AS (SELECT *, 2 * source_size AS lim, sum(source_size) OVER () AS every, sum(share) OVER () AS shares,
        coalesce(sum(2 * source_size) OVER o, 0) AS lim_before, coalesce(sum(share) OVER o, 0) AS share_before,
        row_number() OVER (ORDER BY 2 * source_size::DOUBLE / share, source NULLS LAST) AS nth FROM w
      WINDOW o AS (ORDER BY 2 * source_size::DOUBLE / share, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (every * 150 - lim_before * 100)::DOUBLE / ((shares - share_before) * 100)::DOUBLE AS level FROM f),
t AS (SELECT source, source_size, least(share * (SELECT arg_min(level, nth) FROM l WHERE level * share <= lim), lim::DOUBLE) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
b AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + CASE WHEN 2 * before + size <= 2 * rest THEN size ELSE 0 END)::BIGINT AS taken FROM b
"""
