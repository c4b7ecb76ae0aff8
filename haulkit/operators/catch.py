"""Sampling factors, catch totals, CPUE and zero-filled category tables.

D1-D5, D9-D11, C15-C17, U2.  All aggregation is `groupBy` with map-side partial
aggregation; category labelings are conditional aggregates or a single
`explode`, never a union of two scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import _c, coalesce0, safe_div, strict_sum
from .joins import null_safe_join, null_safe_parts


# --- D1: tossed count per sample group (NULL counts are 0)

def tossed_totals(values: DataFrame, keys: Sequence[str] = ("HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE"),
                  count_col: str = "COUNT", out: str = "TOSSED") -> DataFrame:
    return values.groupBy(*keys).agg(F.sum(coalesce0(count_col)).alias(out))


# --- D2 / W2: sampling factor (KEPT + TOSSED) / KEPT, KEPT = rows per group

def sampling_factor(specimens: DataFrame, keys: Sequence[str], tossed: str = "TOSSED",
                    out: str = "SAMPLING_FACTOR", kept: str | None = None, rows: str | None = None,
                    part: str | None = None) -> DataFrame:
    """Row-level factor.  KEPT comes from a partially aggregated count joined
    back on the (NULL-matching) group keys, so no group is gathered in one task.

    `rows` names a column saying for how many specimens a row stands, when they
    are counted already: a group then has few rows, which a window adds up.  Rows
    joined by `part` and first by these keys (`null_safe_join`) are not sorted again."""
    k = kept or "__KEPT"
    if rows is not None:
        group = [c for key in keys for c in null_safe_parts(specimens, key)]
        j = specimens.withColumn(k, F.sum(rows).over(Window.partitionBy(*([part] if part else []), *group)))
        j = j.withColumn(out, (F.col(k) + F.col(tossed)).cast("double") / F.col(k))
        return j if kept else j.drop(k)
    counts = specimens.groupBy(*keys).agg(F.count(F.lit(1)).alias(k))
    j = null_safe_join(specimens, counts, list(keys), "inner")
    j = j.withColumn(out, (F.col(k) + F.col(tossed)).cast("double") / F.col(k))
    return j if kept else j.drop(k)


# --- D3 / C15: expanded count per unit x species (strict sum, N3)

def expanded_count(specimens: DataFrame, keys: Sequence[str], factor: str = "SAMPLING_FACTOR",
                   out: str = "NUMBER_CRAB") -> DataFrame:
    return specimens.groupBy(*keys).agg(strict_sum(factor).alias(out))


# --- D4: CPUE per unit x class (row-level factors already present)

def cpue(rows: DataFrame, keys: Sequence[str], class_col: str = "MAT_SEX",
         factor: str = "SAMPLING_FACTOR", soak: str = "SOAK_TIME") -> DataFrame:
    return (rows.groupBy(*keys, class_col)
                .agg(strict_sum(factor).alias("COUNT"),
                     strict_sum(safe_div(F.col(factor), F.col(soak))).alias("CATCH_PER_HOUR")))


# --- U2: a row may belong to several labelings (maturity and legal); one pass

def explode_classes(rows: DataFrame, labelings: Sequence[Column], out: str = "MAT_SEX",
                    keep_null_first: bool = True) -> DataFrame:
    """Equivalent of binding two labelled copies of `rows`: the first labeling
    keeps NULL labels (as the reference's `maturity` frame does), later ones
    drop them.  A single scan with `explode`, no union."""
    arr = F.array(*[F.struct(F.lit(i).alias("i"), l.alias("v")) for i, l in enumerate(labelings)])
    e = rows.withColumn("__lab", F.explode(arr))
    cond = F.col("__lab.v").isNotNull()
    if keep_null_first:
        cond = cond | (F.col("__lab.i") == 0)
    return e.where(cond).withColumn(out, F.col("__lab.v")).drop("__lab")


def class_totals(specimens: DataFrame, unit_keys: Sequence[str], sample_keys: Sequence[str],
                 tossed: str, classes: Mapping[str, Column],
                 class_samples: Mapping[str, Mapping[str, object]] | None = None) -> DataFrame:
    """Σ SAMPLING_FACTOR per unit and class in two partial-aggregated stages.

    SAMPLING_FACTOR = (KEPT + TOSSED) / KEPT with KEPT = rows of the sample group
    (unit_keys + sample_keys).  Within a group, Σ SF over the rows of a class is
    n_class + Σ TOSSED_class / KEPT, so stage 1 aggregates per sample group and
    stage 2 per unit; no per-row factor is materialised or shuffled.  A row may
    be in several classes (maturity and legal labelings).  A NULL TOSSED makes
    the class total NULL (R's strict sum).  Output: unit keys + one column per
    class, NULL where the unit has no row of that class.

    `class_samples` (class -> sample-key values all its rows share, e.g.
    "Mature male" -> {SPECIES_CODE: 69322, SEX: 1}) allows one aggregation by
    unit: each class then meets one sample group per unit, whose KEPT is a
    conditional count in the same pass.
    """
    if class_samples is not None:
        return _class_totals_one_pass(specimens, unit_keys, tossed, classes, class_samples)
    g = list(unit_keys) + list(sample_keys)
    t = F.col(tossed)
    s1 = [F.count(F.lit(1)).alias("__kept")]
    for i, flag in enumerate(classes.values()):
        f = F.coalesce(flag, F.lit(False))
        s1 += [F.count_if(f).alias(f"__n{i}"),
               F.sum(F.when(f, t)).alias(f"__t{i}"),
               F.count_if(f & t.isNull()).alias(f"__z{i}")]
    stage1 = specimens.groupBy(*g).agg(*s1)
    s2 = []
    for i, name in enumerate(classes):
        n, ts, z = F.col(f"__n{i}"), F.col(f"__t{i}"), F.col(f"__z{i}")
        contrib = F.when(n > 0, n + F.coalesce(ts, F.lit(0)) / F.col("__kept"))
        s2.append(F.when(F.sum(z) == 0, F.sum(contrib)).alias(name))
    return stage1.groupBy(*unit_keys).agg(*s2)


def _combos(classes, class_samples):
    combos = []
    for name in classes:
        v = tuple(sorted(class_samples[name].items()))
        if v not in combos:
            combos.append(v)
    return combos


def class_partials(specimens: DataFrame, unit_keys: Sequence[str], tossed: str, classes: Mapping[str, Column],
                   class_samples: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Additive per-unit aggregates behind `class_totals` (one-pass form):
    KEPT per sample group and, per class, rows, Σ tossed and NULL-tossed rows.
    Partials of disjoint row sets (e.g. stream micro-batches) sum to the
    partials of their union, so totals can be finished later."""
    t = F.col(tossed)
    aggs = []
    for k, v in enumerate(_combos(classes, class_samples)):
        cond = None
        for col_, val in v:
            e = F.col(col_).isNull() if val is None else (F.col(col_) == F.lit(val))
            cond = e if cond is None else cond & e
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"__k{k}"))
    for i, flag in enumerate(classes.values()):
        f = F.coalesce(flag, F.lit(False))
        aggs += [F.count_if(f).alias(f"__n{i}"), F.sum(F.when(f, t)).alias(f"__t{i}"),
                 F.count_if(f & t.isNull()).alias(f"__z{i}")]
    return specimens.groupBy(*unit_keys).agg(*aggs)


def finish_class_totals(partials: DataFrame, unit_keys: Sequence[str], classes: Mapping[str, Column],
                        class_samples: Mapping[str, Mapping[str, object]], combine: bool = False) -> DataFrame:
    """Totals from `class_partials` (summing partials per unit first when
    `combine`, e.g. over stream batches)."""
    combos = _combos(classes, class_samples)
    if combine:
        cols = [c for c in partials.columns if c.startswith("__")]
        partials = partials.groupBy(*unit_keys).agg(*[F.sum(c).alias(c) for c in cols])
    out = []
    for i, name in enumerate(classes):
        k = combos.index(tuple(sorted(class_samples[name].items())))
        n, ts, z = F.col(f"__n{i}"), F.col(f"__t{i}"), F.col(f"__z{i}")
        val = F.when((z == 0) & (n > 0), n + F.coalesce(ts, F.lit(0)) / F.col(f"__k{k}"))
        out.append(val.alias(name))
    return partials.select(*unit_keys, *out)


def _class_totals_one_pass(specimens, unit_keys, tossed, classes, class_samples):
    return finish_class_totals(class_partials(specimens, unit_keys, tossed, classes, class_samples),
                               unit_keys, classes, class_samples)


def maturity_samples(species_code: int) -> dict[str, dict[str, object]]:
    """Sample-key values of the six maturity/legal classes (see class_totals)."""
    from .. import constants as K
    m = {"SPECIES_CODE": species_code, "SEX": K.MALE}
    f = {"SPECIES_CODE": species_code, "SEX": K.FEMALE}
    return {"Mature male": m, "Immature male": m, "Mature female": f, "Immature female": f,
            "Legal male": m, "Sublegal male": m}


def maturity_flags(species, sex, length, clutch, species_code: int, mature_mm: float,
                   legal_mm: float) -> dict[str, Column]:
    """Six overlapping class memberships (U2): maturity x sex, and legal size."""
    from .. import constants as K
    sp, sx, ln, cl = _c(species), _c(sex), _c(length), _c(clutch)
    rkc = sp == species_code
    male, fem = rkc & (sx == K.MALE), rkc & (sx == K.FEMALE)
    return {"Mature male": male & (ln >= mature_mm), "Immature male": male & (ln < mature_mm),
            "Mature female": fem & (cl >= 1), "Immature female": fem & (cl == 0),
            "Legal male": male & (ln >= legal_mm), "Sublegal male": male & (ln < legal_mm)}


# --- C16 + C17 + B14: zero-fill

def zero_fill(positive: DataFrame, units: DataFrame, keys: Sequence[str], category_col: str,
              categories: Sequence[str], fills: Mapping[str, object]) -> DataFrame:
    """units x categories (a generate, not a cross join) left-joined to the
    positive table on keys + category (NULL matches NULL), then filled."""
    grid = units.withColumn(category_col, F.explode(F.array(*[F.lit(c) for c in categories])))
    payload = [c for c in positive.columns if c not in set(keys) | {category_col}]
    if None not in categories:                # rows of no category match none, so they need not be summed
        positive = positive.where(F.col(category_col).isNotNull())
    j = null_safe_join(grid, positive.select(*keys, category_col, *payload),
                       list(keys) + [category_col], "left")
    return j.fillna(dict(fills)) if fills else j


def zero_fill_wide(units: DataFrame, totals: DataFrame, keys: Sequence[str], category_col: str,
                   categories: Sequence[str], value_col: str = "COUNT") -> DataFrame:
    """Zero-fill from a one-row-per-unit wide total table (see `class_totals`).

    units LEFT JOIN totals on the unit keys (never NULL: a plain equality, so
    the hash partitioning of `totals` by its aggregation serves the join too),
    then one output row per category via `stack`.  `value_col` keeps the raw
    total (NULL when the unit had no row of the class); callers fill it.
    """
    j = units.join(totals, list(keys), "left")
    pairs = ", ".join(f"'{c}', `{c}`" for c in categories)
    carry = [c for c in units.columns]
    return j.selectExpr(*[f"`{c}`" for c in carry],
                        f"stack({len(categories)}, {pairs}) AS (`{category_col}`, `{value_col}`)")


# --- D5: basket weight per sample x sex x species (strict)

def basket_weight(samples: DataFrame, keys: Sequence[str], weight: str = "WEIGHT") -> DataFrame:
    return samples.groupBy(*keys).agg(strict_sum(weight).alias(weight))


# --- D10: station total over listed categories

def station_total(rows: DataFrame, keys: Sequence[str], category_col: str, categories: Sequence[str],
                  value: str = "COUNT") -> DataFrame:
    return (rows.where(F.col(category_col).isin(list(categories)))
                .groupBy(*keys).agg(strict_sum(value).alias(value)))


# --- D11: counts per station and category

def category_counts(rows: DataFrame, keys: Sequence[str], category_col: str,
                    factor: str = "SAMPLING_FACTOR", out: str = "COUNT") -> DataFrame:
    return rows.groupBy(*keys, category_col).agg(strict_sum(factor).alias(out))


# --- C15 / Q23: estimated counts against the reported catch

def reconcile_catch(estimated: DataFrame, reported: DataFrame, keys: Sequence[str],
                    est_col: str = "NUMBER_CRAB", rep_col: str = "N_ENTRIES") -> DataFrame:
    """Reported catch rows (all their columns) with the expanded count: right
    join on NULL-matching keys, incomplete rows dropped as the reference's
    `na.omit`, plus a mismatch flag (Q23)."""
    j = null_safe_join(estimated.select(*keys, est_col), reported, list(keys), "right")
    j = j.dropna(how="any")
    return j.withColumn("MISMATCH", F.col(est_col) != F.col(rep_col))
