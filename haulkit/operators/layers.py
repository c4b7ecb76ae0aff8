"""Tables under the maps: one long layer table (K1), per-layer scales (K2,
D17, H10, H11, H18), species / category layers as groups (K3-K6), survey
comparison on a joint scale (K7, D18).  Drawing is out of scope; each figure
is a `where` on these tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from .spatial import project


def map_layer(parts: Sequence[DataFrame], value_col: str = "COUNT", category_col: str = "CATEGORY",
              unit: str | None = None, pot_vessels: Sequence[str] = K.POT_VESSELS,
              trawl_vessels: Sequence[str] = K.TRAWL_VESSELS) -> DataFrame:
    """K1: union by name of per-gear layer frames (VESSEL, STATION, LAT_DD,
    LON_DD, category, value), projected, with gear (B21), zero flag (H12) and
    legend unit (H18: by taxon, or fixed `unit` for crab CPUE layers).  Surveys
    have vessels of their own: pass their names, or the gear is NULL."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = project(u)
    return u.withColumns({"GEAR": S.gear_of("VESSEL", pot_vessels, trawl_vessels), "IS_ZERO": S.is_zero(value_col),
                          "UNIT": F.lit(unit) if unit else S.measure_of(category_col),
                          "LABEL": display_label(category_col)})


def display_label(category, labels: Mapping[str, str] | None = None):
    """Display name of a layer category (maturity classes and
    bycatch species); a literal map lookup, no join.  Unknown -> the category."""
    from itertools import chain
    labels = labels if labels is not None else {**K.MAT_LABELS, **K.BYCATCH_LABELS}
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    c = F.col(category) if isinstance(category, str) else category
    return F.coalesce(m[c], c)


def scale_limits(layer: DataFrame, by: Sequence[str] = ("GEAR", "CATEGORY"), value_col: str = "VALUE",
                 round_to: float = K.SCALE_ROUND_TO, n_breaks: int = K.SCALE_N_BREAKS,
                 override: DataFrame | None = None) -> DataFrame:
    """Per layer the legend limit (max rounded up strictly to the
    next multiple) and its equal breaks, one row per break.  `override`
    (by + SCALE_LIMIT) replaces computed limits, as older figures fixed them."""
    lim = layer.groupBy(*by).agg(F.max(value_col).alias("MAXV"))
    lim = lim.withColumn("SCALE_LIMIT", S.round_up("MAXV", round_to))
    if override is not None:
        o = override.select(*by, F.col("SCALE_LIMIT").alias("__o"))
        lim = lim.join(o, list(by), "left").withColumn("SCALE_LIMIT", F.coalesce("__o", "SCALE_LIMIT")).drop("__o")
    return lim.select(*by, "SCALE_LIMIT",
                      F.posexplode(S.breaks("SCALE_LIMIT", n_breaks)).alias("BREAK_NO", "BREAK_VALUE"))


def joint_range(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """Min and max of `col` over several surveys' tables (one row)."""
    u = frames[0].select(col)
    for f in frames[1:]:
        u = u.unionByName(f.select(col))
    return u.agg(F.min(col).alias("MIN"), F.max(col).alias("MAX"))


def compare_surveys(a: DataFrame, b: DataFrame, survey_a: str, survey_b: str, value_col: str,
                    round_to: float = K.SCALE_ROUND_TO) -> DataFrame:
    """K7: two surveys' layer rows tagged by survey, with the joint legend
    limit as a column.  The limit is a one-row table joined to the rows by a
    constant key, so nothing runs before the result is read."""
    u = a.withColumn("SURVEY", F.lit(survey_a)).unionByName(b.withColumn("SURVEY", F.lit(survey_b)))
    lim = joint_range([a, b], value_col).select(
        F.lit(1).alias("__one"), S.round_up(F.col("MAX").cast("double"), round_to).alias("SCALE_LIMIT"))
    # one row, whatever the input
    return u.withColumn("__one", F.lit(1)).join(F.broadcast(lim), "__one", "left").drop("__one")
