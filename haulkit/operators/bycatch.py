"""Bycatch tables: crab bycatch by species x sex (D9), zero-filled wide sheets
(C16/C17 + D15), species totals from sexes (D16), pot sheet positions (C18),
trawl fish + crab merge (C24)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions.nulls import not_in
from .joins import null_safe_join


def crab_bycatch_wide(specimens: DataFrame, keys: Sequence[str], factor: str = "SAMPLING_FACTOR",
                      categories: Sequence[str] = K.SPP_SEX_CATEGORIES,
                      exclude_species: Sequence[int] = (K.RED_KING_CRAB,)) -> DataFrame:
    """D9 as one conditional aggregation: Σ factor per unit and species x sex
    label (H8); the target species is excluded keeping NULL codes (N4).  One
    column per category, NULL where the unit had none of it."""
    s = specimens.where(not_in("SPECIES_CODE", exclude_species))
    lab = S.bycatch_label("SPECIES_CODE", "SEX")
    s = s.withColumn("__lab", lab)
    aggs = []
    for c in categories:
        hit = F.col("__lab") == c
        aggs.append(F.when(F.count_if(hit & F.col(factor).isNull()) == 0,
                           F.sum(F.when(hit, F.col(factor)))).alias(c))
    return s.groupBy(*keys).agg(*aggs)


def zero_filled_sheet(units: DataFrame, wide: DataFrame, keys: Sequence[str], columns: Sequence[str],
                      fill: float = 0.0) -> DataFrame:
    """C16 + C17 + D15 for a wide sheet: every unit, every listed column,
    missing cells filled.  A left join keyed by unit; no category grid."""
    j = null_safe_join(units, wide, list(keys), "left")
    return j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fill)) for c in columns})


def add_species_totals(df: DataFrame, sums: Mapping[str, Sequence[str]] = K.SEX_SUMS) -> DataFrame:
    """Species totals from sex columns (NULL if a part is NULL, as R's +)."""
    return df.withColumns({name: F.col(a) + F.col(b) for name, (a, b) in sums.items()})


def sheet_positions(sheet: DataFrame, lifts: DataFrame, keys: Sequence[str] = ("VESSEL", "SPN")) -> DataFrame:
    """C18 + B12: lift positions onto the bycatch sheet (right join on the
    sheet), special-project pots without a position dropped."""
    j = null_safe_join(lifts, sheet, list(keys), "right")
    return j.where(F.col("LON_DD").isNotNull())


def merge_trawl_bycatch(fish: DataFrame, crab: DataFrame,
                        keys: Sequence[str] = ("VESSEL", "STATION", "LAT_DD", "LON_DD")) -> DataFrame:
    """Trawl fish bycatch left-joined to trawl crab bycatch."""
    return null_safe_join(fish, crab, list(keys), "left")
