"""Groundfish: flatfish expansion (W1), estimated counts (D6/D7), station
totals (D8), species fixes (B18), expansion (H15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions.nulls import is_in, not_in, require, safe_div, strict_sum
from .joins import with_group_stats


def clean_fish(samples: DataFrame, names: DataFrame, species_col: str = "SPECIES_CODE",
               required: Sequence[str] = ("STATION", "SPECIES_CODE")) -> DataFrame:
    """Crab removed keeping NULL codes (B8), species names attached from a
    lookup (C21; AQE broadcasts it where it is small), variant merged into its parent (B18),
    rows without station or species dropped (B9)."""
    s = samples.where(not_in(species_col, K.CRAB_CODES))
    s = s.join(names, species_col, "left")
    s = s.withColumns({"SPECIES_NAME": S.merge_species_name("SPECIES_NAME"),
                       species_col: S.merge_species_code(species_col)})
    return require(s, list(required))


def _subset_sum(flag, value):
    """R's sum(x[flag]) for a non-NULL flag: 0 for an empty subset, NULL if a
    selected value is NULL."""
    f = F.coalesce(flag, F.lit(False))
    return F.when(F.count_if(f & F.col(value).isNull()) == 0,
                  F.coalesce(F.sum(F.when(f, F.col(value))), F.lit(0.0)))


def flatfish_expand(samples: DataFrame, by: Sequence[str] = ("STATION",), weight: str = "SAMPLE_VALUE_WEIGHT",
                    flatfish_codes: Sequence[int] = K.FLATFISH_CODES,
                    unid_name: str = K.UNID_FLATFISH_NAME, unid_code: int = K.UNID_FLATFISH_CODE) -> DataFrame:
    """Per station, identified (I) and unidentified (U) flatfish weight;
    factor (I + U) / I for flatfish, 1 otherwise; the unidentified bin dropped.

    The per-station sums are a partially aggregated groupBy joined back (one
    row per station), not a window, so a station holding most rows does not
    land in a single task."""
    flat = is_in("SPECIES_CODE", flatfish_codes)
    unid = F.col("SPECIES_NAME") == unid_name
    s = with_group_stats(samples, list(by), _subset_sum(flat, weight).alias("__I"),
                         _subset_sum(unid, weight).alias("__U"))
    sf = F.when(~flat, F.lit(1.0)).otherwise(safe_div(F.col("__I") + F.col("__U"), F.col("__I")))
    s = s.withColumn("SAMPLING_FACTOR", sf).drop("__I", "__U")
    return s.where(~(F.col("SPECIES_CODE") == unid_code))


def flatfish_expand_summed(samples: DataFrame, summed: DataFrame, by: Sequence[str] = ("STATION",),
                           weight: str = "SAMPLE_VALUE_WEIGHT", nulls: str = "N_NULL",
                           flatfish_codes: Sequence[int] = K.FLATFISH_CODES,
                           unid_name: str = K.UNID_FLATFISH_NAME, unid_code: int = K.UNID_FLATFISH_CODE) -> DataFrame:
    """`flatfish_expand` where the weights come summed beforehand: `summed` has, per
    station and anything finer, SPECIES_CODE, SPECIES_NAME, the sum of weights and the
    number of NULL ones, so the species of the rows is looked up once for them and
    once for the (smaller) sums."""
    def subset(flag):
        f = F.coalesce(flag, F.lit(False))
        return F.when(F.sum(F.when(f, F.col(nulls)).otherwise(0)) == 0,
                      F.coalesce(F.sum(F.when(f, F.col(weight))), F.lit(0.0)))

    flat = is_in("SPECIES_CODE", flatfish_codes)
    sums = summed.groupBy(*by).agg(subset(flat).alias("__I"), subset(F.col("SPECIES_NAME") == unid_name).alias("__U"))
    s = samples.join(sums, list(by), "left")
    sf = F.when(~flat, F.lit(1.0)).otherwise(safe_div(F.col("__I") + F.col("__U"), F.col("__I")))
    s = s.withColumn("SAMPLING_FACTOR", sf).drop("__I", "__U")
    return s.where(~(F.col("SPECIES_CODE") == unid_code))


def estimate_counts(rows: DataFrame, keys: Sequence[str], weight: str = "SAMPLE_VALUE_WEIGHT",
                    count: str = "SAMPLE_VALUE_COUNT", factor: str = "SAMPLING_FACTOR", tasks: int | None = None) -> DataFrame:
    """D6 + D7 + H15 in one aggregation.

    Individual weight = mean of the distinct non-NULL weight/count values of
    the group (NULL when none; x/0 gives NULL, N9).  Every row's estimated
    count is weight / that constant, so Σ count = Σ weight / individual weight
    and the per-row count never needs a join-back.  Sums are strict (N3).
    Expanded weight and count multiply by the group's sampling factor.

    Most sample groups are a row or two, so the tables of groups that a task
    holds are as long as its rows: `tasks` deals the rows by group to so many.
    """
    r = rows.withColumn("__iw", safe_div(F.col(weight), F.col(count)))
    r = r.repartition(tasks, *keys) if tasks else r
    g = r.groupBy(*keys).agg(F.expr("avg(DISTINCT __iw)").alias("IND_WEIGHT"),
                             strict_sum(weight).alias("WEIGHT"))
    g = g.withColumn("COUNT", safe_div(F.col("WEIGHT"), F.col("IND_WEIGHT")))
    return g.withColumns({"CALC_WEIGHT": F.col("WEIGHT") * F.col(factor),
                          "CALC_COUNT": F.col("COUNT") * F.col(factor)})


def station_totals(catch: DataFrame, keys: Sequence[str] = ("STATION",), name_col: str = "SPECIES_NAME",
                   excluded: Sequence[str] = K.NON_FISH_NAMES) -> DataFrame:
    """D8 + H9: expanded weight and count per station x bycatch label."""
    c = catch.where(not_in(name_col, excluded)).withColumn("SPP_LABS", S.fish_label(name_col))
    return c.groupBy(*keys, "SPP_LABS").agg(strict_sum("CALC_WEIGHT").alias("WEIGHT"),
                                            strict_sum("CALC_COUNT").alias("COUNT"))


def station_label_weights(catch: DataFrame, keys: Sequence[str] = ("STATION",), name_col: str = "SPECIES_NAME",
                          labels: Sequence[str] = K.FISH_BYCATCH_COLUMNS,
                          excluded: Sequence[str] = K.NON_FISH_NAMES) -> DataFrame:
    """D8 + D15 in one pass: one row per station, one strict weight sum per
    label column (the wide bycatch sheet before zero-fill)."""
    c = catch.where(not_in(name_col, excluded)).withColumn("__lab", S.fish_label(name_col))
    aggs = []
    for lab in labels:
        hit = F.col("__lab") == lab
        aggs.append(F.when(F.count_if(hit & F.col("CALC_WEIGHT").isNull()) == 0,
                           F.sum(F.when(hit, F.col("CALC_WEIGHT")))).alias(lab))
    return c.groupBy(*keys).agg(*aggs)


