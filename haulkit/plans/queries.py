"""Registered queries: one per operator group of the survey inventory.

Each takes (spark, sf_dir) and returns a lazy DataFrame over the whole tables.
Column names match the SQL in `oracle.py` exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import fix
from ..operators import catch as C
from ..session import tasks_for
from . import bindings as B


def zero_filled_catch(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: pot catch per lift x maturity/legal class, zero-filled.

    H5 H6 U2 D2 D4 C16 C17 B14 H13: sampling factor per (lift, species, sex)
    sample, six overlapping classes, Σ factor and Σ factor / soak per lift,
    every lift x class present (COUNT 0, rate NULL where nothing was caught).
    """
    sp = B.specimens(spark, d)
    totals = C.class_totals(sp, ["SPN"], ["SPECIES_CODE", "SEX"], "TOSSED", _mat_flags(),
                            C.maturity_samples(K.RED_KING_CRAB))
    return _catch_table(spark, d, totals)


def _mat_flags():
    return C.maturity_flags("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE",
                            K.RED_KING_CRAB, K.MATURE_MALE_MM, K.LEGAL_MALE_MM)


def _catch_table(spark: SparkSession, d: str, totals: DataFrame, where=None) -> DataFrame:
    """Zero-filled lift x class table from one-row-per-lift class totals."""
    lifts = B.lifts(spark, d, where=where)
    long = C.zero_fill_wide(lifts, totals, ["SPN"], "MAT_SEX", K.MAT_SEX_CATEGORIES, "__pos")
    pos = fix("__pos", 4)
    return long.select(
        "VESSEL", "SPN", "POT_ID", "BUOY", "LAT_DD", "LON_DD", "DATE_SET", "TIME_SET",
        "DATE_HAUL", "TIME_HAUL", fix("SOAK_TIME", 4).alias("SOAK_TIME"), "MAT_SEX",
        F.coalesce(pos, F.lit(0.0)).alias("COUNT"),
        fix(F.try_divide(pos, F.col("SOAK_TIME")), 4).alias("CATCH_PER_HOUR"),
    )


QUERIES = {
    "zero_filled_catch": zero_filled_catch,
}


def sampling_factor(spark: SparkSession, d: str) -> DataFrame:
    """Row-level factor (KEPT + TOSSED) / KEPT per (lift, species, sex)."""
    sp = B.specimens(spark, d)
    out = C.sampling_factor(sp, ["SPN", "SPECIES_CODE", "SEX"], "TOSSED", kept="KEPT")
    return out.select("SPN", "SPECIMEN_ID", "PART", "SPECIES_CODE", "SEX", "TOSSED", "KEPT",
                      fix("SAMPLING_FACTOR", 6).alias("SAMPLING_FACTOR"))


def tossed_totals(spark: SparkSession, d: str) -> DataFrame:
    """Tossed count per haul x sample x device; NULL counts are 0."""
    li = B.table(spark, d, "lineitem")
    ln = F.col("l_linenumber")
    vals = li.select(F.col("l_orderkey").alias("HAUL_ID"),
                     (F.col("l_suppkey") % 10).alias("CATCH_SAMPLE_ID"),
                     F.col("l_linestatus").alias("RECORDING_DEVICE"),
                     F.when(ln != 1, ln - 1).alias("COUNT"))
    return C.tossed_totals(vals).withColumn("TOSSED", F.col("TOSSED").cast("bigint"))


def expanded_catch_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Expanded crab count per lift x species against the reported
    entries (right join, incomplete rows dropped, mismatch flag)."""
    sp = B.specimens(spark, d)
    est = C.class_totals(sp, ["SPN", "SPECIES_CODE"], ["SEX"], "TOSSED", {"NUMBER_CRAB": F.lit(True)})
    est = est.withColumn("NUMBER_CRAB", fix("NUMBER_CRAB", 4))
    rep = (sp.where(F.col("LINESTATUS") == "O").groupBy("SPN", "SPECIES_CODE")
             .agg(F.count(F.lit(1)).alias("N_ENTRIES")))
    rep = rep.join(B.lift_ids(spark, d).select("SPN", "VESSEL", "POT_ID"), "SPN", "left")
    out = C.reconcile_catch(est, rep, ["SPN", "SPECIES_CODE"])
    return out.select("SPN", "SPECIES_CODE", "NUMBER_CRAB", "N_ENTRIES", "VESSEL", "POT_ID", "MISMATCH")


def strict_sum(spark: SparkSession, d: str) -> DataFrame:
    """R-style aggregates (any NULL input -> NULL) next to SQL's."""
    from ..functions import nulls as N
    li = B.table(spark, d, "lineitem")
    x = F.nullif(F.col("l_tax"), F.lit(0.0))
    g = li.select(F.col("l_orderkey").alias("SPN"), x.alias("X")).groupBy("SPN")
    return g.agg(F.count(F.lit(1)).alias("N"), F.count_if(F.col("X").isNull()).alias("N_NULL"),
                 fix(N.strict_sum("X"), 4).alias("STRICT_SUM"), fix(F.sum("X"), 4).alias("LENIENT_SUM"),
                 N.strict_min("X").alias("STRICT_MIN"), N.strict_max("X").alias("STRICT_MAX"),
                 fix(N.strict_avg("X"), 6).alias("STRICT_AVG"))


def null_safe_left(spark: SparkSession, d: str) -> DataFrame:
    """Left join where a NULL key matches a NULL key."""
    from ..operators.joins import null_safe_join
    o = B.table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("CUSTKEY"))
    c = B.table(spark, d, "customer").select(
        F.nullif(F.col("c_custkey"), F.lit(0)).alias("CUSTKEY"), "c_name", "c_mktsegment")
    return null_safe_join(o, c, ["CUSTKEY"], "left")


def not_in_keep_null(spark: SparkSession, d: str) -> DataFrame:
    """NOT IN that keeps rows whose value is NULL."""
    from ..functions.nulls import not_in
    p = B.table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("NAME"), "p_type")
    return p.where(not_in("NAME", ["red plate", "small widget", "hot ring"]))


def _gear(note) -> F.Column:
    h = F.substring(F.col(note), 1, 1)
    return (F.when(h == "1", "44").when(h == "2", "42").when(h == "3", F.lit(None).cast("string"))
             .when(h == "4", "").otherwise("7"))


def valid_units(spark: SparkSession, d: str) -> DataFrame:
    """Incomplete lifts, one excluded lift, gear filter with
    the second sheet's recode, camera/bait pots dropped."""
    from ..operators import lifts as L
    r = B.raw_lifts(spark, d)
    spn = F.col("SPN")
    r = r.select("SPN", "VESSEL_CODE", "POT_ID",
                 F.when(spn % 17 == 0, F.lit("")).otherwise(F.col("DATE_HAUL")).alias("DATE_HAUL"),
                 F.when(spn % 13 != 0, F.col("TIME_HAUL")).alias("TIME_HAUL"),
                 _gear("GEAR_NOTE").alias("GEAR_CODE"))
    r = L.recode_gear(r, "GEAR_CODE", "42", where=(spn % 2 == 1))
    r = L.valid_lifts(r, "TIME_HAUL", "DATE_HAUL", exclude={"SPN": 215})
    r = L.gear_filter(r, "GEAR_CODE", "VESSEL_CODE", ("44",))
    r = L.regular_stations(r, "POT_ID")
    from ..functions.scalar import hhmm
    return r.select("SPN", "VESSEL_CODE", "POT_ID", "GEAR_CODE", "DATE_HAUL",
                    hhmm("TIME_HAUL").alias("TIME_HAUL"))


def soak_hours(spark: SparkSession, d: str) -> DataFrame:
    """Soak hours in the survey's zone and as naive wall clock."""
    from ..functions import scalar as S
    r = B.raw_lifts(spark, d)
    t_set, t_haul = S.hhmm("TIME_SET"), S.hhmm("TIME_HAUL")
    local = S.soak_hours(S.lift_ts("DATE_SET", t_set, B.TZ), S.lift_ts("DATE_HAUL", t_haul, B.TZ))
    wall = S.soak_hours(S.lift_ts("DATE_SET", t_set, "UTC"), S.lift_ts("DATE_HAUL", t_haul, "UTC"))
    return r.select("SPN", "DATE_SET", t_set.alias("TIME_SET"), "DATE_HAUL", t_haul.alias("TIME_HAUL"),
                    fix(S.dm_to_dd("LAT_DEG", "LAT_MIN"), 6).alias("LAT_DD"),
                    fix(S.dm_to_dd("LON_DEG", "LON_MIN", -1.0), 6).alias("LON_DD"),
                    fix(local, 4).alias("SOAK_TIME"), fix(wall, 4).alias("SOAK_WALL"))


def hhmm_times(spark: SparkSession, d: str) -> DataFrame:
    """H1: HHMM with lost leading zeros -> 'HH:MM', invalid -> NULL."""
    from ..functions.scalar import hhmm
    e = B.table(spark, d, "events")
    raw = F.when(F.col("event_id") % 11 != 0,
                 (F.floor(F.col("value") * 10).cast("bigint") % 2500).cast("int"))
    return e.select(F.col("event_id").alias("EVENT_ID"), raw.alias("RAW"), hhmm(raw).alias("HHMM"))


BIOMETRIC_NAMES = ["click", "error", "purchase", "signup", "view"]


def biometrics_wide(spark: SparkSession, d: str) -> DataFrame:
    """Long (id, name, value) -> wide; duplicated cells NULL + counted."""
    from ..operators.specimens import widen
    e = B.table(spark, d, "events").select(F.col("user_id").alias("USER_ID"),
                                           F.to_date("ts").alias("DAY"), "event_type", "value")
    return widen(e, ["USER_ID", "DAY"], "event_type", "value", BIOMETRIC_NAMES)


QUERIES.update({
    "sampling_factor": sampling_factor,
    "tossed_totals": tossed_totals,
    "expanded_catch_reconcile": expanded_catch_reconcile,
    "strict_sum": strict_sum,
    "null_safe_left": null_safe_left,
    "not_in_keep_null": not_in_keep_null,
    "valid_units": valid_units,
    "soak_hours": soak_hours,
    "hhmm": hhmm_times,
    "biometrics_wide": biometrics_wide,
})


# ---------------------------------------------------------------- specimen joins

def specimen_join_out(spark: SparkSession, d: str) -> DataFrame:
    """Specimens with species names and lift attributes
    (right join onto the specimens, NULL-matching keys), rows with no position
    and no lift id dropped."""
    from ..functions.nulls import require_any
    from ..operators.joins import null_safe_join
    sp = B.specimens(spark, d)
    parts = B.table(spark, d, "part").select(F.col("p_partkey").alias("PART"), F.col("p_type").alias("SPECIES_NAME"))
    j = null_safe_join(sp, parts, ["PART"], "left")
    lifts = B.lifts(spark, d).select("SPN", "VESSEL", "POT_ID", "LAT_DD", "LON_DD")
    j = null_safe_join(lifts, j, ["SPN"], "right")
    j = require_any(j, ["LAT_DD", "LON_DD", "SPN"])
    return j.select("SPN", "SPECIMEN_ID", "VESSEL", "POT_ID", "LAT_DD", "LON_DD", "SPECIES_CODE",
                    "SPECIES_NAME", "SEX", "LENGTH")


def basket_weight(spark: SparkSession, d: str) -> DataFrame:
    """Strict basket weight per sample x species x sex, joined to the
    distinct sample attributes."""
    from ..operators.joins import null_safe_join
    sp = B.specimens(spark, d)
    w = F.when((F.col("SPN") % 211 == 0) & (F.col("SPECIMEN_ID") == 2), F.lit(None).cast("double")) \
         .otherwise(F.col("WEIGHT"))
    sp = sp.withColumn("WEIGHT", w)
    keys = ["SPN", "SPECIES_CODE", "SEX"]
    tot = C.basket_weight(sp, keys, "WEIGHT").withColumn("WEIGHT", fix("WEIGHT", 2))
    attrs = sp.select(*keys, "LINESTATUS").distinct()
    return null_safe_join(tot, attrs, keys, "left").select(*keys, "LINESTATUS", "WEIGHT")


# ---------------------------------------------------------------- groundfish

def _fish(spark, d):
    """Row-level flatfish expansion: weights are summed per station and species,
    so the sums that every task holds are few."""
    from ..operators import fish as FI
    samples = FI.clean_fish(B.fish_samples(spark, d), F.broadcast(B.fish_names(spark)))
    w = F.col("SAMPLE_VALUE_WEIGHT")
    summed = samples.groupBy("STATION", "SPECIES_CODE", "SPECIES_NAME").agg(
        F.sum(w).alias("SAMPLE_VALUE_WEIGHT"), F.count_if(w.isNull()).alias("N_NULL"))
    return FI.flatfish_expand_summed(samples, summed)


def flatfish_expand(spark: SparkSession, d: str) -> DataFrame:
    """Flatfish factor per station, expanded weight."""
    f = _fish(spark, d)
    return f.select("STATION", "CATCH_SAMPLE_ID", "SAMPLE_VALUE_ID", "SPECIES_CODE", "SPECIES_NAME",
                    "SAMPLE_VALUE_WEIGHT", fix("SAMPLING_FACTOR", 6).alias("SAMPLING_FACTOR"),
                    fix(F.col("SAMPLE_VALUE_WEIGHT") * F.col("SAMPLING_FACTOR"), 6).alias("CALC_WEIGHT"))


FISH_KEYS = ["STATION", "CATCH_SAMPLE_ID", "SPECIES_CODE", "SPECIES_NAME", "SAMPLING_FACTOR"]


def _fish_catch(spark, d):
    """Sample x species catch: per-station flatfish factor (a small aggregate
    joined back), then one aggregation per sample group, in as many tasks as
    the rows ask for."""
    from ..operators import fish as FI
    return FI.estimate_counts(_fish(spark, d), FISH_KEYS, tasks=tasks_for(B.table(spark, d, "lineitem")))


def estimate_counts(spark: SparkSession, d: str) -> DataFrame:
    """Individual weight from distinct basket weights/counts,
    estimated counts, expanded weight and count per sample x species."""
    e = _fish_catch(spark, d)
    return e.select("STATION", "CATCH_SAMPLE_ID", "SPECIES_CODE", "SPECIES_NAME",
                    fix("SAMPLING_FACTOR", 6).alias("SAMPLING_FACTOR"), fix("IND_WEIGHT", 6).alias("IND_WEIGHT"),
                    fix("WEIGHT", 6).alias("WEIGHT"), fix("COUNT", 4).alias("COUNT"),
                    fix("CALC_WEIGHT", 6).alias("CALC_WEIGHT"), fix("CALC_COUNT", 4).alias("CALC_COUNT"))


def station_species_weights(spark: SparkSession, d: str) -> DataFrame:
    """Expanded fish weight per station and bycatch label,
    every sampled station and label present (0 where none)."""
    from ..operators import bycatch as BY
    from ..operators import fish as FI
    wide = FI.station_label_weights(_fish_catch(spark, d), ["STATION"])
    st = B.stations(spark, d).drop("TEMP")
    sheet = BY.zero_filled_sheet(st, wide, ["STATION"], K.FISH_BYCATCH_COLUMNS)
    return sheet.select("STATION", "LAT_DD", "LON_DD", *[fix(c, 6).alias(c) for c in K.FISH_BYCATCH_COLUMNS])


# ---------------------------------------------------------------- crab bycatch / station layers

def _trawl_specimens(spark, d):
    return B.specimens(spark, d).withColumns({"STATION": F.col("STATION_KEY"),
                                              "SAMPLING_FACTOR": F.lit(1.0)})


def _crab_sheet(units, unit_keys, sp):
    from ..operators import bycatch as BY
    wide = BY.crab_bycatch_wide(sp, unit_keys)
    sheet = BY.zero_filled_sheet(units, wide, unit_keys, K.SPP_SEX_CATEGORIES)
    return BY.add_species_totals(sheet)


def crab_bycatch(spark: SparkSession, d: str) -> DataFrame:
    """Trawl crab bycatch per station, 7 species x
    sex columns zero-filled, species totals."""
    st = B.stations(spark, d).drop("TEMP")
    sheet = _crab_sheet(st, ["STATION"], _trawl_specimens(spark, d))
    return sheet.select("STATION", "LAT_DD", "LON_DD", *K.SPP_SEX_CATEGORIES, *K.SEX_SUMS)


def _station_classes(spark, d, flags, category_col):
    st = B.stations(spark, d).drop("TEMP")
    sp = _trawl_specimens(spark, d).withColumn("__zero", F.lit(0))
    totals = C.class_totals(sp, ["STATION"], [], "__zero", flags)
    return C.zero_fill_wide(st, totals, ["STATION"], category_col, list(flags), "__pos")


def station_total(spark: SparkSession, d: str) -> DataFrame:
    """Trawl CPUE per station x maturity class, zero-filled, then
    the station total over the four maturity classes."""
    flags = C.maturity_flags("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE",
                             K.RED_KING_CRAB, K.MATURE_MALE_MM, K.LEGAL_MALE_MM)
    long = _station_classes(spark, d, flags, "MAT_SEX").withColumn("COUNT", F.coalesce("__pos", F.lit(0.0)))
    tot = C.station_total(long, ["STATION", "LAT_DD", "LON_DD"], "MAT_SEX", K.MATURITY_TOTAL_CATEGORIES)
    return tot.select("STATION", "LAT_DD", "LON_DD", fix("COUNT", 4).alias("COUNT"))


def shell_counts(spark: SparkSession, d: str) -> DataFrame:
    """Mature crab per station x sex x shell condition 1-3, zero-filled."""
    from .. import constants as KK
    from ..functions import scalar as S
    sp = _trawl_specimens(spark, d).withColumn("MAT_SEX_SC", S.shell_class("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE",
                                                                          "SHELL_CONDITION"))
    positive = C.category_counts(sp.where(F.col("MAT_SEX_SC").isNotNull()), ["STATION"], "MAT_SEX_SC")
    st = B.stations(spark, d).drop("TEMP")
    long = C.zero_fill(positive, st, ["STATION"], "MAT_SEX_SC", KK.SHELL_CATEGORIES, {"COUNT": 0.0})
    return long.select("STATION", "LAT_DD", "LON_DD", "MAT_SEX_SC", fix("COUNT", 4).alias("COUNT"))


def _species_long(spark, d):
    from ..functions.scalar import gear_of
    from ..operators.specimens import lengthen
    sp = B.specimens(spark, d).withColumn("SAMPLING_FACTOR", F.lit(1.0))
    lifts = B.lifts(spark, d).select("SPN", "VESSEL")
    pot = _crab_sheet(lifts, ["SPN"], sp).select(gear_of("VESSEL").alias("GEAR"), F.col("SPN").alias("UNIT"),
                                                 *K.SPP_SEX_CATEGORIES)
    st = B.stations(spark, d).select("STATION", F.lit("Vesteraalen").alias("VESSEL"))
    trawl = _crab_sheet(st, ["STATION"], _trawl_specimens(spark, d)).select(
        gear_of("VESSEL").alias("GEAR"), F.col("STATION").alias("UNIT"), *K.SPP_SEX_CATEGORIES)
    both = pot.unionByName(trawl)
    return lengthen(both, ["GEAR", "UNIT"], K.SPP_SEX_CATEGORIES, "SPECIES", "VALUE")


def species_long(spark: SparkSession, d: str) -> DataFrame:
    """Pot (per lift) and trawl (per station) crab bycatch sheets,
    unioned by name with a gear class, wide -> long."""
    return _species_long(spark, d)


def layer_scales(spark: SparkSession, d: str) -> DataFrame:
    """Per gear x species legend limit (max rounded up to the
    next multiple of 5) and its five equal breaks, one row per break."""
    from ..functions import scalar as S
    from ..operators.layers import scale_limits
    out = scale_limits(_species_long(spark, d).where(F.col("GEAR").isNotNull()), ("GEAR", "SPECIES"))
    return out.select("GEAR", "SPECIES", S.measure_of("SPECIES").alias("UNIT"), "SCALE_LIMIT", "BREAK_NO",
                      fix("BREAK_VALUE", 4).alias("BREAK_VALUE"))


def survey_range(spark: SparkSession, d: str) -> DataFrame:
    """Every survey's surface on one scale (a survey is a year):
    per-survey and joint min/max (ROLLUP: one pass)."""
    o = B.table(spark, d, "orders").select(F.year("o_orderdate").cast("string").alias("SURVEY"),
                                           (F.col("o_totalprice") / 100000.0).alias("T"))
    r = o.rollup("SURVEY").agg(F.min("T").alias("T_MIN"), F.max("T").alias("T_MAX"),
                                              F.count(F.lit(1)).alias("N"), F.grouping("SURVEY").alias("__g"))
    return r.select(F.when(F.col("__g") == 1, "ALL").otherwise(F.col("SURVEY")).alias("SURVEY"),
                    "T_MIN", "T_MAX", "N")


# ---------------------------------------------------------------- data quality

def _specimen_table(spark, d):
    """Specimens with row-level sampling factor and vessel (the reference's
    specimen product)."""
    sp = C.sampling_factor(B.specimens(spark, d), ["SPN", "SPECIES_CODE", "SEX"], "TOSSED")
    return sp.join(B.lift_ids(spark, d).select("SPN", "VESSEL"), "SPN", "left")


def inventory(spark: SparkSession, d: str) -> DataFrame:
    """Four inventories (Σ factor, rows) in one GROUPING SETS pass."""
    from ..operators.quality import inventories
    inv = inventories(_specimen_table(spark, d))
    return inv.select("INVENTORY", "VESSEL", "CRUISE", "SPECIES_CODE", "SEX", "SHELL_CONDITION", "EGG_COLOR",
                      "EGG_CONDITION", "CLUTCH_SIZE", fix("COUNT", 4).alias("COUNT"), "N")


def length_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Strict min/max length and sampling factor by species x sex."""
    from ..operators.quality import ranges
    r = ranges(_specimen_table(spark, d))
    return r.select("SPECIES_CODE", "SEX", "MIN_LENGTH", "MAX_LENGTH",
                    fix("MIN_SAMPLING_FACTOR", 6).alias("MIN_SAMPLING_FACTOR"),
                    fix("MAX_SAMPLING_FACTOR", 6).alias("MAX_SAMPLING_FACTOR"))


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    """Q1-Q21: every specimen rule counted in one aggregation."""
    from ..operators.quality import quality_report as report
    return report(_specimen_table(spark, d))


def orphan_units(spark: SparkSession, d: str) -> DataFrame:
    """Lift ids present in the lift table only, or in the catch only."""
    from ..operators.quality import orphan_units as orphans
    lifts = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("SPN"))
    catch = B.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("SPN"))
    return orphans(lifts, catch, ["SPN"], "lifts_only", "catch_only")


QUERIES.update({
    "specimen_join_out": specimen_join_out,
    "basket_weight": basket_weight,
    "flatfish_expand": flatfish_expand,
    "estimate_counts": estimate_counts,
    "station_species_weights": station_species_weights,
    "crab_bycatch": crab_bycatch,
    "station_total": station_total,
    "shell_counts": shell_counts,
    "species_long": species_long,
    "layer_scales": layer_scales,
    "survey_range": survey_range,
    "inventory": inventory,
    "length_ranges": length_ranges,
    "quality_report": quality_report,
    "orphan_units": orphan_units,
})


# ---------------------------------------------------------------- geometry and interpolation

VARIO_CUTOFF = 150_000.0
VARIO_WIDTH = 10_000.0
COARSE_RES_M = 5 * K.GRID_RES_M


def _projected_stations(spark, d):
    from ..operators.spatial import project
    return project(B.stations(spark, d))


def albers(spark: SparkSession, d: str) -> DataFrame:
    """Stations projected to Alaska Albers (cm), in-window flag."""
    from ..functions.geo import in_window
    p = _projected_stations(spark, d)
    return p.select("STATION", "LON_DD", "LAT_DD", "X", "Y", in_window("X", "Y").alias("IN_WINDOW"))


def _layers(spark):
    from ..operators.spatial import TEST_LAYERS, polygon_vertices
    return polygon_vertices(spark, TEST_LAYERS)


def points_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    """Stations inside each polygon layer (square, square with hole, concave)."""
    from ..operators.spatial import points_in_polygon as pip
    r = pip(_projected_stations(spark, d), _layers(spark), "STATION")
    return r.select("STATION", F.col("poly_id").alias("POLY_ID"))


def outside_areas(spark: SparkSession, d: str) -> DataFrame:
    """Stations outside every area layer (the coordinate check)."""
    from ..operators.spatial import outside_areas as outside
    return outside(_projected_stations(spark, d), _layers(spark), "STATION").select("STATION", "X", "Y")


def nearest_area(spark: SparkSession, d: str) -> DataFrame:
    """Stations outside every area layer, the layer with the nearest edge and the distance to it."""
    from ..operators.spatial import nearest_area as near
    r = near(_projected_stations(spark, d), _layers(spark), "STATION")
    return r.select("STATION", "X", "Y", F.col("poly_id").alias("POLY_ID"), fix("METRES", 2).alias("METRES"))


def mask(spark: SparkSession, d: str) -> DataFrame:
    """Cells of 5 km over the stations' extent whose centres lie inside each area layer, by scan lines."""
    from ..operators.spatial import extent_of, make_grid, mask_cells
    cells = make_grid(extent_of(_projected_stations(spark, d)), COARSE_RES_M, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return mask_cells(_layers(spark), COARSE_RES_M).join(cells.select("IX", "IY"), ["IX", "IY"], "left_semi").select(
        "IX", "IY", F.col("poly_id").alias("POLY_ID"))


def grid(spark: SparkSession, d: str) -> DataFrame:
    """1 km cells over the projected extent of the stations."""
    from ..operators.spatial import extent_of, make_grid
    return make_grid(extent_of(_projected_stations(spark, d)), K.GRID_RES_M,
                     int(spark.conf.get("spark.sql.shuffle.partitions")))


def _samples(spark, d, where: str = "true"):
    from ..operators.krige import dedupe_samples
    return dedupe_samples(_projected_stations(spark, d).where(where).select("X", "Y", F.col("TEMP").alias("Z")))


def empirical_variogram(spark: SparkSession, d: str) -> DataFrame:
    """Semivariance by 10 km distance bin up to 150 km (tile equi-join)."""
    from ..operators.krige import empirical_variogram as ev
    v = ev(_samples(spark, d), VARIO_CUTOFF, VARIO_WIDTH)
    return v.select("BIN", "NP", fix("DIST", 2).alias("DIST"), fix("GAMMA", 6).alias("GAMMA"))


def variogram_tree(spark: SparkSession, d: str) -> DataFrame:
    """The same pairs and semivariances from a tree of tiles, which opens only pairs of tiles that straddle bins."""
    from ..operators.krige import tree_variogram
    v = tree_variogram(_samples(spark, d), VARIO_CUTOFF, VARIO_WIDTH)
    return v.select("BIN", "NP", fix("GAMMA", 6).alias("GAMMA"))


def variogram_fit_newton(spark: SparkSession, d: str) -> DataFrame:
    """The fit refined by damped Gauss-Newton steps: whether it converged, met a bound, and is no worse than the grid's."""
    from ..operators.krige import empirical_variogram as ev
    from ..operators.krige import fit_variogram, newton_fit
    from ..session import cut_lineage
    v = cut_lineage(ev(_samples(spark, d), VARIO_CUTOFF, VARIO_WIDTH))      # a bin a row, read three times
    grid_fit = fit_variogram(v)
    m = newton_fit(v, grid_fit).select("CONVERGED", F.col("SSE").alias("__sse"), F.lit(1).alias("__one"))
    g = grid_fit.select("SSE", "RANGE_AT_BOUND", F.lit(1).alias("__one"))
    return m.join(g, "__one").select("CONVERGED", (F.col("__sse") <= F.col("SSE") * (1 + 1e-9)).alias("NO_WORSE"), "RANGE_AT_BOUND",
                                     fix(F.col("SSE") * F.lit(1e9), 3).alias("GRID_SSE_E9"))


def _model(spark, d, where: str = "true") -> DataFrame:
    """One row: nugget, partial sill, range, weighted error and whether the range lies on a bound."""
    from ..operators.krige import empirical_variogram as ev
    from ..operators.krige import fit_variogram
    return fit_variogram(ev(_samples(spark, d, where), VARIO_CUTOFF, VARIO_WIDTH))


def variogram_fit(spark: SparkSession, d: str) -> DataFrame:
    """Bessel model (nugget, partial sill, range) by weighted least squares, and whether the range lies on a bound."""
    m = _model(spark, d)
    return m.select(fix("NUGGET", 6).alias("NUGGET"), fix("PSILL", 6).alias("PSILL"), fix("RANGE", 3).alias("RANGE"), "RANGE_AT_BOUND")


def variogram_fit_rounded(spark: SparkSession, d: str) -> DataFrame:
    """The fit with its weighted error."""
    m = _model(spark, d)
    return m.select(fix("NUGGET", 6).alias("NUGGET"), fix("PSILL", 6).alias("PSILL"),
                    fix("RANGE", 3).alias("RANGE"), fix(F.col("SSE") * F.lit(1e9), 3).alias("SSE_E9"))


SURFACE_TOL = 1e-12      # relative residual of the solver under the surfaces


def _surface(spark, d, res: float, where: str = "true", **options) -> DataFrame:
    """Kriged bottom temperature on cells of `res` metres inside the survey boundary, from the loggers of some stations."""
    from ..operators.krige import krige
    from ..operators.spatial import TEST_LAYERS, extent_of, make_grid, mask_cells, polygon_vertices
    m = _model(spark, d, where).first()
    cells = make_grid(extent_of(_projected_stations(spark, d)), res, int(spark.conf.get("spark.sql.shuffle.partitions")))
    inside = mask_cells(polygon_vertices(spark, {"boundary": TEST_LAYERS["strata"]}), res).select("IX", "IY")
    cells = cells.join(inside, ["IX", "IY"], "left_semi").withColumn("CELL", F.col("IX") * F.lit(1 << 32) + F.col("IY"))
    return krige(_samples(spark, d, where), cells, m["NUGGET"], m["PSILL"], m["RANGE"], target_id="CELL", tol=SURFACE_TOL, **options)


def temp_surface(spark: SparkSession, d: str) -> DataFrame:
    """Kriged bottom temperature on the 1 km grid inside the
    survey boundary, with its temperature band."""
    from ..functions.scalar import temp_band
    pred = _surface(spark, d, K.GRID_RES_M)
    return pred.select("CELL", "X", "Y", fix("PRED", 3).alias("TEMPERATURE"), temp_band("PRED").alias("BAND"))


def temp_variance(spark: SparkSession, d: str) -> DataFrame:
    """Kriged temperature and its variance from all loggers, on 5 km cells."""
    pred = _surface(spark, d, COARSE_RES_M, variance=True)
    return pred.select("CELL", "X", "Y", fix("PRED", 3).alias("TEMPERATURE"), fix("PRED_VAR", 3).alias("VARIANCE"))


def temp_local(spark: SparkSession, d: str) -> DataFrame:
    """Kriged temperature and its variance from the 16 nearest loggers of each 5 km cell."""
    pred = _surface(spark, d, COARSE_RES_M, variance=True, max_points=16)
    return pred.select("CELL", "X", "Y", fix("PRED", 3).alias("TEMPERATURE"), fix("PRED_VAR", 3).alias("VARIANCE"))


QUERIES.update({
    "variogram_fit_rounded": variogram_fit_rounded,
    "albers": albers,
    "points_in_polygon": points_in_polygon,
    "outside_areas": outside_areas,
    "grid": grid,
    "empirical_variogram": empirical_variogram,
    "variogram_fit": variogram_fit,
    "temp_surface": temp_surface,
    "nearest_area": nearest_area,
    "mask": mask,
    "variogram_tree": variogram_tree,
    "variogram_fit_newton": variogram_fit_newton,
    "temp_variance": temp_variance,
    "temp_local": temp_local,
})


# ---------------------------------------------------------------- map layers and files

def map_layer(spark: SparkSession, d: str) -> DataFrame:
    """Pot and trawl CPUE per station x class in
    one projected layer table."""
    from ..functions.scalar import regular_station
    from ..operators.layers import map_layer as layer
    pot = (zero_filled_catch(spark, d).where(regular_station("POT_ID"))
           .select("VESSEL", F.col("POT_ID").alias("STATION"), "LAT_DD", "LON_DD",
                   F.col("MAT_SEX").alias("CATEGORY"), "COUNT"))
    flags = C.maturity_flags("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE",
                             K.RED_KING_CRAB, K.MATURE_MALE_MM, K.LEGAL_MALE_MM)
    trawl = _station_classes(spark, d, flags, "MAT_SEX").select(
        F.lit("Vesteraalen").alias("VESSEL"), F.col("STATION").cast("string").alias("STATION"), "LAT_DD", "LON_DD",
        F.col("MAT_SEX").alias("CATEGORY"), fix(F.coalesce("__pos", F.lit(0.0)), 4).alias("COUNT"))
    out = layer([pot, trawl], "COUNT", "CATEGORY", unit="count")
    return out.select("GEAR", "VESSEL", "STATION", "LAT_DD", "LON_DD", "CATEGORY", "LABEL", "COUNT", "X", "Y",
                      "IS_ZERO", "UNIT")


def compare_surveys(spark: SparkSession, d: str, first: int = 1998, second: int = 1999) -> DataFrame:
    """Mature females per lift for two survey years on one scale.

    Comparing two surveys is the feature: the years are arguments, and they
    select orders by a date range, which the scan prunes, before any join."""
    from ..operators.layers import compare_surveys as compare
    from ..session import cut_lineage

    def year(y):
        return (F.col("o_orderdate") >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & \
               (F.col("o_orderdate") < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
    both = year(first) | year(second)
    keys = B.table(spark, d, "orders").where(both).select(F.col("o_orderkey").alias("SPN"))
    sp = B.specimens(spark, d).join(keys, "SPN", "left_semi")
    totals = C.class_totals(sp, ["SPN"], ["SPECIES_CODE", "SEX"], "TOSSED", _mat_flags(),
                            C.maturity_samples(K.RED_KING_CRAB))
    z = _catch_table(spark, d, totals, both).where(F.col("MAT_SEX") == "Mature female")
    # the joint scale and the rows both read z: checkpoint it once (shared dir)
    z = cut_lineage(z.select("SPN", "COUNT", F.year(F.to_date("DATE_SET", "M/d/yyyy")).alias("YEAR")))
    a = z.where(F.col("YEAR") == first).select("SPN", "COUNT")
    b = z.where(F.col("YEAR") == second).select("SPN", "COUNT")
    return compare(a, b, str(first), str(second), "COUNT").select("SURVEY", "SPN", "COUNT", "SCALE_LIMIT")


DROP_COLUMNS = ["HAUL", "HAUL_ID", "SPECIES_CODE", "SEX", "LENGTH", "WIDTH", "SHELL_CONDITION",
                "EGG_COLOR", "EGG_CONDITION", "CLUTCH_SIZE", "DISEASE_CODE", "DISEASE_DORSAL"]


def write_specimen_drops(spark: SparkSession, d: str, folder: str) -> None:
    """Specimen drops as CSV files whose headers differ: half lack WIDTH and order columns differently."""
    sp = B.specimens(spark, d)
    rows = sp.select(F.col("SPN").alias("HAUL"), F.concat(F.lit("H"), F.col("SPN")).alias("HAUL_ID"), *DROP_COLUMNS[2:])
    opts = {"header": "true", "nullValue": "NA"}
    even = F.coalesce(F.col("HAUL") % 2 == 0, F.lit(False))      # NULL and negative odd hauls go with the rest
    rows.where(even).write.options(**opts).mode("append").csv(folder)
    drift = rows.where(~even).drop("WIDTH")
    drift.select(*reversed(drift.columns)).write.options(**opts).mode("append").csv(folder)


def csv_drop_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A1 A2: specimen drops written as CSV files whose headers differ
    (half lack WIDTH and order columns differently), read back aligned by name."""
    import uuid
    from ..session import scratch_path
    from ..sources.drops import read_drop
    from ..sources.schemas import SPECIMEN
    folder = scratch_path(spark, f"drops-{uuid.uuid4().hex}")
    write_specimen_drops(spark, d, folder)
    return read_drop(spark, folder, r"\.csv$", SPECIMEN, by_header=True, lineage=False).select(*DROP_COLUMNS)


def cpue_stream(spark: SparkSession, d: str) -> DataFrame:
    """Streaming form of the flagship: specimen rows read as a file stream,
    per-batch additive partials appended (idempotent per batch), totals
    finished and zero-filled; equal to `zero_filled_catch`."""
    import uuid
    from ..session import scratch_path
    from ..streaming.drops import append_partials, class_totals_from_partials, read_drop_stream
    schema = B.table(spark, d, "lineitem").schema
    stream = read_drop_stream(spark, d, "lineitem.parquet", schema, fmt="parquet", max_files_per_trigger=1)
    flags, samples = _mat_flags(), C.maturity_samples(K.RED_KING_CRAB)
    base = scratch_path(spark, f"cpue-stream-{uuid.uuid4().hex}")
    q = append_partials(stream, lambda b: C.class_partials(B.specimens_from(b), ["SPN"], "TOSSED", flags, samples),
                        f"{base}/partials", f"{base}/_checkpoint")
    q.awaitTermination()
    totals = class_totals_from_partials(spark, f"{base}/partials", ["SPN"], flags, samples)
    return _catch_table(spark, d, totals)


QUERIES.update({
    "cpue_stream": cpue_stream,
    "map_layer": map_layer,
    "compare_surveys": compare_surveys,
    "csv_drop_roundtrip": csv_drop_roundtrip,
})


def pot_bycatch(spark: SparkSession, d: str) -> DataFrame:
    """A per-lift bycatch tally sheet, lift positions
    joined onto it (NULL vessel matches NULL), special-project pots without a
    position dropped, every NULL count 0, species totals from sexes."""
    from ..functions.nulls import fill_all0
    from ..functions.scalar import decode_vessel
    from ..operators import bycatch as BY
    sp = B.specimens(spark, d)
    sx, spc, part = F.col("SEX"), F.col("SPECIES_CODE"), F.col("PART")
    tallies = {
        "MaleTanner": (spc == K.TANNER_CRAB) & (sx == K.MALE), "FemaleTanner": (spc == K.TANNER_CRAB) & (sx == K.FEMALE),
        "MaleSnow": (spc == K.SNOW_CRAB) & (sx == K.MALE), "FemaleSnow": (spc == K.SNOW_CRAB) & (sx == K.FEMALE),
        "MaleHybrid": F.lit(False), "FemaleHybrid": F.lit(False),
        "HairCrab": (spc == K.HAIR_CRAB) & sx.isNotNull(), "PacificCod": part % 7 == 0,
    }
    sheet = sp.groupBy("SPN").agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in tallies.items()],
                                  F.when(F.first(F.col("SPN") % 5) != 0, F.count_if(part % 7 == 1)).alias("Other"))
    raw = B.raw_lifts(spark, d).select(
        "SPN", decode_vessel("VESSEL_CODE", B.POT_VESSEL_CODES).alias("VESSEL"),
        F.when(F.col("SPN") % 37 == 0, F.lit("SP")).otherwise(F.col("POT_ID")).alias("POT_ID"), "DATE_HAUL")
    sheet = sheet.join(raw, "SPN")
    lifts = B.lifts(spark, d).select("VESSEL", "SPN", "POT_ID", "LON_DD", "LAT_DD")
    j = BY.add_species_totals(fill_all0(BY.sheet_positions(sheet, lifts, ["VESSEL", "SPN", "POT_ID"])))
    return j.select("VESSEL", "SPN", "LAT_DD", "LON_DD", "POT_ID", "DATE_HAUL", *tallies, "Other", *K.SEX_SUMS)


QUERIES["pot_bycatch"] = pot_bycatch


def catch_reconcile_totals(spark: SparkSession, d: str) -> DataFrame:
    """Specimen totals (Σ factor, entries) against the catch summary
    (estimated counts and reported entries of `expanded_catch_reconcile`):
    keys where either number differs or that exist on one side only."""
    from ..functions.nulls import strict_sum
    from ..operators.quality import reconcile_totals
    spec = C.sampling_factor(B.specimens(spark, d), ["SPN", "SPECIES_CODE", "SEX"], "TOSSED")
    spec_sum = spec.groupBy("SPN", "SPECIES_CODE").agg(fix(strict_sum("SAMPLING_FACTOR"), 4).alias("NUMBER_CRAB"),
                                                      F.count(F.lit(1)).alias("N_ENTRIES"))
    catch_sum = expanded_catch_reconcile(spark, d).select("SPN", "SPECIES_CODE", "NUMBER_CRAB", "N_ENTRIES")
    return reconcile_totals(spec_sum, catch_sum, ["SPN", "SPECIES_CODE"])


QUERIES["catch_reconcile_totals"] = catch_reconcile_totals
