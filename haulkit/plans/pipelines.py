"""Survey products from raw drops: pot(), trawl(), fish(), layers().

The same products the survey scripts write (specimen tables, potlifts, catch
summaries, zero-filled CPUE, bycatch sheets, fish catch, data-quality report,
map layers), built as Spark plans from the operators.  Each function returns a
dict of lazy DataFrames.  `pot` and `trawl` first store the specimens and the
groups that share a haul, sample and catch (`Steps`), so that the shuffles of all
fixed here as documented there (device kept in specimen keys, catch deduped
before joins, vessel check for trawls, etc.).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as K
from ..functions import nulls as N
from ..functions import scalar as S
from ..operators import bycatch as BY
from ..operators import catch as C
from ..operators import fish as FI
from ..operators import lifts as L
from ..operators import quality as QU
from ..operators.joins import key_parts, merge_nulls, natural_join, null_safe_join, split_nulls
from ..operators.specimens import duplicates, fanout, widen
from ..sources import schemas as SC
from ..session import Steps, cut_lineage
from ..sources.drops import read_drop, read_table, write_product

LIFT_KEYS = ["SPN", "VESSEL", "POT_ID", "BUOY", "LAT_DD", "LON_DD"]


def _opt(df: DataFrame, cols):
    """Select listed columns, NULL for any the drops did not carry."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])


def _drops(spark: SparkSession, folder: str, pattern: str, schema: StructType) -> DataFrame:
    """`read_drop` without lineage: the file's metadata would be built for every row, read or not."""
    return read_drop(spark, folder, pattern, schema, lineage=False)


@dataclass
class PotInputs:
    catch_dir: str
    specimen_dir: str
    raw_dir: str
    potlift_sheets: Sequence[str]
    bycatch_sheets: Sequence[str] = ()
    recode_gear_sheets: Sequence[int] = (1,)      # sheets whose gear codes are recoded (42 kept)
    exclude_spn: Sequence[int] = (215,)
    gear_codes: Sequence[str] = ("44",)
    vessels: Mapping[int, str] = field(default_factory=lambda: {162: "Marahute", 134: "Provider"})
    tz: str = "America/Anchorage"
    cruise: int = 202401


# ---------------------------------------------------------------- shared pieces

SPECIMEN_IDS = ["SPECIMEN_ID", "HAUL_ID", "RECORDING_DEVICE"]
FACTOR_KEYS = ["HAUL", "HAUL_ID", "CATCH_SAMPLE_ID", "SEX", "RECORDING_DEVICE"]
SAMPLE_KEYS = [*FACTOR_KEYS, "SPECIES_CODE"]
# What specimens of a group share: all that samples, catches and hauls are joined by but the haul's
# number, which follows from its id where the specimen has biometrics (ENTERED).
GROUP_KEYS = ["HAUL_ID", "SEX", "CATCH_SAMPLE_ID", "SPECIES_CODE", "RECORDING_DEVICE", "ENTERED"]
PART = "__HAUL_PART"


def by_haul(df: DataFrame) -> DataFrame:
    """A table of hauls or of their sample groups dealt out by haul id, for joins with `part=PART`."""
    return df.withColumn(PART, F.xxhash64("HAUL_ID")).repartition(PART)


def specimen_rows(spark: SparkSession, raw_dir: str, catch: DataFrame, steps: Steps,
                  trawl: bool = False) -> tuple[DataFrame, DataFrame]:
    """(specimens, rejected biometrics): biometrics long -> wide (D15), joined to
    raw specimens (C8).  The recording device stays in the specimen key so ids
    from two tablets cannot collide.  A biometric entered twice is NULL in the
    table and listed in the second frame.  Trawls keep every specimen with
    biometrics, after dropping repeated rows, and a row without any for every
    catch haul (C2); pots keep every raw specimen.  ROWS counts repeated raw rows,
    ENTERED says whether there were biometrics.

    Both sides are dealt out by the parts of the specimen's key once, for the
    widening, the count of repeats and the join.  All other joins have keys that
    the specimens of a group (GROUP_KEYS) share: they are made once a group, and
    the specimens meet their result."""
    bio = _drops(spark, raw_dir, "_SPECIMEN_BIOMETRICS", SC.RAW_SPECIMEN_BIO)
    raw_spec = _drops(spark, raw_dir, "_SPECIMEN_0", SC.RAW_SPECIMEN).select(
        "HAUL_ID", "SPECIMEN_ID", "CATCH_SAMPLE_ID", "SPECIES_CODE", "RECORDING_DEVICE")
    hauls = catch.select("HAUL", "HAUL_ID", "RECORDING_DEVICE").dropDuplicates()
    entered = null_safe_join(bio, hauls, ["HAUL_ID", "RECORDING_DEVICE"], "right" if trawl else "left")
    entered = entered.distinct() if trawl else entered
    rejected = duplicates(entered.where(F.col("SPECIMEN_ID").isNotNull()), ["HAUL", *SPECIMEN_IDS], "BIOMETRIC_NAME")

    bio = bio.withColumn("ENTERED", F.lit(True))
    if trawl:
        bio = bio.unionByName(hauls.drop("HAUL").distinct(), allowMissingColumns=True)
    parts = key_parts(SPECIMEN_IDS)
    wide = widen(split_nulls(bio, SPECIMEN_IDS), parts, "BIOMETRIC_NAME", "VALUE", K.BIOMETRICS, distinct=trawl,
                 also=[F.max("ENTERED").alias("ENTERED")])
    wide = wide.withColumnsRenamed(K.BIOMETRIC_RENAMES)
    wide = wide.withColumns({c: F.col(c).cast("int") for c in K.INT_BIOMETRICS})
    raw_spec = split_nulls(raw_spec, SPECIMEN_IDS).repartition(*[F.col(c) for c in parts])
    raw_spec = raw_spec.groupBy(*parts, "CATCH_SAMPLE_ID", "SPECIES_CODE").agg(F.count(F.lit(1)).alias("ROWS"))
    rows = wide.join(raw_spec, parts, "left") if trawl else raw_spec.join(wide, parts, "left")
    rows = merge_nulls(rows, SPECIMEN_IDS).withColumn("ENTERED", F.coalesce("ENTERED", F.lit(False)))
    return steps.store(rows.drop("SPECIMEN_ID", "WEIGHT", "N_DUP"), "rows"), rejected


def pot_lifts(spark: SparkSession, inp: PotInputs) -> DataFrame:
    """The potlift sheets cleaned and unioned by name."""
    parts = []
    for i, path in enumerate(inp.potlift_sheets):
        s = read_table(spark, path, SC.POTLIFTS)
        s = L.valid_lifts(s, "TIME_HAUL", "DATE_HAUL")
        if i in inp.recode_gear_sheets:
            s = L.recode_gear(s, "GEAR_CODE", "42")
            for spn in inp.exclude_spn:
                s = L.valid_lifts(s, "TIME_HAUL", "DATE_HAUL", {"SPN": spn})
        parts.append(s)
    lifts = parts[0]
    for p in parts[1:]:
        lifts = lifts.unionByName(p)
    lifts = L.gear_filter(lifts, "GEAR_CODE", "VESSEL", inp.gear_codes).withColumn("BUOY", N.prefix_id("BUOY"))
    return L.derive_lift_fields(lifts, inp.tz)


def pot(spark: SparkSession, inp: PotInputs, zero_rate: bool = False, literal_position_filter: bool = False,
        stored: bool = True) -> dict:
    """The pot-gear products (specimen table, potlifts, catch summary, CPUE,
    bycatch, reconciliation and quality report).  The specimens with their haul and
    catch are `stored` for several products; a single one reads what it needs."""
    catch = _drops(spark, inp.catch_dir, "_CATCH_", SC.CATCH).drop("STATION")
    specimen = _drops(spark, inp.specimen_dir, "_SPECIMEN_", SC.SPECIMEN)
    specimen = specimen.withColumn("STATION", N.prefix_id("STATION"))
    raw_sample = by_haul(_drops(spark, inp.raw_dir, "_SAMPLE_0", SC.RAW_SAMPLE))
    tossed = C.tossed_totals(by_haul(_drops(spark, inp.raw_dir, "_SAMPLE_VALUES", SC.RAW_SAMPLE_VALUES)),
                             [PART, "HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE"])
    hauls = by_haul(catch.select("HAUL", "HAUL_ID", "RECORDING_DEVICE")).dropDuplicates()

    # the sample's id comes last: sorted for this join is sorted for the next
    samples = null_safe_join(raw_sample, tossed, ["HAUL_ID", "RECORDING_DEVICE", "CATCH_SAMPLE_ID"], "right", PART)
    samples = null_safe_join(samples, hauls, ["HAUL_ID", "RECORDING_DEVICE"], "right", PART).select(
        PART, "HAUL", "HAUL_ID", "CATCH_SAMPLE_ID", "SPECIES_CODE", "SPECIES_NAME", "SEX", "TOSSED", "RECORDING_DEVICE")
    steps = Steps(spark, "pot")
    rows, rejected = specimen_rows(spark, inp.raw_dir, catch, steps)

    # groups of specimens with their haul, sample (C9, many-to-many), factor and catch, without repeats
    groups = by_haul(rows.groupBy(*GROUP_KEYS).agg(F.sum("ROWS").alias("ROWS")))
    groups = null_safe_join(groups, hauls, ["HAUL_ID", "RECORDING_DEVICE"], "left", PART, only="ENTERED")
    ss = null_safe_join(samples, groups, SAMPLE_KEYS, "right", PART)
    sf = C.sampling_factor(ss, FACTOR_KEYS, "TOSSED", rows="ROWS", part=PART)
    caught = null_safe_join(by_haul(catch.drop("RECORDING_DEVICE", "ID")), sf.drop("ROWS"), ["HAUL", "HAUL_ID", "SPECIES_CODE"], "right", PART).distinct()
    # from here on rows may only differ in columns that no product has
    caught = steps.store(caught.select("HAUL", *GROUP_KEYS, *[c for c in K.POT_SPECIMEN_COLUMNS if c in caught.columns and c not in GROUP_KEYS]),
                         "groups", by_part=True)
    st = null_safe_join(caught, rows.drop("ROWS"), GROUP_KEYS, "right")
    st = natural_join(st, specimen.drop("NOTES").distinct(), "left").withColumnRenamed("HAUL", "SPN")
    st = st.select(*[c for c in K.POT_SPECIMEN_COLUMNS if c in st.columns])
    st = steps.store(st, "specimens", drop=["groups"]) if stored else st
    lifts = pot_lifts(spark, inp)
    lift_fanout = fanout(st.select("VESSEL", "SPN"), lifts.select("VESSEL", "SPN"), ["VESSEL", "SPN"])
    st = null_safe_join(lifts, st, ["SPN", "VESSEL"], "right")
    st = st.withColumn("VESSEL", S.decode_vessel("VESSEL", inp.vessels))
    st = (N.require_any(st, ["LAT_DD", "LON_DD", "SPN"]) if literal_position_filter
          else N.require(st, ["LAT_DD", "LON_DD"]))
    specimen_table = _opt(st, K.POT_SPECIMEN_COLUMNS)

    named_lifts = lifts.withColumn("VESSEL", S.decode_vessel("VESSEL", inp.vessels))
    potlifts = _opt(named_lifts, K.POTLIFT_COLUMNS)

    est = C.expanded_count(specimen_table, ["SPN", "CRUISE", "VESSEL", "POT_ID", "SPECIES_CODE"])
    rep = catch.withColumnsRenamed({"HAUL": "SPN", "NUMBER_CRAB": "N_ENTRIES"}).withColumn(
        "VESSEL", S.decode_vessel("VESSEL", inp.vessels))
    cs = null_safe_join(est, rep, ["SPN", "CRUISE", "VESSEL", "SPECIES_CODE"], "right")
    catch_summary = cs.select("CRUISE", "VESSEL", "SPN", "POT_ID", "SPECIES_CODE", "NUMBER_CRAB", "N_ENTRIES").dropna()
    mismatches = catch_summary.where(F.col("NUMBER_CRAB") != F.col("N_ENTRIES"))

    mat = S.maturity_class("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE")
    leg = S.legal_class("SPECIES_CODE", "SEX", "LENGTH")
    classed = specimen_table.where(mat.isNotNull() | leg.isNotNull())
    positive = C.cpue(C.explode_classes(classed, [mat, leg]), LIFT_KEYS, "MAT_SEX")
    fills = {"COUNT": 0.0, "CATCH_PER_HOUR": 0.0} if zero_rate else {"COUNT": 0.0}
    pot_cpue = _opt(C.zero_fill(positive, potlifts, LIFT_KEYS, "MAT_SEX", K.MAT_SEX_CATEGORIES, fills),
                    K.POT_CPUE_COLUMNS)

    out = {"specimen_table": specimen_table, "potlifts": potlifts, "catch_summary": catch_summary,
           "catch_mismatches": mismatches, "pot_cpue": pot_cpue, "duplicate_biometrics": rejected,
           # many-to-many joins are reported, not hidden (keys whose right side repeats)
           "fanout_samples": fanout(ss, samples, SAMPLE_KEYS, "ROWS"),
           "fanout_potlifts": lift_fanout}
    if inp.bycatch_sheets:
        out["pot_bycatch"] = pot_bycatch(spark, inp, potlifts)
    out.update(quality_products("POT", specimen_table, catch_summary, potlifts, pot_cpue, inp.cruise))
    return out


def pot_bycatch(spark: SparkSession, inp: PotInputs, potlifts: DataFrame) -> DataFrame:
    """Bycatch sheets with lift positions, species totals."""
    sheet = None
    for path in inp.bycatch_sheets:
        s = read_table(spark, path, SC.POT_BYCATCH)
        sheet = s if sheet is None else sheet.unionByName(s)
    sheet = sheet.where(N.present("DATE_HAUL") & F.col("VESSEL").isNotNull())
    sheet = sheet.withColumns({"SPN": N.to_double("SPN").cast("bigint"),
                               "VESSEL": S.decode_vessel("VESSEL", inp.vessels)})
    j = BY.sheet_positions(sheet, potlifts.select("VESSEL", "SPN", "POT_ID", "LON_DD", "LAT_DD"),
                           ["VESSEL", "SPN", "POT_ID"])
    j = BY.add_species_totals(N.fill_all0(j))
    return j.select("VESSEL", "SPN", "LAT_DD", "LON_DD", "POT_ID", "DATE_HAUL", "MaleTanner", "FemaleTanner",
                    "MaleSnow", "FemaleSnow", "MaleHybrid", "FemaleHybrid", "Tanner", "Snow", "Hybrid", "HairCrab",
                    "PacificCod", "Halibut", "GreatSculpin", "YellowfinSole", "Pollock", "StarryFlounder", "Other")


def quality_products(method: str, specimen_table: DataFrame, catch_summary: DataFrame, units: DataFrame,
                     cpue: DataFrame, cruise: int) -> dict:
    """error_chk as tables: rule report, inventories, ranges, orphan units, reconciliation.

    Both sides of the reconciliation are per lift (pots) or haul (trawls).  The
    specimen side's N_ENTRIES counts measured crab, the catch side's is the number
    of crab that the catch file reports, tossed ones included."""
    vessels = K.POT_VESSELS if method == "POT" else K.TRAWL_VESSELS
    rules = QU.specimen_rules(expected_cruise=cruise, vessels=vessels)
    unit_keys = (["VESSEL", "SPN", "POT_ID", "BUOY", "LAT_DD", "LON_DD"] if method == "POT"
                 else ["STATION", "LAT_DD", "LON_DD"])
    group = ["CRUISE", "VESSEL", "SPN", "POT_ID", "SPECIES_CODE"] if method == "POT" else ["CRUISE", "VESSEL", "HAUL", "SPECIES_CODE"]
    spec_sum = specimen_table.groupBy(*group).agg(N.strict_sum("SAMPLING_FACTOR").alias("NUMBER_CRAB"),
                                                   F.count(F.lit(1)).alias("N_ENTRIES"))
    cat = catch_summary.select(*group, "NUMBER_CRAB", "N_ENTRIES")
    return {"quality_report": QU.quality_report(specimen_table, rules),
            "inventories": QU.inventories(specimen_table),
            "ranges": QU.ranges(specimen_table),
            "orphan_units": QU.orphan_units(units, cpue, unit_keys, "units_only", "cpue_only"),
            "catch_reconcile": QU.reconcile_totals(spec_sum, cat.withColumn("N_ENTRIES", F.col("N_ENTRIES").cast("bigint")),
                                                   group)}


# ---------------------------------------------------------------- trawl crab

@dataclass
class TrawlInputs:
    catch_dir: str
    specimen_dir: str
    raw_dir: str
    hauls_sheet: str
    vessel_code: int = 176
    vessel_name: str = "Vesteraalen"
    cruise: int = 202401


def _trawl_vessel(inp: TrawlInputs):
    """ifelse(VESSEL == code, name, ""): NULL code stays NULL (R's ifelse on NA)."""
    v = F.col("VESSEL")
    return F.when(v.isNull(), F.lit(None).cast("string")).when(v == inp.vessel_code, inp.vessel_name).otherwise("")


def trawl_hauls(spark: SparkSession, path: str) -> DataFrame:
    """Sampled hauls only."""
    return read_table(spark, path, SC.HAULS).where(F.col("SAMPLED") == 1)


def trawl(spark: SparkSession, inp: TrawlInputs) -> dict:
    """Trawl crab products: specimen table (factor 1), catch summary, CPUE per
    haul x class (zero-filled), crab bycatch sheet, quality report.

    The haul sheet is matched by station, many-to-many: where a station is towed
    twice, the specimen table lists each crab at both positions.  Sums are per
    position, so a crab counts once at each tow."""
    catch = _drops(spark, inp.catch_dir, "_CATCH_", SC.CATCH)
    specimen = _drops(spark, inp.specimen_dir, "_SPECIMEN_", SC.SPECIMEN)
    raw_sample = _drops(spark, inp.raw_dir, "_SAMPLE_0", SC.RAW_SAMPLE)
    values = _drops(spark, inp.raw_dir, "_SAMPLE_VALUES", SC.RAW_SAMPLE_VALUES)
    hauls = trawl_hauls(spark, inp.hauls_sheet)
    catch_hauls = catch.select("HAUL", "HAUL_ID", "RECORDING_DEVICE").dropDuplicates()

    samples = null_safe_join(
        values.select("HAUL_ID", "CATCH_SAMPLE_VALUE_ID", "CATCH_SAMPLE_ID", "WEIGHT", "KEEP", "RECORDING_DEVICE", "RECORDER"),
        raw_sample.select("HAUL_ID", "CATCH_SAMPLE_ID", "MIX", "SAMPLED_ALL", "PARENT_SAMPLE_ID", "SPECIES_CODE",
                          "SPECIES_NAME", "SEX", "RECORDING_DEVICE", "RECORDER"),
        ["HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE", "RECORDER"], "left")
    samples = null_safe_join(samples, catch_hauls, ["HAUL_ID", "RECORDING_DEVICE"], "left")
    bkeys = ["HAUL", "HAUL_ID", "CATCH_SAMPLE_ID", "SEX", "SPECIES_CODE", "RECORDING_DEVICE"]
    baskets = C.basket_weight(samples, bkeys, "WEIGHT")
    attrs = samples.drop("WEIGHT", "CATCH_SAMPLE_VALUE_ID", "RECORDER").distinct()
    samples2 = null_safe_join(baskets, attrs, bkeys, "left").distinct()

    steps = Steps(spark, "trawl")
    rows, rejected = specimen_rows(spark, inp.raw_dir, catch, steps, trawl=True)
    # groups of specimens with their haul, sample and catch; a haul's row without specimens only where it has none
    groups = by_haul(rows.select(*GROUP_KEYS).distinct())
    groups = null_safe_join(groups, by_haul(catch_hauls), ["HAUL_ID", "RECORDING_DEVICE"], "inner", PART)
    entered = F.max("ENTERED").over(Window.partitionBy(PART, "HAUL_ID", "RECORDING_DEVICE"))
    groups = groups.withColumn("ANY", entered).where(F.col("ENTERED") | ~F.col("ANY")).drop("ANY")
    ss = null_safe_join(by_haul(samples2.select(*SAMPLE_KEYS, "SPECIES_NAME").distinct()), groups, SAMPLE_KEYS, "right", PART)
    caught = null_safe_join(by_haul(catch.drop("WEIGHT")), ss, ["HAUL", "HAUL_ID", "SPECIES_CODE", "RECORDING_DEVICE"], "right", PART)
    caught = steps.store(caught.drop(PART), "groups", by_part=True)
    st = null_safe_join(caught, rows.drop("ROWS"), GROUP_KEYS, "inner").drop("ENTERED")
    st = natural_join(st, specimen, "left")
    st = null_safe_join(hauls, st, ["STATION"], "right")
    st = st.withColumns({"VESSEL": _trawl_vessel(inp), "SAMPLING_FACTOR": F.lit(1.0)})
    specimen_table = _opt(st, K.TRAWL_SPECIMEN_COLUMNS)

    est = C.expanded_count(specimen_table, ["CRUISE", "VESSEL", "HAUL", "STATION", "SPECIES_CODE"])
    rep = catch.withColumnRenamed("NUMBER_CRAB", "N_ENTRIES").withColumn("VESSEL", _trawl_vessel(inp))
    cs = null_safe_join(est, rep, ["CRUISE", "VESSEL", "HAUL", "STATION", "SPECIES_CODE"], "right")
    catch_summary = cs.select("CRUISE", "VESSEL", "HAUL", "STATION", "SPECIES_CODE", "NUMBER_CRAB", "N_ENTRIES").dropna()

    rkc = specimen_table.where(F.col("SPECIES_CODE") == K.RED_KING_CRAB)
    mat = S.maturity_class("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE")
    leg = S.legal_class("SPECIES_CODE", "SEX", "LENGTH")
    rows = C.explode_classes(rkc.where(mat.isNotNull() | leg.isNotNull()), [mat, leg])
    place = ["STATION", "LAT_DD", "LON_DD"]
    positive = rows.groupBy("VESSEL", "HAUL", *place, "MAT_SEX").agg(N.strict_sum("SAMPLING_FACTOR").alias("COUNT"))
    units = hauls.select(*place)
    trawl_cpue = C.zero_fill(positive, units, place, "MAT_SEX", K.MAT_SEX_CATEGORIES, {"COUNT": 0.0, "VESSEL": inp.vessel_name})
    trawl_cpue = trawl_cpue.select("VESSEL", "HAUL", *place, "MAT_SEX", "COUNT")

    wide = BY.crab_bycatch_wide(specimen_table, ["VESSEL", *place])
    sheet = BY.add_species_totals(BY.zero_filled_sheet(units, wide, place, K.SPP_SEX_CATEGORIES)).fillna({"VESSEL": inp.vessel_name})
    crab_bycatch = sheet.select("VESSEL", "STATION", "LAT_DD", "LON_DD", *K.SPP_SEX_CATEGORIES, *K.SEX_SUMS)

    out = {"specimen_table": specimen_table, "catch_summary": catch_summary,
           "catch_mismatches": catch_summary.where(F.col("NUMBER_CRAB") != F.col("N_ENTRIES")),
           "trawl_cpue": trawl_cpue, "crab_bycatch": crab_bycatch, "duplicate_biometrics": rejected}
    q = quality_products("TRAWL", rkc, catch_summary.where(F.col("SPECIES_CODE") == K.RED_KING_CRAB),
                         units.select("STATION", "LAT_DD", "LON_DD"), trawl_cpue, inp.cruise)
    out.update(q)
    return out


# ---------------------------------------------------------------- trawl groundfish

@dataclass
class FishInputs:
    catch_dir: str
    raw_dir: str
    hauls_sheet: str
    vessel_name: str = "Vesteraalen"
    cruise: int = 202401


def fish(spark: SparkSession, inp: FishInputs) -> dict:
    """Groundfish products: fish catch per sample x species (flatfish factor,
    estimated counts, expansion), station weight/count by label, bycatch sheet."""
    names = _drops(spark, inp.catch_dir, "_CATCH_", SC.CATCH).select(
        "SPECIES_CODE", "SPECIES_NAME").distinct()
    raw_sample = _drops(spark, inp.raw_dir, "_SAMPLE_0", SC.RAW_SAMPLE)
    values = _drops(spark, inp.raw_dir, "_CATCH_VALUE", SC.RAW_FISH_VALUES)
    raw_haul = _drops(spark, inp.raw_dir, "_HAUL_0", SC.RAW_HAUL).drop("WEIGHT", "WEIGHT_UNITS")
    hauls = trawl_hauls(spark, inp.hauls_sheet)

    s = null_safe_join(values, raw_sample.select("HAUL_ID", "CATCH_SAMPLE_ID", "SPECIES_CODE", "RECORDING_DEVICE",
                                                 "RECORDER"), ["CATCH_SAMPLE_ID", "RECORDING_DEVICE", "RECORDER"], "left")
    s = null_safe_join(s, raw_haul.select("HAUL_ID", "CRUISE_ID", "HAUL", "STATION", "RECORDING_DEVICE"),
                       ["HAUL_ID", "RECORDING_DEVICE"], "left")
    s = s.where(N.not_in("SPECIES_CODE", K.CRAB_CODES))
    s = null_safe_join(s, names, ["SPECIES_CODE"], "left")
    s = s.withColumns({"SPECIES_NAME": S.merge_species_name("SPECIES_NAME"),
                       "SPECIES_CODE": S.merge_species_code("SPECIES_CODE")})
    # the cleaned rows feed the per-station sums and the rows they scale: parse the CSV drops once
    s = FI.flatfish_expand(cut_lineage(N.require(s, ["HAUL_ID", "SPECIES_CODE"])), ["STATION"])
    keys = ["HAUL", "HAUL_ID", "CATCH_SAMPLE_ID", "RECORDING_DEVICE", "STATION", "SPECIES_CODE", "SPECIES_NAME",
            "SAMPLING_FACTOR"]
    est = FI.estimate_counts(s, keys)
    est = null_safe_join(est, hauls.select("STATION", "LAT_DD", "LON_DD"), ["STATION"], "left")
    fish_catch = est.withColumns({"VESSEL": F.lit(inp.vessel_name), "CRUISE": F.lit(inp.cruise)}).select(
        "CRUISE", "VESSEL", "HAUL", "STATION", "LAT_DD", "LON_DD", "SPECIES_CODE", "SPECIES_NAME", "IND_WEIGHT",
        "WEIGHT", "COUNT", "SAMPLING_FACTOR", "CALC_WEIGHT", "CALC_COUNT")
    station = FI.station_totals(fish_catch, ["VESSEL", "STATION", "LAT_DD", "LON_DD"])
    place = ["VESSEL", "STATION", "LAT_DD", "LON_DD"]      # one tow's position: a station may be towed twice
    wide = FI.station_label_weights(fish_catch, place)
    units = hauls.select("STATION", "LAT_DD", "LON_DD").withColumn("VESSEL", F.lit(inp.vessel_name))
    sheet = BY.zero_filled_sheet(units, wide, place, K.FISH_BYCATCH_COLUMNS)
    return {"fish_catch": fish_catch, "station_weight_count": station,
            "fish_bycatch": sheet.select("VESSEL", "STATION", "LAT_DD", "LON_DD", *K.FISH_BYCATCH_COLUMNS)}


# ---------------------------------------------------------------- map data

def layers(pot_cpue: DataFrame, trawl_cpue: DataFrame, pot_bycatch: DataFrame | None = None,
           trawl_crab: DataFrame | None = None, trawl_fish: DataFrame | None = None,
           station_from: str = "POT_ID", pot_specimens: DataFrame | None = None,
           trawl_specimens: DataFrame | None = None) -> dict:
    """Map-ready tables: CPUE layer (pot + trawl, projected), totals over the
    maturity classes, bycatch layer (long) with legend scales, and (K5) the
    mature crab by sex x shell condition per station, zero-filled over the
    stations of the CPUE layer."""
    from ..operators.layers import map_layer, scale_limits
    from ..operators.specimens import lengthen
    pot = (pot_cpue.withColumnRenamed(station_from, "STATION").where(S.regular_station("STATION"))
           .select("VESSEL", "STATION", "LAT_DD", "LON_DD", F.col("MAT_SEX").alias("CATEGORY"), "COUNT"))
    trawl = trawl_cpue.select("VESSEL", F.col("STATION").cast("string").alias("STATION"), "LAT_DD", "LON_DD",
                              F.col("MAT_SEX").alias("CATEGORY"), "COUNT")
    cpue = map_layer([pot, trawl], "COUNT", "CATEGORY", unit="count")
    total = C.station_total(cpue, ["GEAR", "VESSEL", "STATION", "LAT_DD", "LON_DD", "X", "Y"], "CATEGORY",
                            K.MATURITY_TOTAL_CATEGORIES)
    out = {"cpue_layer": cpue, "total_layer": total,
           "cpue_scales": scale_limits(cpue.withColumnRenamed("COUNT", "VALUE"))}
    if pot_bycatch is not None and trawl_fish is not None:
        cols = ["VESSEL", "STATION", "LAT_DD", "LON_DD"] + [c for c in K.BYCATCH_LABELS]
        tb = BY.merge_trawl_bycatch(trawl_fish, trawl_crab) if trawl_crab is not None else trawl_fish
        pb = pot_bycatch.withColumnRenamed("BUOY" if "BUOY" in pot_bycatch.columns else station_from, "STATION")
        pb = pb.withColumn("RockSole", F.lit(0.0)).where(S.regular_station("STATION"))
        u = _opt(tb.withColumn("STATION", F.col("STATION").cast("string")), cols).unionByName(_opt(pb, cols))
        long = lengthen(u.withColumns({c: F.col(c).cast("double") for c in K.BYCATCH_LABELS}),
                        ["VESSEL", "STATION", "LAT_DD", "LON_DD"], list(K.BYCATCH_LABELS), "CATEGORY", "VALUE")
        by = map_layer([long], "VALUE", "CATEGORY")
        out["bycatch_layer"] = by
        out["bycatch_scales"] = scale_limits(by)
    if pot_specimens is not None and trawl_specimens is not None:
        keep = ["VESSEL", "STATION", "SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE", "SHELL_CONDITION",
                "SAMPLING_FACTOR"]
        ps = pot_specimens.withColumnRenamed(station_from, "STATION").where(S.regular_station("STATION"))
        spec = _opt(trawl_specimens.withColumn("STATION", F.col("STATION").cast("string")), keep).unionByName(
            _opt(ps, keep))
        spec = spec.withColumn("MAT_SEX_SC", S.shell_class("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE",
                                                           "SHELL_CONDITION")).where(F.col("MAT_SEX_SC").isNotNull())
        positive = C.category_counts(spec, ["VESSEL", "STATION"], "MAT_SEX_SC")
        units = total.select("VESSEL", "STATION", "LAT_DD", "LON_DD", "X", "Y", "GEAR")
        out["shell_layer"] = C.zero_fill(positive, units, ["VESSEL", "STATION"], "MAT_SEX_SC", K.SHELL_CATEGORIES,
                                         {"COUNT": 0.0})
    return out


def write_products(products: Mapping[str, DataFrame], base: str, survey: str, fmt: str = "parquet") -> list[str]:
    """A5: write every product of a pipeline under base/<name>/survey=<id>."""
    return [write_product(df, base, name, survey, fmt) for name, df in products.items()]
