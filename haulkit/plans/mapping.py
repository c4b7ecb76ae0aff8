"""Queries of files and map tables: the drop data source, product snapshots, layers
read back, violations by row, bycatch and shell layers, temperatures under
layers and of two surveys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import fix, temp_band
from ..session import cut_lineage, scratch_path
from ..sources import drops as D
from ..sources import snapshots as SN
from ..sources.dropsource import scan_drops
from ..sources.schemas import PLACENAMES, SPECIMEN
from . import bindings as B
from . import oracle as O
from . import pipelines as P
from . import queries as Q

QUERIES, ORACLE = {}, {}


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- files

def drops_scan(spark: SparkSession, d: str) -> DataFrame:
    """A1 A2: specimen drops of two headers read in one scan by the drop data source."""
    folder = _folder(spark, "drops")
    Q.write_specimen_drops(spark, d, folder)
    return scan_drops(spark, folder, r"\.csv$", SPECIMEN, lineage=False, part=1 << 20).select(*Q.DROP_COLUMNS)


def product_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Crab and weight per lift published twice, before and after the last specimens came; the prior
    snapshot against the latest."""
    base = _folder(spark, "products")
    sp = B.specimens(spark, d)
    for rows in (sp.where("SPECIMEN_ID <= 3 AND SPN % 7 <> 0"), sp):
        SN.publish(rows.groupBy("SPN").agg(F.count(F.lit(1)).alias("CRABS"), F.max("LENGTH").alias("LENGTH")), base, "lift_crabs", "2024")
    return SN.changes(SN.prior(spark, base, "lift_crabs", "2024"), SN.snapshot(spark, base, "lift_crabs", "2024"), ["SPN"])


def product_reload(spark: SparkSession, d: str) -> DataFrame:
    """Station products of two surveys written by survey, the second survey's read back."""
    base = _folder(spark, "products")
    st = B.stations(spark, d)
    for survey, rest in (("2023", 0), ("2024", 1)):
        D.write_product(st.where(F.col("STATION") % 2 == rest), base, "stations", survey)
    return D.load_product(spark, base, "stations", "2024").select("STATION", "LAT_DD", "LON_DD", "TEMP")


def areas_from_file(spark: SparkSession, d: str) -> DataFrame:
    """Area layers written as a vertex table and read back, with the stations inside them."""
    from ..operators.spatial import points_in_polygon
    path = f"{_folder(spark, 'areas')}/areas"
    Q._layers(spark).write.parquet(path)
    inside = points_in_polygon(Q._projected_stations(spark, d), D.load_polygons(spark, path), "STATION")
    return inside.select("STATION", F.col("poly_id").alias("POLY_ID"))


def placenames(spark: SparkSession, d: str) -> DataFrame:
    """Place names (customers) written as a sheet and read back by type and region."""
    path = f"{_folder(spark, 'placenames')}/placenames.csv"
    kind = F.when(F.col("c_custkey") % 2 == 0, "islands").otherwise("mainland")
    names = B.table(spark, d, "customer").select(kind.alias("type"), F.col("c_mktsegment").alias("region"), F.col("c_name").alias("lab"),
                                                 (F.col("c_custkey") / 100.0).alias("x"), (F.col("c_nationkey") / 10.0).alias("y"))
    names.select(*[F.col(f.name).cast(f.dataType) for f in PLACENAMES]).write.options(header="true", nullValue="NA").csv(path)
    return D.placenames(spark, path, "islands", "BUILDING").select("type", "region", "lab", "x", "y")


ORACLE |= {
    "drops_scan": O.ORACLE["csv_drop_roundtrip"],
    "product_snapshot": f"""
WITH sp AS ({O.SPECIMENS}),
a AS (SELECT SPN, count(*) AS CRABS, max(LENGTH) AS LENGTH FROM sp WHERE SPECIMEN_ID <= 3 AND SPN % 7 <> 0 GROUP BY SPN),
b AS (SELECT SPN, count(*) AS CRABS, max(LENGTH) AS LENGTH FROM sp GROUP BY SPN)
SELECT coalesce(b.SPN, a.SPN) AS SPN, CASE WHEN a.SPN IS NULL THEN 'added' WHEN b.SPN IS NULL THEN 'removed' ELSE 'changed' END AS CHANGE,
  a.CRABS AS OLD_CRABS, a.LENGTH AS OLD_LENGTH, b.CRABS AS NEW_CRABS, b.LENGTH AS NEW_LENGTH
FROM a FULL JOIN b ON a.SPN = b.SPN
WHERE a.SPN IS NULL OR b.SPN IS NULL OR a.CRABS IS DISTINCT FROM b.CRABS OR a.LENGTH IS DISTINCT FROM b.LENGTH""",
    "product_reload": f"SELECT STATION, LAT_DD, LON_DD, TEMP FROM ({O.STATIONS}) WHERE STATION % 2 = 1",
    "areas_from_file": O.ORACLE["points_in_polygon"],
    "placenames": """
SELECT 'islands' AS type, c_mktsegment AS region, c_name AS lab, c_custkey / 100.0::DOUBLE AS x, c_nationkey / 10.0::DOUBLE AS y
FROM customer WHERE c_custkey % 2 = 0 AND c_mktsegment = 'BUILDING'""",
}


# ---------------------------------------------------------------- quality

def violations(spark: SparkSession, d: str) -> DataFrame:
    """Q1-Q21: every violation of every rule with its specimen, from one scan."""
    from ..operators.quality import all_violations
    return all_violations(Q._specimen_table(spark, d), keys=["SPN", "SPECIMEN_ID", "PART", "SPECIES_CODE", "SEX", "LENGTH"])


ORACLE["violations"] = f"WITH {O.SPECIMEN_TABLE}\n" + "\nUNION ALL\n".join(
    f"SELECT {O.q(r)} AS RULE_ID, SPN, SPECIMEN_ID, PART, SPECIES_CODE, SEX, LENGTH FROM stab "
    f"WHERE coalesce({applies or 'true'}, false) AND coalesce({hit}, false)" for r, _, hit, applies in O.QUALITY_RULES)


# ---------------------------------------------------------------- layers

TRAWL_VESSEL = K.TRAWL_VESSELS[0]


def _trawl(df: DataFrame) -> DataFrame:
    return df.withColumns({"VESSEL": F.lit(TRAWL_VESSEL), "STATION": F.col("STATION").cast("string")})


def _cpue(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from ..operators import catch as C
    flags = C.maturity_flags("SPECIES_CODE", "SEX", "LENGTH", "CLUTCH_SIZE", K.RED_KING_CRAB, K.MATURE_MALE_MM, K.LEGAL_MALE_MM)
    trawl = _trawl(Q._station_classes(spark, d, flags, "MAT_SEX")).withColumn("COUNT", fix(F.coalesce("__pos", F.lit(0.0)), 4))
    return Q.zero_filled_catch(spark, d), trawl


def _layers(spark: SparkSession, d: str) -> dict:
    """The map tables of the bound surveys."""
    pot, trawl = _cpue(spark, d)
    pots = Q._specimen_table(spark, d).join(B.lift_ids(spark, d).select("SPN", "POT_ID"), "SPN")
    trawls = _trawl(Q._trawl_specimens(spark, d))
    return P.layers(pot, trawl, Q.pot_bycatch(spark, d), _trawl(Q.crab_bycatch(spark, d)), _trawl(Q.station_species_weights(spark, d)),
                    pot_specimens=pots, trawl_specimens=trawls)


def bycatch_layer(spark: SparkSession, d: str) -> DataFrame:
    """Bycatch of pots and trawls by species, one row per position and species."""
    out = _layers(spark, d)["bycatch_layer"]
    return out.select("GEAR", "VESSEL", "STATION", "LAT_DD", "LON_DD", "X", "Y", "CATEGORY", "LABEL", "VALUE", "IS_ZERO", "UNIT")


def shell_layer(spark: SparkSession, d: str) -> DataFrame:
    """Mature crab by sex and shell condition, of pots and trawls, zero-filled over the stations."""
    out = _layers(spark, d)["shell_layer"]
    return out.select("GEAR", "VESSEL", "STATION", "LAT_DD", "LON_DD", "X", "Y", "MAT_SEX_SC", fix("COUNT", 4).alias("COUNT"))


# Species drawn over the temperature.
OVER_TEMPERATURE = ["MaleTanner", "FemaleTanner", "PacificCod"]


def bycatch_temperature(spark: SparkSession, d: str) -> DataFrame:
    """K6: bycatch over bottom temperature: Tanner crab and cod with the kriged temperature of their 5 km cell."""
    by = bycatch_layer(spark, d).where(F.col("CATEGORY").isin(OVER_TEMPERATURE))
    cell = F.floor(F.col("X") / Q.COARSE_RES_M) * F.lit(1 << 32) + F.floor(F.col("Y") / Q.COARSE_RES_M)
    t = Q._surface(spark, d, Q.COARSE_RES_M).select("CELL", "PRED")
    return by.withColumn("CELL", cell).join(t, "CELL", "left").select(
        "GEAR", "VESSEL", "STATION", "LAT_DD", "LON_DD", "CATEGORY", "VALUE", fix("PRED", 3).alias("TEMPERATURE"), temp_band("PRED").alias("BAND"))


# The two surveys of the comparison: every second station each.
SURVEYS = {"2023": "STATION % 2 = 0", "2024": "STATION % 2 = 1"}


def temp_surveys(spark: SparkSession, d: str) -> DataFrame:
    """The temperature grids of two surveys on one grid of 5 km cells, with their joint range."""
    from ..operators.layers import joint_range
    grids = [cut_lineage(Q._surface(spark, d, Q.COARSE_RES_M, where).select(F.lit(s).alias("SURVEY"), "CELL", fix("PRED", 3).alias("TEMPERATURE")))
             for s, where in SURVEYS.items()]
    # one row, joined by a constant key
    joint = joint_range(grids, "TEMPERATURE").select(F.lit(1).alias("__one"), F.col("MIN").alias("T_MIN"), F.col("MAX").alias("T_MAX"))
    both = grids[0].unionByName(grids[1]).withColumn("__one", F.lit(1))
    return both.join(F.broadcast(joint), "__one", "left").select("SURVEY", "CELL", "TEMPERATURE", "T_MIN", "T_MAX")


def station_counts(spark: SparkSession, d: str) -> DataFrame:
    """Expanded fish weight and count per station and bycatch label."""
    from ..operators import fish as FI
    t = FI.station_totals(Q._fish_catch(spark, d), ["STATION"])
    return t.select("STATION", "SPP_LABS", fix("WEIGHT", 6).alias("WEIGHT"), fix("COUNT", 4).alias("COUNT"))


_POT_COLUMNS = [c for c in K.BYCATCH_LABELS if c in [*K.SPP_SEX_CATEGORIES, *K.SEX_SUMS, "PacificCod"]]
_CRAB_COLUMNS = [*K.SPP_SEX_CATEGORIES, *K.SEX_SUMS]


def _bycatch_sql() -> str:
    from ..functions.geo import ALASKA_ALBERS as A
    x, y = A.forward_sql("LON_DD", "LAT_DD")
    trawl = ", ".join(f"{'c' if c in _CRAB_COLUMNS else 'f'}.{c}::DOUBLE AS {c}" for c in K.BYCATCH_LABELS)
    pot = ", ".join(f"{c}::DOUBLE AS {c}" if c in _POT_COLUMNS else "0.0::DOUBLE AS RockSole" if c == "RockSole" else f"NULL::DOUBLE AS {c}" for c in K.BYCATCH_LABELS)
    long = "\n UNION ALL ".join(f"SELECT VESSEL, STATION, LAT_DD, LON_DD, '{c}' AS CATEGORY, {O.q(label)} AS LABEL, {c} AS VALUE, "
                               f"'{'count' if c in K.CRAB_LAYERS else 'kg'}' AS UNIT FROM u" for c, label in K.BYCATCH_LABELS.items())
    return f"""
WITH trawl AS (SELECT '{TRAWL_VESSEL}' AS VESSEL, CAST(f.STATION AS VARCHAR) AS STATION, f.LAT_DD, f.LON_DD, {trawl}
  FROM ({O.ORACLE['station_species_weights']}) f LEFT JOIN ({O.ORACLE['crab_bycatch']}) c ON c.STATION = f.STATION),
pot AS (SELECT VESSEL, POT_ID AS STATION, LAT_DD, LON_DD, {pot} FROM ({O.ORACLE['pot_bycatch']}) WHERE length(POT_ID) <= {K.MAX_STATION_CODE_LEN}),
u AS (SELECT * FROM trawl UNION ALL SELECT * FROM pot),
long AS ({long})
SELECT {O._GEAR} AS GEAR, VESSEL, STATION, LAT_DD, LON_DD, {O.fx(x, 2)} AS X, {O.fx(y, 2)} AS Y, CATEGORY, LABEL, VALUE, VALUE = 0 AS IS_ZERO, UNIT FROM long"""


ORACLE["bycatch_layer"] = _bycatch_sql()
ORACLE["bycatch_temperature"] = f"""
SELECT GEAR, VESSEL, STATION, LAT_DD, LON_DD, CATEGORY, VALUE, {O.fx('PRED', 3)} AS TEMPERATURE, {O._band_sql('PRED')} AS BAND
FROM ({_bycatch_sql()}) b LEFT JOIN ({O._surface_sql(5 * K.GRID_RES_M)}) t
  ON t.CELL = CAST(floor(b.X / 5000.0::DOUBLE) AS BIGINT) * 4294967296 + CAST(floor(b.Y / 5000.0::DOUBLE) AS BIGINT)
WHERE CATEGORY IN ({O.in_list(OVER_TEMPERATURE)})"""

_SHELL = "CASE " + " ".join(
    f"WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND {who} AND SHELL_CONDITION = {c} THEN '{label} SC{c}'"
    for label, who in (("Mature male", f"SEX = 1 AND LENGTH >= {K.MATURE_MALE_MM}"), ("Mature female", "SEX = 2 AND CLUTCH_SIZE >= 1")) for c in (1, 2, 3)) + " END"
ORACLE["shell_layer"] = f"""
WITH {O.SPECIMEN_TABLE},
units AS (SELECT DISTINCT GEAR, VESSEL, STATION, LAT_DD, LON_DD, X, Y FROM ({O.ORACLE['map_layer']}) WHERE CATEGORY IN ({O.in_list(K.MATURITY_TOTAL_CATEGORIES)})),
spec AS (SELECT s.VESSEL, l.POT_ID AS STATION, {_SHELL} AS MAT_SEX_SC, SAMPLING_FACTOR AS f FROM stab s JOIN lifts l ON l.SPN = s.SPN
           WHERE length(l.POT_ID) <= {K.MAX_STATION_CODE_LEN}
         UNION ALL SELECT '{TRAWL_VESSEL}', CAST(STATION_KEY AS VARCHAR), {_SHELL}, 1.0::DOUBLE FROM ({O.SPECIMENS})),
pos AS (SELECT VESSEL, STATION, MAT_SEX_SC, sum(f) AS n FROM spec WHERE MAT_SEX_SC IS NOT NULL GROUP BY ALL)
SELECT u.GEAR, u.VESSEL, u.STATION, u.LAT_DD, u.LON_DD, u.X, u.Y, c.MAT_SEX_SC, {O.fx('coalesce(p.n, 0)', 4)} AS COUNT
FROM units u CROSS JOIN (VALUES {', '.join(f"('{c}')" for c in K.SHELL_CATEGORIES)}) c(MAT_SEX_SC)
LEFT JOIN pos p ON p.VESSEL IS NOT DISTINCT FROM u.VESSEL AND p.STATION = u.STATION AND p.MAT_SEX_SC = c.MAT_SEX_SC"""
ORACLE["temp_surveys"] = """
WITH grids AS (""" + "\n UNION ALL ".join(
    f"SELECT '{s}' AS SURVEY, CELL, {O.fx('PRED', 3)} AS TEMPERATURE FROM ({O._surface_sql(5 * K.GRID_RES_M, where)})" for s, where in SURVEYS.items()) + """)
SELECT *, min(TEMPERATURE) OVER () AS T_MIN, max(TEMPERATURE) OVER () AS T_MAX FROM grids"""
ORACLE["station_counts"] = f"""
WITH {O.FISH_CTES}
SELECT STATION, {O._FISH_LAB} AS SPP_LABS, {O.fx('CASE WHEN count(CALC_WEIGHT) = count(*) THEN sum(CALC_WEIGHT) END', 6)} AS WEIGHT,
  {O.fx('CASE WHEN count(CALC_COUNT) = count(*) THEN sum(CALC_COUNT) END', 4)} AS COUNT
FROM catch WHERE SPECIES_NAME IS NULL OR SPECIES_NAME NOT IN ({O.in_list(K.NON_FISH_NAMES)}) GROUP BY ALL"""

QUERIES |= {f.__name__: f for f in (drops_scan, product_snapshot, product_reload, areas_from_file, placenames, violations, bycatch_layer, shell_layer,
                                    bycatch_temperature, temp_surveys, station_counts)}
