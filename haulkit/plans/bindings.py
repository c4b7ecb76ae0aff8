"""Role bindings: survey tables derived from the benchmark tables by column rules.

The benchmark data is TPC-H shaped, so each survey role is bound to a table:

* unit (pot lift)  = ``orders``   (lift id = o_orderkey)
* specimen (crab)  = ``lineitem`` (lift id = l_orderkey)
* species lookup   = ``part``
* long biometrics  = ``events``
* station (trawl)  = ``supplier``

Every rule is a column expression, so the derived frames stay lazy and every
query's work grows with the tables.  The same rules are written in SQL in
`oracle.py`; keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S

TZ = "America/Anchorage"
POT_VESSEL_CODES = {162: "Marahute", 134: "Provider"}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """An input table."""
    return spark.read.parquet(f"{d}/{name}.parquet")


# Column rules are written as SQL expressions (`selectExpr`): one JVM call per
# column instead of one per operator when the plan is built.
POT_ID_SQL = ("CASE WHEN o_orderkey % 50 = 0 THEN concat('CAM', CAST(o_orderkey % 7 AS STRING)) "
              "ELSE concat(o_orderstatus, CAST(o_orderkey % 100 AS STRING)) END")
VESSEL_CODE_SQL = "CASE o_custkey % 3 WHEN 0 THEN 162 WHEN 1 THEN 134 END"


def raw_lifts(spark: SparkSession, d: str) -> DataFrame:
    """Potlift sheet as typed by the crew: HHMM ints, m/d/Y strings, deg + min."""
    return raw_lifts_from(table(spark, d, "orders"))


def raw_lifts_from(orders: DataFrame) -> DataFrame:
    """The lift rules applied to (a selection of) the orders rows."""
    return orders.selectExpr(
        "o_orderkey AS SPN",
        f"{VESSEL_CODE_SQL} AS VESSEL_CODE",
        f"{POT_ID_SQL} AS POT_ID",
        "concat('X', CAST(o_custkey AS STRING)) AS BUOY",
        "CAST(54 + o_orderkey % 4 AS INT) AS LAT_DEG",
        "(o_orderkey * 7) % 600 / 10.0D AS LAT_MIN",
        "CAST(159 + o_custkey % 6 AS INT) AS LON_DEG",
        "(o_custkey * 13) % 600 / 10.0D AS LON_MIN",
        "date_format(o_orderdate, 'M/d/yyyy') AS DATE_SET",
        "CAST(CAST(floor(o_totalprice) AS BIGINT) % 2400 AS INT) AS TIME_SET",
        "date_format(date_add(to_date(o_orderdate), CAST(1 + o_orderkey % 3 AS INT)), 'M/d/yyyy') AS DATE_HAUL",
        "CAST(CAST(floor(o_totalprice * 100) AS BIGINT) % 2400 AS INT) AS TIME_HAUL",
        "o_orderpriority AS GEAR_NOTE")


def lift_ids(spark: SparkSession, d: str) -> DataFrame:
    """Lift identity only (SPN, decoded VESSEL, POT_ID, BUOY), without time
    parsing; for joins that need the vessel or pot of a lift."""
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS SPN", "CASE o_custkey % 3 WHEN 0 THEN 'Marahute' WHEN 1 THEN 'Provider' END AS VESSEL",
        f"{POT_ID_SQL} AS POT_ID", "concat('X', CAST(o_custkey AS STRING)) AS BUOY")


def lifts(spark: SparkSession, d: str, tz: str = TZ, where=None) -> DataFrame:
    """Clean lift table: decoded vessel, HH:MM times, soak hours, decimal degrees.
    `where` selects orders rows before anything is parsed.

    Two projections: times are parsed once, then the timestamps are built
    from the parsed columns (one nested expression would repeat the parse)."""
    orders = table(spark, d, "orders")
    r = raw_lifts_from(orders if where is None else orders.where(where)).select(
        S.decode_vessel("VESSEL_CODE", POT_VESSEL_CODES).alias("VESSEL"),
        "SPN", "POT_ID", "BUOY",
        F.expr("round((CAST(LAT_DEG AS DOUBLE) + LAT_MIN / 60.0D) * 1.0D * 1000000.0D) / 1000000.0D").alias("LAT_DD"),
        F.expr("round((CAST(LON_DEG AS DOUBLE) + LON_MIN / 60.0D) * -1.0D * 1000000.0D) / 1000000.0D").alias("LON_DD"),
        "DATE_SET", S.hhmm("TIME_SET").alias("TIME_SET"),
        "DATE_HAUL", S.hhmm("TIME_HAUL").alias("TIME_HAUL"))
    ts_set = S.lift_ts("DATE_SET", "TIME_SET", tz)
    ts_haul = S.lift_ts("DATE_HAUL", "TIME_HAUL", tz)
    return r.withColumn("SOAK_TIME", S.soak_hours(ts_set, ts_haul))


def specimens(spark: SparkSession, d: str) -> DataFrame:
    """Crab specimen rows: one lineitem = one measured crab."""
    return specimens_from(table(spark, d, "lineitem"))


SPECIES_OF_PART_SQL = (f"CASE WHEN l_partkey % 5 <= 1 THEN {K.RED_KING_CRAB} WHEN l_partkey % 5 = 2 THEN {K.TANNER_CRAB} "
                       f"WHEN l_partkey % 5 = 3 THEN {K.HAIR_CRAB} ELSE {K.SNOW_CRAB} END")


def specimens_from(li: DataFrame) -> DataFrame:
    """The specimen rules applied to lineitem rows (a batch or a stream)."""
    return li.selectExpr(
        "l_orderkey AS SPN", "l_linenumber AS SPECIMEN_ID", "l_partkey AS PART", "l_suppkey AS STATION_KEY",
        f"{SPECIES_OF_PART_SQL} AS SPECIES_CODE",
        "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 END AS SEX",
        "l_quantity * 4 AS LENGTH",
        "CASE WHEN l_returnflag != 'A' OR l_partkey % 9 = 0 THEN CAST(round(l_discount * 100) AS INT) END AS CLUTCH_SIZE",
        "CAST(round(l_tax * 100) AS INT) % 6 AS SHELL_CONDITION",
        "l_linenumber - 1 AS TOSSED",
        "l_extendedprice AS WEIGHT", "l_linestatus AS LINESTATUS", "l_shipdate AS SHIPDATE",
        # data-quality fields
        "CASE WHEN l_orderkey % 101 = 0 THEN 202301 ELSE 202401 END AS CRUISE",
        "CASE WHEN l_returnflag = 'N' OR l_partkey % 9 = 0 "
        "THEN (l_linenumber + CAST(round(l_discount * 100) AS INT)) % 7 END AS EGG_COLOR",
        "CASE WHEN l_returnflag = 'N' THEN CAST(round(l_tax * 100) AS INT) % 7 END AS EGG_CONDITION",
        "CASE WHEN l_partkey % 13 = 0 THEN l_quantity * 3 END AS WIDTH",
        "CASE WHEN l_orderkey % 5 = 0 THEN CAST(l_partkey % 12 AS INT) END AS DISEASE_CODE",
        "CASE WHEN l_orderkey % 3 = 0 THEN l_tax * 100 END AS DISEASE_DORSAL",
        "CASE WHEN l_orderkey % 4 = 0 THEN l_discount * 100 END AS DISEASE_VENTRAL",
        "CASE WHEN l_orderkey % 6 = 0 THEN l_quantity END AS DISEASE_LEGS")


def stations(spark: SparkSession, d: str) -> DataFrame:
    """Trawl hauls: one supplier = one station, position inside the map window,
    bottom temperature from the account balance; unsampled stations dropped (B20)."""
    s = table(spark, d, "supplier")
    return (s.where("s_nationkey % 7 != 0").selectExpr(
        "s_suppkey AS STATION",
        "round((54.5D + (s_suppkey * 37) % 400 / 100.0D) * 1000000.0D) / 1000000.0D AS LAT_DD",
        "round((-164.8D + (s_suppkey * 53) % 580 / 100.0D) * 1000000.0D) / 1000000.0D AS LON_DD",
        "s_acctbal / 1000.0D AS TEMP"))


# Groundfish species bound to part types (code, name); FIXED binding values.
FISH_SPECIES = [("ECONOMY", 10210, "yellowfin sole"), ("LARGE", 10110, "arrowtooth flounder"),
                ("MEDIUM", 21722, "Pacific cod (adult)"), ("PROMO", 10001, "flatfish unid."),
                ("SMALL", 21740, "walleye pollock"), ("STANDARD", 10285, "starry flounder")]


def fish_samples(spark: SparkSession, d: str) -> DataFrame:
    """Groundfish sample values: lineitem weights/counts with the species of
    their part.  Large parts are crab (removed later, B8); every 11th part has
    no species code (a weight correction, dropped by B9)."""
    return fish_rows(spark, d).join(fish_species(spark, d), "PART", "left")


def fish_species(spark: SparkSession, d: str) -> DataFrame:
    """(PART, SPECIES_CODE)."""
    p = table(spark, d, "part")
    code = F.when(F.col("p_partkey") % 11 == 0, F.lit(None).cast("int"))
    for t, c, _ in FISH_SPECIES:
        code = code.when(F.col("p_type") == t, F.when(F.col("p_size") > 45, K.TANNER_CRAB).otherwise(c))
    code = code.otherwise(F.lit(None).cast("int"))
    return p.select(F.col("p_partkey").alias("PART"), code.alias("SPECIES_CODE"))


def fish_rows(spark: SparkSession, d: str) -> DataFrame:
    """The sample values without their species."""
    w = F.when((F.col("l_orderkey") % 997 == 0) & (F.col("l_linenumber") == 1), F.lit(None).cast("double")) \
         .otherwise(F.col("l_extendedprice") / 1000.0)
    # baskets 1-3 counted, basket 4 counted as 0 (a weight with no fish), rest not counted
    ln = F.col("l_linenumber")
    cnt = F.when(ln <= 3, F.col("l_quantity").cast("int")).when(ln == 4, F.lit(0))
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("STATION"), F.col("l_orderkey").alias("CATCH_SAMPLE_ID"),
                     F.col("l_linenumber").alias("SAMPLE_VALUE_ID"), F.col("l_partkey").alias("PART"),
                     w.alias("SAMPLE_VALUE_WEIGHT"), cnt.alias("SAMPLE_VALUE_COUNT"))


def fish_names(spark: SparkSession) -> DataFrame:
    """Species-name lookup (C21): a fixed, bounded table -> broadcast."""
    return spark.createDataFrame([(c, n) for _, c, n in FISH_SPECIES], "SPECIES_CODE int, SPECIES_NAME string")

