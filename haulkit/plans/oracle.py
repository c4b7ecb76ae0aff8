"""DuckDB SQL for each registered query (the independent correctness oracle).

Written the way the survey scripts compute (row-level factors, union of two
labelings, cross product of categories), so it checks the Spark plans'
algebraic rewrites.  Fragments mirror the role rules in `bindings.py`.
Literals are cast to DOUBLE (DuckDB reads 10.0 as DECIMAL) and casts from
double round explicitly (DuckDB casts round, Spark's truncate).
"""

from __future__ import annotations

from .. import constants as K
from .bindings import FISH_SPECIES

TZ = "America/Anchorage"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(vals) -> str:
    return ", ".join(q(v) if isinstance(v, str) else repr(v) for v in vals)


def fx(expr: str, d: int = 4) -> str:
    """Same rounding as haulkit.functions.scalar.fix."""
    m = f"{float(10 ** d)!r}::DOUBLE"
    return f"(round(CAST({expr} AS DOUBLE) * {m}) / {m})"


def hhmm(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    p = f"lpad({s}, 4, '0')"
    return (f"(CASE WHEN regexp_full_match({s}, '[0-9]{{1,4}}') "
            f"AND TRY_CAST(substr({p}, 1, 2) AS INTEGER) <= 23 "
            f"AND TRY_CAST(substr({p}, 3, 2) AS INTEGER) <= 59 "
            f"THEN substr({p}, 1, 2) || ':' || substr({p}, 3, 2) END)")


def local_epoch(date_expr: str, time_hhmm: str, tz: str = TZ) -> str:
    """Seconds since epoch of a wall-clock date + 'HH:MM' in `tz`; a repeated
    (fall-back) hour resolves to the earlier offset, as java.time does."""
    ts = f"(CAST({date_expr} AS DATE) + CAST({time_hhmm} AS TIME))"
    return (f"least(epoch(timezone({q(tz)}, {ts})), "
            f"epoch(timezone({q(tz)}, {ts} - INTERVAL 1 HOUR)) + 3600)")


def species_of_part(pk: str) -> str:
    return (f"(CASE WHEN {pk} % 5 <= 1 THEN {K.RED_KING_CRAB} WHEN {pk} % 5 = 2 THEN {K.TANNER_CRAB} "
            f"WHEN {pk} % 5 = 3 THEN {K.HAIR_CRAB} ELSE {K.SNOW_CRAB} END)")


RAW_LIFTS = """
  SELECT o_orderkey AS SPN,
         CASE o_custkey % 3 WHEN 0 THEN 162 WHEN 1 THEN 134 END AS VESSEL_CODE,
         CASE WHEN o_orderkey % 50 = 0 THEN 'CAM' || CAST(o_orderkey % 7 AS VARCHAR)
              ELSE o_orderstatus || CAST(o_orderkey % 100 AS VARCHAR) END AS POT_ID,
         'X' || CAST(o_custkey AS VARCHAR) AS BUOY,
         CAST(54 + o_orderkey % 4 AS INTEGER) AS LAT_DEG,
         ((o_orderkey * 7) % 600) / 10.0::DOUBLE AS LAT_MIN,
         CAST(159 + o_custkey % 6 AS INTEGER) AS LON_DEG,
         ((o_custkey * 13) % 600) / 10.0::DOUBLE AS LON_MIN,
         CAST(o_orderdate AS DATE) AS D_SET,
         strftime(o_orderdate, '%-m/%-d/%Y') AS DATE_SET,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 2400 AS INTEGER) AS TIME_SET,
         CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 3 AS INTEGER) AS D_HAUL,
         strftime(CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 3 AS INTEGER), '%-m/%-d/%Y') AS DATE_HAUL,
         CAST(CAST(floor(o_totalprice * 100) AS BIGINT) % 2400 AS INTEGER) AS TIME_HAUL,
         o_orderpriority AS GEAR_NOTE
  FROM orders"""

LIFTS = f"""
  SELECT CASE VESSEL_CODE WHEN 162 THEN 'Marahute' WHEN 134 THEN 'Provider' END AS VESSEL,
         SPN, POT_ID, BUOY,
         {fx('LAT_DEG + LAT_MIN / 60.0::DOUBLE', 6)} AS LAT_DD,
         {fx('(LON_DEG + LON_MIN / 60.0::DOUBLE) * -1.0::DOUBLE', 6)} AS LON_DD,
         DATE_SET, {hhmm('TIME_SET')} AS TIME_SET, DATE_HAUL, {hhmm('TIME_HAUL')} AS TIME_HAUL,
         ({local_epoch('D_HAUL', hhmm('TIME_HAUL'))} - {local_epoch('D_SET', hhmm('TIME_SET'))}) / 3600.0::DOUBLE AS SOAK
  FROM raw_lifts"""

SPECIMENS = f"""
  SELECT l_orderkey AS SPN, l_linenumber AS SPECIMEN_ID, l_partkey AS PART, l_suppkey AS STATION_KEY,
         {species_of_part('l_partkey')} AS SPECIES_CODE,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS SEX,
         l_quantity * 4 AS LENGTH,
         CASE WHEN l_returnflag <> 'A' OR l_partkey % 9 = 0 THEN CAST(round(l_discount * 100) AS INTEGER) END AS CLUTCH_SIZE,
         CAST(round(l_tax * 100) AS INTEGER) % 6 AS SHELL_CONDITION,
         l_linenumber - 1 AS TOSSED,
         l_extendedprice AS WEIGHT, l_linestatus AS LINESTATUS, l_shipdate AS SHIPDATE,
         CASE WHEN l_orderkey % 101 = 0 THEN 202301 ELSE 202401 END AS CRUISE,
         CASE WHEN l_returnflag = 'N' OR l_partkey % 9 = 0 THEN (l_linenumber + CAST(round(l_discount * 100) AS INTEGER)) % 7 END AS EGG_COLOR,
         CASE WHEN l_returnflag = 'N' THEN CAST(round(l_tax * 100) AS INTEGER) % 7 END AS EGG_CONDITION,
         CASE WHEN l_partkey % 13 = 0 THEN l_quantity * 3 END AS WIDTH,
         CASE WHEN l_orderkey % 5 = 0 THEN CAST(l_partkey % 12 AS INTEGER) END AS DISEASE_CODE,
         CASE WHEN l_orderkey % 3 = 0 THEN l_tax * 100 END AS DISEASE_DORSAL,
         CASE WHEN l_orderkey % 4 = 0 THEN l_discount * 100 END AS DISEASE_VENTRAL,
         CASE WHEN l_orderkey % 6 = 0 THEN l_quantity END AS DISEASE_LEGS
  FROM lineitem"""

STATIONS = f"""
  SELECT STATION, LAT_DD, LON_DD, TEMP FROM (
    SELECT s_suppkey AS STATION,
           {fx('54.5::DOUBLE + ((s_suppkey * 37) % 400) / 100.0::DOUBLE', 6)} AS LAT_DD,
           {fx('-164.8::DOUBLE + ((s_suppkey * 53) % 580) / 100.0::DOUBLE', 6)} AS LON_DD,
           s_acctbal / 1000.0::DOUBLE AS TEMP,
           CASE WHEN s_nationkey % 7 = 0 THEN 0 ELSE 1 END AS SAMPLED
    FROM supplier) WHERE SAMPLED = 1"""

FISH_SAMPLES = ("""
  SELECT l.l_suppkey AS STATION, l.l_orderkey AS CATCH_SAMPLE_ID, l.l_linenumber AS SAMPLE_VALUE_ID,
         l.l_partkey AS PART,
         CASE WHEN l.l_orderkey % 997 = 0 AND l.l_linenumber = 1 THEN NULL ELSE l.l_extendedprice / 1000.0::DOUBLE END AS SAMPLE_VALUE_WEIGHT,
         CASE WHEN l.l_linenumber <= 3 THEN CAST(trunc(l.l_quantity) AS INTEGER) WHEN l.l_linenumber = 4 THEN 0 END AS SAMPLE_VALUE_COUNT,
         sp.SPECIES_CODE
  FROM lineitem l LEFT JOIN (
    SELECT p_partkey AS PART, CASE WHEN p_partkey % 11 = 0 THEN NULL """
    + " ".join(f"WHEN p_type = {q(t)} THEN (CASE WHEN p_size > 45 THEN {K.TANNER_CRAB} ELSE {c} END)" for t, c, _ in FISH_SPECIES)
    + """ END AS SPECIES_CODE FROM part) sp ON sp.PART = l.l_partkey""")

FISH_NAMES = "(SELECT * FROM (VALUES " + ", ".join(f"({c}, {q(n)})" for _, c, n in FISH_SPECIES) + ") t(SPECIES_CODE, SPECIES_NAME))"


def categories_values(name: str, cats) -> str:
    return f"(SELECT * FROM (VALUES {', '.join('(' + q(c) + ')' for c in cats)}) t({name}))"


MATURITY_CASE = f"""CASE WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = 1 AND LENGTH >= {K.MATURE_MALE_MM} THEN 'Mature male'
       WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = 1 AND LENGTH < {K.MATURE_MALE_MM} THEN 'Immature male'
       WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = 2 AND CLUTCH_SIZE >= 1 THEN 'Mature female'
       WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = 2 AND CLUTCH_SIZE = 0 THEN 'Immature female' END"""

LEGAL_CASE = f"""CASE WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = 1 AND LENGTH >= {K.LEGAL_MALE_MM} THEN 'Legal male'
       WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = 1 AND LENGTH < {K.LEGAL_MALE_MM} THEN 'Sublegal male' END"""

# Row-level sampling factor as the reference computes it: KEPT = rows of the
# (lift, species, sex) sample group, joined back to every row.
SF_ROWS = """
  SELECT *, (KEPT + TOSSED)::DOUBLE / KEPT AS SAMPLING_FACTOR
  FROM (SELECT *, count(*) OVER (PARTITION BY SPN, SPECIES_CODE, SEX) AS KEPT FROM specimens)"""

BASE_CTES = f"raw_lifts AS ({RAW_LIFTS}), lifts AS ({LIFTS}), specimens AS ({SPECIMENS})"


ZERO_FILLED_CATCH = f"""
WITH {BASE_CTES},
sf AS ({SF_ROWS}),
mat_spec AS (
  SELECT SPN, SAMPLING_FACTOR, {MATURITY_CASE} AS MAT_SEX FROM sf
  UNION ALL
  SELECT * FROM (SELECT SPN, SAMPLING_FACTOR, {LEGAL_CASE} AS MAT_SEX FROM sf) WHERE MAT_SEX IS NOT NULL),
pos AS (SELECT SPN, MAT_SEX, sum(SAMPLING_FACTOR) AS C FROM mat_spec GROUP BY SPN, MAT_SEX),
cats AS {categories_values('MAT_SEX', K.MAT_SEX_CATEGORIES)}
SELECT l.VESSEL, l.SPN, l.POT_ID, l.BUOY, l.LAT_DD, l.LON_DD, l.DATE_SET, l.TIME_SET, l.DATE_HAUL,
       l.TIME_HAUL, {fx('l.SOAK')} AS SOAK_TIME, c.MAT_SEX,
       coalesce({fx('p.C')}, 0.0::DOUBLE) AS COUNT,
       {fx(fx('p.C') + ' / nullif(l.SOAK, 0)')} AS CATCH_PER_HOUR
FROM lifts l CROSS JOIN cats c
LEFT JOIN pos p ON p.SPN = l.SPN AND p.MAT_SEX = c.MAT_SEX
"""

ORACLE = {
    "zero_filled_catch": ZERO_FILLED_CATCH,
}


ORACLE["sampling_factor"] = f"""
WITH specimens AS ({SPECIMENS}), sf AS ({SF_ROWS})
SELECT SPN, SPECIMEN_ID, PART, SPECIES_CODE, SEX, TOSSED, KEPT, {fx('SAMPLING_FACTOR', 6)} AS SAMPLING_FACTOR
FROM sf"""

ORACLE["tossed_totals"] = """
WITH v AS (SELECT l_orderkey AS HAUL_ID, l_suppkey % 10 AS CATCH_SAMPLE_ID, l_linestatus AS RECORDING_DEVICE,
                  CASE WHEN l_linenumber <> 1 THEN l_linenumber - 1 END AS COUNT FROM lineitem)
SELECT HAUL_ID, CATCH_SAMPLE_ID, RECORDING_DEVICE, CAST(sum(coalesce(COUNT, 0)) AS BIGINT) AS TOSSED
FROM v GROUP BY HAUL_ID, CATCH_SAMPLE_ID, RECORDING_DEVICE"""

ORACLE["expanded_catch_reconcile"] = f"""
WITH {BASE_CTES}, sf AS ({SF_ROWS}),
est AS (SELECT SPN, SPECIES_CODE, {fx('sum(SAMPLING_FACTOR)')} AS NUMBER_CRAB FROM sf GROUP BY SPN, SPECIES_CODE),
rep AS (SELECT SPN, SPECIES_CODE, count(*) AS N_ENTRIES FROM specimens WHERE LINESTATUS = 'O' GROUP BY SPN, SPECIES_CODE),
repl AS (SELECT r.SPN, r.SPECIES_CODE, r.N_ENTRIES, l.VESSEL, l.POT_ID FROM rep r LEFT JOIN lifts l ON l.SPN = r.SPN)
SELECT r.SPN, r.SPECIES_CODE, e.NUMBER_CRAB, r.N_ENTRIES, r.VESSEL, r.POT_ID, e.NUMBER_CRAB <> r.N_ENTRIES AS MISMATCH
FROM est e RIGHT JOIN repl r ON e.SPN = r.SPN AND e.SPECIES_CODE = r.SPECIES_CODE
WHERE e.NUMBER_CRAB IS NOT NULL AND r.N_ENTRIES IS NOT NULL AND r.VESSEL IS NOT NULL AND r.POT_ID IS NOT NULL"""

ORACLE["strict_sum"] = f"""
WITH x AS (SELECT l_orderkey AS SPN, nullif(l_tax, 0.0::DOUBLE) AS X FROM lineitem)
SELECT SPN, count(*) AS N, count(*) FILTER (WHERE X IS NULL) AS N_NULL,
       {fx('CASE WHEN count(X) = count(*) THEN sum(X) END')} AS STRICT_SUM,
       {fx('sum(X)')} AS LENIENT_SUM,
       CASE WHEN count(X) = count(*) THEN min(X) END AS STRICT_MIN,
       CASE WHEN count(X) = count(*) THEN max(X) END AS STRICT_MAX,
       {fx('CASE WHEN count(X) = count(*) THEN avg(X) END', 6)} AS STRICT_AVG
FROM x GROUP BY SPN"""

ORACLE["null_safe_left"] = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS CUSTKEY FROM orders),
c AS (SELECT nullif(c_custkey, 0) AS CUSTKEY, c_name, c_mktsegment FROM customer)
SELECT o.CUSTKEY, o.o_orderkey, c.c_name, c.c_mktsegment
FROM o LEFT JOIN c ON o.CUSTKEY IS NOT DISTINCT FROM c.CUSTKEY"""

ORACLE["not_in_keep_null"] = """
SELECT p_partkey, NAME, p_type FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS NAME, p_type FROM part)
WHERE NAME IS NULL OR NAME NOT IN ('red plate', 'small widget', 'hot ring')"""

ORACLE["valid_units"] = f"""
WITH raw_lifts AS ({RAW_LIFTS}),
r AS (SELECT SPN, VESSEL_CODE, POT_ID,
             CASE WHEN SPN % 17 = 0 THEN '' ELSE DATE_HAUL END AS DATE_HAUL,
             CASE WHEN SPN % 13 <> 0 THEN TIME_HAUL END AS TIME_HAUL,
             CASE substr(GEAR_NOTE, 1, 1) WHEN '1' THEN '44' WHEN '2' THEN '42' WHEN '3' THEN NULL
                  WHEN '4' THEN '' ELSE '7' END AS G0
      FROM raw_lifts),
g AS (SELECT *, CASE WHEN SPN % 2 = 1 THEN (CASE WHEN G0 = '42' THEN '42' WHEN G0 IS NOT NULL THEN '' END)
                     ELSE G0 END AS GEAR_CODE FROM r)
SELECT SPN, VESSEL_CODE, POT_ID, GEAR_CODE, DATE_HAUL, {hhmm('TIME_HAUL')} AS TIME_HAUL FROM g
WHERE TIME_HAUL IS NOT NULL AND CAST(TIME_HAUL AS VARCHAR) <> '' AND DATE_HAUL IS NOT NULL AND DATE_HAUL <> ''
  AND SPN <> 215
  AND ((VESSEL_CODE IS NOT NULL AND GEAR_CODE IS NULL) OR GEAR_CODE = '44' OR GEAR_CODE = '')
  AND length(POT_ID) <= 3"""


def _wall_epoch(date_expr: str, time_hhmm: str) -> str:
    return f"epoch(CAST({date_expr} AS DATE) + CAST({time_hhmm} AS TIME))"


ORACLE["soak_hours"] = f"""
WITH raw_lifts AS ({RAW_LIFTS})
SELECT SPN, DATE_SET, {hhmm('TIME_SET')} AS TIME_SET, DATE_HAUL, {hhmm('TIME_HAUL')} AS TIME_HAUL,
       {fx('LAT_DEG + LAT_MIN / 60.0::DOUBLE', 6)} AS LAT_DD,
       {fx('(LON_DEG + LON_MIN / 60.0::DOUBLE) * -1.0::DOUBLE', 6)} AS LON_DD,
       {fx('(' + local_epoch('D_HAUL', hhmm('TIME_HAUL')) + ' - ' + local_epoch('D_SET', hhmm('TIME_SET')) + ') / 3600.0::DOUBLE')} AS SOAK_TIME,
       {fx('(' + _wall_epoch('D_HAUL', hhmm('TIME_HAUL')) + ' - ' + _wall_epoch('D_SET', hhmm('TIME_SET')) + ') / 3600.0::DOUBLE')} AS SOAK_WALL
FROM raw_lifts"""

ORACLE["hhmm"] = f"""
WITH e AS (SELECT event_id AS EVENT_ID,
                  CASE WHEN event_id % 11 <> 0 THEN CAST(CAST(floor(value * 10) AS BIGINT) % 2500 AS INTEGER) END AS RAW
           FROM events)
SELECT EVENT_ID, RAW, {hhmm('RAW')} AS HHMM FROM e"""

_BIO = ["click", "error", "purchase", "signup", "view"]
ORACLE["biometrics_wide"] = (
    "SELECT user_id AS USER_ID, CAST(ts AS DATE) AS DAY, "
    + ", ".join(f"CASE WHEN count(*) FILTER (WHERE event_type = {q(n)}) = 1 "
                f"THEN max(value) FILTER (WHERE event_type = {q(n)}) END AS {n}" for n in _BIO)
    + ", CAST(" + " + ".join(f"(CASE WHEN count(*) FILTER (WHERE event_type = {q(n)}) > 1 THEN 1 ELSE 0 END)"
                             for n in _BIO)
    + " AS INTEGER) AS N_DUP FROM events GROUP BY user_id, CAST(ts AS DATE)")


# ---------------------------------------------------------------- specimen joins

ORACLE["specimen_join_out"] = f"""
WITH {BASE_CTES}
SELECT s.SPN, s.SPECIMEN_ID, l.VESSEL, l.POT_ID, l.LAT_DD, l.LON_DD, s.SPECIES_CODE,
       p.p_type AS SPECIES_NAME, s.SEX, s.LENGTH
FROM specimens s LEFT JOIN part p ON p.p_partkey = s.PART
LEFT JOIN lifts l ON l.SPN = s.SPN
WHERE NOT (l.LAT_DD IS NULL AND l.LON_DD IS NULL AND s.SPN IS NULL)"""

ORACLE["basket_weight"] = f"""
WITH specimens AS ({SPECIMENS}),
sp AS (SELECT SPN, SPECIES_CODE, SEX, LINESTATUS,
              CASE WHEN SPN % 211 = 0 AND SPECIMEN_ID = 2 THEN NULL ELSE WEIGHT END AS WEIGHT FROM specimens),
tot AS (SELECT SPN, SPECIES_CODE, SEX, {fx('CASE WHEN count(WEIGHT) = count(*) THEN sum(WEIGHT) END', 2)} AS WEIGHT
        FROM sp GROUP BY SPN, SPECIES_CODE, SEX),
attrs AS (SELECT DISTINCT SPN, SPECIES_CODE, SEX, LINESTATUS FROM sp)
SELECT t.SPN, t.SPECIES_CODE, t.SEX, a.LINESTATUS, t.WEIGHT
FROM tot t LEFT JOIN attrs a ON t.SPN = a.SPN AND t.SPECIES_CODE = a.SPECIES_CODE AND t.SEX IS NOT DISTINCT FROM a.SEX"""


# ---------------------------------------------------------------- groundfish

_FLAT = f"SPECIES_CODE IN ({in_list(K.FLATFISH_CODES)})"
_UNID = f"coalesce(SPECIES_NAME = {q(K.UNID_FLATFISH_NAME)}, false)"

FISH_CTES = f"""fs AS ({FISH_SAMPLES}),
f0 AS (SELECT fs.*, n.SPECIES_NAME FROM fs LEFT JOIN {FISH_NAMES} n ON n.SPECIES_CODE = fs.SPECIES_CODE
       WHERE fs.SPECIES_CODE IS NULL OR fs.SPECIES_CODE NOT IN ({in_list(K.CRAB_CODES)})),
f1 AS (SELECT STATION, CATCH_SAMPLE_ID, SAMPLE_VALUE_ID, SAMPLE_VALUE_WEIGHT, SAMPLE_VALUE_COUNT,
              CASE WHEN SPECIES_CODE = 21722 THEN 21720 ELSE SPECIES_CODE END AS SPECIES_CODE,
              CASE WHEN SPECIES_NAME = 'Pacific cod (adult)' THEN 'Pacific cod' ELSE SPECIES_NAME END AS SPECIES_NAME
       FROM f0),
f2 AS (SELECT * FROM f1 WHERE STATION IS NOT NULL AND SPECIES_CODE IS NOT NULL),
st AS (SELECT STATION,
         CASE WHEN count(*) FILTER (WHERE {_FLAT} AND SAMPLE_VALUE_WEIGHT IS NULL) = 0
              THEN coalesce(sum(SAMPLE_VALUE_WEIGHT) FILTER (WHERE {_FLAT}), 0.0::DOUBLE) END AS I,
         CASE WHEN count(*) FILTER (WHERE {_UNID} AND SAMPLE_VALUE_WEIGHT IS NULL) = 0
              THEN coalesce(sum(SAMPLE_VALUE_WEIGHT) FILTER (WHERE {_UNID}), 0.0::DOUBLE) END AS U
       FROM f2 GROUP BY STATION),
f3 AS (SELECT f2.*, CASE WHEN NOT ({_FLAT.replace('SPECIES_CODE', 'f2.SPECIES_CODE')}) THEN 1.0::DOUBLE
                         ELSE (st.I + st.U) / nullif(st.I, 0) END AS SAMPLING_FACTOR
       FROM f2 JOIN st ON st.STATION = f2.STATION WHERE NOT (f2.SPECIES_CODE = {K.UNID_FLATFISH_CODE})),
ind AS (SELECT STATION, CATCH_SAMPLE_ID, SPECIES_CODE, SPECIES_NAME, SAMPLING_FACTOR,
               avg(DISTINCT SAMPLE_VALUE_WEIGHT / nullif(SAMPLE_VALUE_COUNT, 0)) AS IND_WEIGHT
        FROM f3 GROUP BY ALL),
rowc AS (SELECT f3.*, ind.IND_WEIGHT, f3.SAMPLE_VALUE_WEIGHT / ind.IND_WEIGHT AS COUNT
         FROM f3 JOIN ind ON f3.STATION = ind.STATION AND f3.CATCH_SAMPLE_ID = ind.CATCH_SAMPLE_ID
              AND f3.SPECIES_CODE = ind.SPECIES_CODE AND f3.SPECIES_NAME IS NOT DISTINCT FROM ind.SPECIES_NAME
              AND f3.SAMPLING_FACTOR IS NOT DISTINCT FROM ind.SAMPLING_FACTOR),
est AS (SELECT STATION, CATCH_SAMPLE_ID, SPECIES_CODE, SPECIES_NAME, SAMPLING_FACTOR,
               CASE WHEN count(IND_WEIGHT) = count(*) THEN avg(IND_WEIGHT) END AS IND_WEIGHT,
               CASE WHEN count(SAMPLE_VALUE_WEIGHT) = count(*) THEN sum(SAMPLE_VALUE_WEIGHT) END AS WEIGHT,
               CASE WHEN count(COUNT) = count(*) THEN sum(COUNT) END AS COUNT
        FROM rowc GROUP BY ALL),
catch AS (SELECT *, WEIGHT * SAMPLING_FACTOR AS CALC_WEIGHT, COUNT * SAMPLING_FACTOR AS CALC_COUNT FROM est)"""

ORACLE["flatfish_expand"] = f"""
WITH {FISH_CTES}
SELECT STATION, CATCH_SAMPLE_ID, SAMPLE_VALUE_ID, SPECIES_CODE, SPECIES_NAME, SAMPLE_VALUE_WEIGHT,
       {fx('SAMPLING_FACTOR', 6)} AS SAMPLING_FACTOR, {fx('SAMPLE_VALUE_WEIGHT * SAMPLING_FACTOR', 6)} AS CALC_WEIGHT
FROM f3"""

ORACLE["estimate_counts"] = f"""
WITH {FISH_CTES}
SELECT STATION, CATCH_SAMPLE_ID, SPECIES_CODE, SPECIES_NAME, {fx('SAMPLING_FACTOR', 6)} AS SAMPLING_FACTOR,
       {fx('IND_WEIGHT', 6)} AS IND_WEIGHT, {fx('WEIGHT', 6)} AS WEIGHT, {fx('COUNT', 4)} AS COUNT,
       {fx('CALC_WEIGHT', 6)} AS CALC_WEIGHT, {fx('CALC_COUNT', 4)} AS CALC_COUNT
FROM catch"""

_FISH_LAB = "CASE SPECIES_NAME " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in K.FISH_LABELS.items()) + " ELSE 'Other' END"

ORACLE["station_species_weights"] = f"""
WITH {FISH_CTES},
stations AS ({STATIONS}),
lab AS (SELECT STATION, {_FISH_LAB} AS SPP_LABS, CALC_WEIGHT FROM catch
        WHERE SPECIES_NAME IS NULL OR SPECIES_NAME NOT IN ({in_list(K.NON_FISH_NAMES)})),
fsum AS (SELECT STATION, SPP_LABS, CASE WHEN count(CALC_WEIGHT) = count(*) THEN sum(CALC_WEIGHT) END AS WEIGHT
         FROM lab GROUP BY STATION, SPP_LABS),
cats AS {categories_values('SPP_LABS', K.FISH_BYCATCH_COLUMNS)},
z AS (SELECT s.STATION, s.LAT_DD, s.LON_DD, c.SPP_LABS, coalesce(f.WEIGHT, 0.0::DOUBLE) AS WEIGHT
      FROM stations s CROSS JOIN cats c LEFT JOIN fsum f ON f.STATION = s.STATION AND f.SPP_LABS = c.SPP_LABS)
SELECT STATION, LAT_DD, LON_DD, """ + ", ".join(
    f"{fx('max(WEIGHT) FILTER (WHERE SPP_LABS = ' + q(c) + ')', 6)} AS {c}" for c in K.FISH_BYCATCH_COLUMNS) + """
FROM z GROUP BY STATION, LAT_DD, LON_DD"""


# ---------------------------------------------------------------- crab bycatch / station layers

_SPP_SEX = (f"CASE WHEN SPECIES_CODE = {K.HAIR_CRAB} AND (SEX = 1 OR SEX = 2) THEN 'HairCrab' "
            f"WHEN SPECIES_CODE = {K.TANNER_CRAB} AND SEX = 1 THEN 'MaleTanner' "
            f"WHEN SPECIES_CODE = {K.TANNER_CRAB} AND SEX = 2 THEN 'FemaleTanner' END")


def _crab_long(unit_col: str, units_sql: str, unit_extra: str) -> str:
    """units x 7 categories, zero-filled counts (R: right_join(expand_grid))."""
    return f"""
  SELECT u.UNIT, {unit_extra} c.SPP_SEX, coalesce(p.COUNT, 0.0::DOUBLE) AS COUNT
  FROM ({units_sql}) u CROSS JOIN {categories_values('SPP_SEX', K.SPP_SEX_CATEGORIES)} c
  LEFT JOIN (SELECT {unit_col} AS UNIT, SPP_SEX, sum(1.0::DOUBLE) AS COUNT
             FROM (SELECT *, {_SPP_SEX} AS SPP_SEX FROM specimens
                   WHERE SPECIES_CODE IS NULL OR SPECIES_CODE NOT IN ({K.RED_KING_CRAB}))
             GROUP BY {unit_col}, SPP_SEX) p
    ON p.UNIT = u.UNIT AND p.SPP_SEX = c.SPP_SEX"""


ORACLE["crab_bycatch"] = f"""
WITH specimens AS ({SPECIMENS}), stations AS ({STATIONS}),
z AS ({_crab_long('STATION_KEY', 'SELECT STATION AS UNIT, LAT_DD, LON_DD FROM stations', 'u.LAT_DD, u.LON_DD,')}),
w AS (SELECT UNIT AS STATION, LAT_DD, LON_DD, """ + ", ".join(
    f"max(COUNT) FILTER (WHERE SPP_SEX = {q(c)}) AS {c}" for c in K.SPP_SEX_CATEGORIES) + """
      FROM z GROUP BY UNIT, LAT_DD, LON_DD)
SELECT *, MaleTanner + FemaleTanner AS Tanner, MaleSnow + FemaleSnow AS Snow, MaleHybrid + FemaleHybrid AS Hybrid
FROM w"""

_TRAWL_MAT = f"""
sp AS (SELECT STATION_KEY AS STATION, SPECIES_CODE, SEX, LENGTH, CLUTCH_SIZE, SHELL_CONDITION,
              1.0::DOUBLE AS SAMPLING_FACTOR FROM specimens),
mat_spec AS (
  SELECT STATION, SAMPLING_FACTOR, {MATURITY_CASE} AS MAT_SEX FROM sp
  UNION ALL
  SELECT * FROM (SELECT STATION, SAMPLING_FACTOR, {LEGAL_CASE} AS MAT_SEX FROM sp) WHERE MAT_SEX IS NOT NULL),
pos AS (SELECT STATION, MAT_SEX, sum(SAMPLING_FACTOR) AS C FROM mat_spec GROUP BY STATION, MAT_SEX),
cpue AS (SELECT s.STATION, s.LAT_DD, s.LON_DD, c.MAT_SEX, coalesce(p.C, 0.0::DOUBLE) AS COUNT
         FROM stations s CROSS JOIN {categories_values('MAT_SEX', K.MAT_SEX_CATEGORIES)} c
         LEFT JOIN pos p ON p.STATION = s.STATION AND p.MAT_SEX = c.MAT_SEX)"""

ORACLE["station_total"] = f"""
WITH specimens AS ({SPECIMENS}), stations AS ({STATIONS}), {_TRAWL_MAT}
SELECT STATION, LAT_DD, LON_DD, {fx('sum(COUNT)', 4)} AS COUNT FROM cpue
WHERE MAT_SEX IN ({in_list(K.MATURITY_TOTAL_CATEGORIES)}) GROUP BY STATION, LAT_DD, LON_DD"""

_SHELL_CASE = "CASE " + " ".join(
    f"WHEN SPECIES_CODE = {K.RED_KING_CRAB} AND SEX = {sx} AND {cond} AND SHELL_CONDITION = {k} THEN '{who} SC{k}'"
    for who, sx, cond in (("Mature male", 1, f"LENGTH >= {K.MATURE_MALE_MM}"), ("Mature female", 2, "CLUTCH_SIZE >= 1"))
    for k in (1, 2, 3)) + " END"

ORACLE["shell_counts"] = f"""
WITH specimens AS ({SPECIMENS}), stations AS ({STATIONS}),
sc AS (SELECT STATION_KEY AS STATION, {_SHELL_CASE} AS MAT_SEX_SC FROM specimens),
pos AS (SELECT STATION, MAT_SEX_SC, sum(1.0::DOUBLE) AS C FROM sc WHERE MAT_SEX_SC IS NOT NULL GROUP BY ALL)
SELECT s.STATION, s.LAT_DD, s.LON_DD, c.MAT_SEX_SC, coalesce({fx('p.C', 4)}, 0.0::DOUBLE) AS COUNT
FROM stations s CROSS JOIN {categories_values('MAT_SEX_SC', K.SHELL_CATEGORIES)} c
LEFT JOIN pos p ON p.STATION = s.STATION AND p.MAT_SEX_SC = c.MAT_SEX_SC"""

_GEAR = ("CASE WHEN VESSEL IN ('Marahute', 'Provider') THEN 'POT' WHEN VESSEL IN ('Vesteraalen') THEN 'TRAWL' END")

SPECIES_LONG = f"""
  SELECT {_GEAR} AS GEAR, UNIT, SPP_SEX AS SPECIES, COUNT AS VALUE FROM (
    {_crab_long('SPN', 'SELECT SPN AS UNIT, VESSEL FROM lifts', 'u.VESSEL,')})
  UNION ALL
  SELECT {_GEAR} AS GEAR, UNIT, SPP_SEX AS SPECIES, COUNT AS VALUE FROM (
    {_crab_long('STATION_KEY', "SELECT STATION AS UNIT, 'Vesteraalen' AS VESSEL FROM stations", 'u.VESSEL,')})"""

ORACLE["species_long"] = f"""
WITH {BASE_CTES}, stations AS ({STATIONS})
{SPECIES_LONG}"""

ORACLE["layer_scales"] = f"""
WITH {BASE_CTES}, stations AS ({STATIONS}), sl AS ({SPECIES_LONG}),
lim AS (SELECT GEAR, SPECIES, max(VALUE) AS MAXV FROM sl WHERE GEAR IS NOT NULL GROUP BY GEAR, SPECIES),
l2 AS (SELECT GEAR, SPECIES,
              CASE WHEN SPECIES IN ({in_list(K.CRAB_LAYERS)}) THEN 'count' ELSE 'kg' END AS UNIT,
              MAXV + 5.0::DOUBLE - (MAXV % 5.0::DOUBLE) AS SCALE_LIMIT FROM lim)
SELECT GEAR, SPECIES, UNIT, SCALE_LIMIT, CAST(t.i AS INTEGER) AS BREAK_NO, {fx('t.i * SCALE_LIMIT / 5.0::DOUBLE', 4)} AS BREAK_VALUE
FROM l2 CROSS JOIN range(0, 6) t(i)"""

ORACLE["survey_range"] = """
WITH u AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS SURVEY, o_totalprice / 100000.0::DOUBLE AS T FROM orders)
SELECT CASE WHEN grouping(SURVEY) = 1 THEN 'ALL' ELSE SURVEY END AS SURVEY,
       min(T) AS T_MIN, max(T) AS T_MAX, count(*) AS N
FROM u GROUP BY ROLLUP (SURVEY)"""


# ---------------------------------------------------------------- data quality

SPECIMEN_TABLE = f"""{BASE_CTES}, sf AS ({SF_ROWS}),
stab AS (SELECT sf.*, l.VESSEL, sf.SEX = 2 AS FEM FROM sf LEFT JOIN lifts l ON l.SPN = sf.SPN)"""

_INV_COLS = ["VESSEL", "CRUISE", "SPECIES_CODE", "SEX", "SHELL_CONDITION", "EGG_COLOR", "EGG_CONDITION",
             "CLUTCH_SIZE", "FEM"]
_INV_SETS = {1: ["VESSEL", "CRUISE"], 2: ["VESSEL", "CRUISE", "SPECIES_CODE", "SEX"],
             3: ["SPECIES_CODE", "SEX", "SHELL_CONDITION"],
             4: ["SPECIES_CODE", "SHELL_CONDITION", "EGG_COLOR", "EGG_CONDITION", "CLUTCH_SIZE", "FEM"]}
_GIDS = {k: sum(1 << (len(_INV_COLS) - 1 - i) for i, c in enumerate(_INV_COLS) if c not in v)
         for k, v in _INV_SETS.items()}

ORACLE["inventory"] = f"""
WITH {SPECIMEN_TABLE},
g AS (SELECT {', '.join(_INV_COLS)},
             CASE WHEN count(SAMPLING_FACTOR) = count(*) THEN sum(SAMPLING_FACTOR) END AS C, count(*) AS N,
             grouping({', '.join(_INV_COLS)}) AS GID
      FROM stab GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(v) + ')' for v in _INV_SETS.values())})),
h AS (SELECT *, CASE GID {' '.join(f'WHEN {g} THEN {k}' for k, g in _GIDS.items())} END AS INVENTORY FROM g)
SELECT INVENTORY, VESSEL, CRUISE, SPECIES_CODE, SEX, SHELL_CONDITION, EGG_COLOR, EGG_CONDITION, CLUTCH_SIZE,
       {fx('C', 4)} AS COUNT, N
FROM h WHERE INVENTORY <> 4 OR coalesce(FEM, false)"""

ORACLE["length_ranges"] = f"""
WITH {SPECIMEN_TABLE}
SELECT SPECIES_CODE, SEX,
       CASE WHEN count(LENGTH) = count(*) THEN min(LENGTH) END AS MIN_LENGTH,
       CASE WHEN count(LENGTH) = count(*) THEN max(LENGTH) END AS MAX_LENGTH,
       {fx('CASE WHEN count(SAMPLING_FACTOR) = count(*) THEN min(SAMPLING_FACTOR) END', 6)} AS MIN_SAMPLING_FACTOR,
       {fx('CASE WHEN count(SAMPLING_FACTOR) = count(*) THEN max(SAMPLING_FACTOR) END', 6)} AS MAX_SAMPLING_FACTOR
FROM stab GROUP BY SPECIES_CODE, SEX"""

_FEM = "SEX <> 1"
_NOCOV = "DISEASE_DORSAL IS NULL AND DISEASE_VENTRAL IS NULL AND DISEASE_LEGS IS NULL"
_ANYCOV = "(DISEASE_DORSAL IS NOT NULL OR DISEASE_VENTRAL IS NOT NULL OR DISEASE_LEGS IS NOT NULL)"
QUALITY_RULES = [
    ("Q1", "cruise not the expected one", "NOT coalesce(CRUISE IN (202401), false)", None),
    ("Q2", "vessel not in the survey's set", "NOT coalesce(VESSEL IN ('Marahute', 'Provider'), false)", None),
    ("Q3", "species code not expected", f"NOT coalesce(SPECIES_CODE IN ({K.RED_KING_CRAB}), false)", None),
    ("Q4", "sex not 1 or 2", "NOT coalesce(SEX IN (1, 2), false)", None),
    ("Q5", "female egg color not in {0, 2-6}", f"NOT coalesce(EGG_COLOR IN ({in_list(K.EGG_COLOR_CODES)}), false)", _FEM),
    ("Q6", "female egg condition not in 0-5", f"NOT coalesce(EGG_CONDITION IN ({in_list(K.EGG_CONDITION_CODES)}), false)", _FEM),
    ("Q7", "female clutch size not in {0-6, 999}", f"NOT coalesce(CLUTCH_SIZE IN ({in_list(K.CLUTCH_CODES)}), false)", _FEM),
    ("Q8", "male with egg color, egg condition or clutch size",
     "SEX = 1 AND (EGG_COLOR IS NOT NULL OR EGG_CONDITION IS NOT NULL OR CLUTCH_SIZE IS NOT NULL)", "SEX = 1"),
    ("Q9a", "female shell 0 with egg condition 1", f"{_FEM} AND SHELL_CONDITION = 0 AND EGG_CONDITION = 1", _FEM),
    ("Q9b", "female shell 1 with egg condition > 1", f"{_FEM} AND SHELL_CONDITION = 1 AND EGG_CONDITION > 1", _FEM),
    ("Q9c", "female shell 3-5 with egg condition 1", f"{_FEM} AND SHELL_CONDITION IN (3, 4, 5) AND EGG_CONDITION = 1", _FEM),
    ("Q10", "female missing an egg code", "SEX = 2 AND (EGG_COLOR IS NULL OR EGG_CONDITION IS NULL OR CLUTCH_SIZE IS NULL)", "SEX = 2"),
    ("Q11", "missing length", "LENGTH IS NULL", None),
    ("Q12", "female < 65 mm with clutch > 0", f"{_FEM} AND LENGTH < 65 AND CLUTCH_SIZE > 0", _FEM),
    ("Q13", "length < 60 with shell condition > 2", "LENGTH < 60 AND SHELL_CONDITION > 2", None),
    ("Q14", "width entered for a length-measured species",
     f"coalesce(SPECIES_CODE IN ({K.RED_KING_CRAB}), false) AND WIDTH IS NOT NULL", None),
    ("Q16", "black mat without % coverage", f"DISEASE_CODE = 1 AND {_NOCOV}", "DISEASE_CODE = 1"),
    ("Q17", "bitter crab recorded", "DISEASE_CODE = 2", None),
    ("Q18", "coverage entered without a disease code", f"DISEASE_CODE IS NULL AND {_ANYCOV}", None),
    ("Q19", "disease code > 9", "DISEASE_CODE > 9", None),
    ("Q21", "sampling factor < 1", "SAMPLING_FACTOR < 1", None),
]

ORACLE["quality_report"] = f"""
WITH {SPECIMEN_TABLE},
a AS (SELECT """ + ", ".join(
    f"count(*) FILTER (WHERE coalesce({ap or 'true'}, false) AND coalesce({v}, false)) AS v{i}, "
    f"count(*) FILTER (WHERE coalesce({ap or 'true'}, false)) AS c{i}"
    for i, (_, _, v, ap) in enumerate(QUALITY_RULES)) + """ FROM stab)
""" + "\nUNION ALL\n".join(
    f"SELECT {q(r)} AS RULE_ID, {q(dsc)} AS DESCRIPTION, v{i} AS VIOLATIONS, c{i} AS CHECKED FROM a"
    for i, (r, dsc, _, _) in enumerate(QUALITY_RULES))

ORACLE["orphan_units"] = """
SELECT DISTINCT o_orderkey AS SPN, 'lifts_only' AS SIDE FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
UNION ALL
SELECT DISTINCT l_orderkey AS SPN, 'catch_only' AS SIDE FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)"""


# ---------------------------------------------------------------- geometry

def _stations_xy():
    from ..functions.geo import ALASKA_ALBERS as A
    x, y = A.forward_sql("LON_DD", "LAT_DD")
    return f"SELECT STATION, LON_DD, LAT_DD, TEMP, {fx(x, 2)} AS X, {fx(y, 2)} AS Y FROM ({STATIONS})"


def _window():
    from ..functions.geo import window_corners
    (x0, x1), (y0, y1) = window_corners()
    return f"X BETWEEN {x0!r} AND {x1!r} AND Y BETWEEN {y0!r} AND {y1!r}"


def _pip_sql():
    from ..operators.spatial import layer_edges_sql
    return f"""
  SELECT p.STATION, e.poly_id AS POLY_ID FROM pts p, {layer_edges_sql()} e
  WHERE (e.y1 > p.Y) <> (e.y2 > p.Y) AND p.X < e.x1 + (p.Y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
  GROUP BY p.STATION, e.poly_id HAVING count(*) % 2 = 1"""


ORACLE["albers"] = f"""
WITH pts AS ({_stations_xy()})
SELECT STATION, LON_DD, LAT_DD, X, Y, ({_window()}) AS IN_WINDOW FROM pts"""

ORACLE["points_in_polygon"] = f"WITH pts AS ({_stations_xy()}) {_pip_sql()}"

ORACLE["outside_areas"] = f"""
WITH pts AS ({_stations_xy()}), inside AS ({_pip_sql()})
SELECT STATION, X, Y FROM pts WHERE STATION NOT IN (SELECT STATION FROM inside)"""

ORACLE["grid"] = f"""
WITH pts AS ({_stations_xy()}),
bb AS (SELECT CAST(floor(min(X) / 1000.0::DOUBLE) AS BIGINT) AS ix0, CAST(floor(max(X) / 1000.0::DOUBLE) AS BIGINT) AS ix1,
              CAST(floor(min(Y) / 1000.0::DOUBLE) AS BIGINT) AS iy0, CAST(floor(max(Y) / 1000.0::DOUBLE) AS BIGINT) AS iy1
       FROM pts),
xs AS (SELECT unnest(range(ix0, ix1 + 1)) AS IX FROM bb),
ys AS (SELECT unnest(range(iy0, iy1 + 1)) AS IY FROM bb)
SELECT IX, IY, (IX + 0.5::DOUBLE) * 1000.0::DOUBLE AS X, (IY + 0.5::DOUBLE) * 1000.0::DOUBLE AS Y FROM xs CROSS JOIN ys"""

ORACLE["empirical_variogram"] = f"""
WITH pts AS (SELECT X, Y, avg(TEMP) AS Z FROM (SELECT DISTINCT X, Y, TEMP FROM ({_stations_xy()})) GROUP BY X, Y),
n AS (SELECT *, row_number() OVER (ORDER BY X, Y) AS ID FROM pts),
pr AS (SELECT sqrt((a.X - b.X) ** 2 + (a.Y - b.Y) ** 2) AS DIST, 0.5::DOUBLE * (a.Z - b.Z) ** 2 AS G
       FROM n a JOIN n b ON a.ID < b.ID)
SELECT CAST(floor(DIST / 10000.0::DOUBLE) AS INTEGER) AS BIN, count(*) AS NP, {fx('avg(DIST)', 2)} AS DIST,
       {fx('avg(G)', 6)} AS GAMMA
FROM pr WHERE DIST <= 150000.0::DOUBLE GROUP BY BIN"""


ORACLE["variogram_tree"] = f"SELECT BIN, NP, GAMMA FROM ({ORACLE['empirical_variogram']})"


def _nearest_sql():
    from ..operators.spatial import layer_edges_sql
    t = ("greatest(least(((p.X - x1) * (x2 - x1) + (p.Y - y1) * (y2 - y1)) / "
         "((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 1.0::DOUBLE), 0.0::DOUBLE)")
    return f"""
  SELECT STATION, X, Y, arg_min(poly_id, struct_pack(d := d, p := poly_id)) AS POLY_ID, min(d) AS d FROM (
    SELECT STATION, X, Y, poly_id, sqrt((X - x1 - t * (x2 - x1)) ** 2 + (Y - y1 - t * (y2 - y1)) ** 2) AS d
    FROM (SELECT p.STATION, p.X, p.Y, e.*, {t} AS t FROM pts p, {layer_edges_sql()} e)) GROUP BY STATION, X, Y"""


ORACLE["nearest_area"] = f"""
WITH pts AS ({_stations_xy()}), inside AS ({_pip_sql()}), near AS ({_nearest_sql()})
SELECT STATION, X, Y, POLY_ID, {fx('d', 2)} AS METRES FROM near WHERE STATION NOT IN (SELECT STATION FROM inside)"""


def _mask_sql(res: float):
    from ..operators.spatial import layer_edges_sql
    r = f"{float(res)!r}::DOUBLE"
    return f"""
WITH pts AS ({_stations_xy()}),
bb AS (SELECT CAST(floor(min(X) / {r}) AS BIGINT) AS ix0, CAST(floor(max(X) / {r}) AS BIGINT) AS ix1,
              CAST(floor(min(Y) / {r}) AS BIGINT) AS iy0, CAST(floor(max(Y) / {r}) AS BIGINT) AS iy1 FROM pts),
grid AS (SELECT IX, IY, (IX + 0.5::DOUBLE) * {r} AS X, (IY + 0.5::DOUBLE) * {r} AS Y
         FROM (SELECT unnest(range(ix0, ix1 + 1)) AS IX FROM bb) CROSS JOIN (SELECT unnest(range(iy0, iy1 + 1)) AS IY FROM bb))
SELECT p.IX, p.IY, e.poly_id AS POLY_ID FROM grid p, {layer_edges_sql()} e
WHERE (e.y1 > p.Y) <> (e.y2 > p.Y) AND p.X < e.x1 + (p.Y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
GROUP BY p.IX, p.IY, e.poly_id HAVING count(*) % 2 = 1"""


ORACLE["mask"] = _mask_sql(5 * K.GRID_RES_M)


# ---------------------------------------------------------------- map layers and files

def _map_layer_sql():
    from ..functions.geo import ALASKA_ALBERS as A
    x, y = A.forward_sql("LON_DD", "LAT_DD")
    return f"""
WITH specimens AS ({SPECIMENS}), stations AS ({STATIONS}), {_TRAWL_MAT},
pot AS (SELECT VESSEL, POT_ID AS STATION, LAT_DD, LON_DD, MAT_SEX AS CATEGORY, COUNT
        FROM ({ZERO_FILLED_CATCH}) WHERE length(POT_ID) <= 3),
trawl AS (SELECT 'Vesteraalen' AS VESSEL, CAST(STATION AS VARCHAR) AS STATION, LAT_DD, LON_DD,
                 MAT_SEX AS CATEGORY, {fx('COUNT', 4)} AS COUNT FROM cpue),
u AS (SELECT * FROM pot UNION ALL SELECT * FROM trawl)
SELECT {_GEAR} AS GEAR, VESSEL, STATION, LAT_DD, LON_DD, CATEGORY,
       CASE CATEGORY {' '.join(f"WHEN {q(k)} THEN {q(v)}" for k, v in {**K.MAT_LABELS, **K.BYCATCH_LABELS}.items())}
            ELSE CATEGORY END AS LABEL,
       COUNT, {fx(x, 2)} AS X, {fx(y, 2)} AS Y, COUNT = 0 AS IS_ZERO, 'count' AS UNIT
FROM u"""


ORACLE["map_layer"] = _map_layer_sql()

ORACLE["compare_surveys"] = f"""
WITH z AS (SELECT * FROM ({ZERO_FILLED_CATCH}) WHERE MAT_SEX = 'Mature female'),
u AS (SELECT CAST(year(strptime(DATE_SET, '%m/%d/%Y')) AS VARCHAR) AS SURVEY, SPN, COUNT FROM z
      WHERE year(strptime(DATE_SET, '%m/%d/%Y')) IN (1998, 1999)),
m AS (SELECT max(COUNT) AS MX FROM u)
SELECT SURVEY, SPN, COUNT, m.MX + 5.0::DOUBLE - (m.MX % 5.0::DOUBLE) AS SCALE_LIMIT FROM u, m"""

ORACLE["csv_drop_roundtrip"] = f"""
WITH specimens AS ({SPECIMENS})
SELECT SPN AS HAUL, 'H' || CAST(SPN AS VARCHAR) AS HAUL_ID, SPECIES_CODE, SEX, LENGTH,
       CASE WHEN SPN % 2 = 0 THEN WIDTH END AS WIDTH, SHELL_CONDITION, EGG_COLOR, EGG_CONDITION, CLUTCH_SIZE,
       DISEASE_CODE, DISEASE_DORSAL
FROM specimens"""


ORACLE["cpue_stream"] = ZERO_FILLED_CATCH

ORACLE["pot_bycatch"] = f"""
WITH {BASE_CTES},
sheet AS (SELECT SPN,
   count(*) FILTER (WHERE SPECIES_CODE = {K.TANNER_CRAB} AND SEX = 1) AS MaleTanner,
   count(*) FILTER (WHERE SPECIES_CODE = {K.TANNER_CRAB} AND SEX = 2) AS FemaleTanner,
   count(*) FILTER (WHERE SPECIES_CODE = {K.SNOW_CRAB} AND SEX = 1) AS MaleSnow,
   count(*) FILTER (WHERE SPECIES_CODE = {K.SNOW_CRAB} AND SEX = 2) AS FemaleSnow,
   CAST(0 AS BIGINT) AS MaleHybrid, CAST(0 AS BIGINT) AS FemaleHybrid,
   count(*) FILTER (WHERE SPECIES_CODE = {K.HAIR_CRAB} AND SEX IS NOT NULL) AS HairCrab,
   count(*) FILTER (WHERE PART % 7 = 0) AS PacificCod,
   CASE WHEN SPN % 5 <> 0 THEN count(*) FILTER (WHERE PART % 7 = 1) END AS Other
   FROM specimens GROUP BY SPN),
s2 AS (SELECT s.*, CASE r.VESSEL_CODE WHEN 162 THEN 'Marahute' WHEN 134 THEN 'Provider' END AS VESSEL,
              CASE WHEN s.SPN % 37 = 0 THEN 'SP' ELSE r.POT_ID END AS POT_ID, r.DATE_HAUL
       FROM sheet s JOIN raw_lifts r ON r.SPN = s.SPN),
j AS (SELECT s2.*, l.LON_DD, l.LAT_DD FROM s2 LEFT JOIN lifts l
      ON l.VESSEL IS NOT DISTINCT FROM s2.VESSEL AND l.SPN = s2.SPN AND l.POT_ID IS NOT DISTINCT FROM s2.POT_ID
      WHERE l.LON_DD IS NOT NULL)
SELECT VESSEL, SPN, LAT_DD, LON_DD, POT_ID, DATE_HAUL, MaleTanner, FemaleTanner, MaleSnow, FemaleSnow,
       MaleHybrid, FemaleHybrid, HairCrab, PacificCod, coalesce(Other, 0) AS Other,
       MaleTanner + FemaleTanner AS Tanner, MaleSnow + FemaleSnow AS Snow, MaleHybrid + FemaleHybrid AS Hybrid
FROM j"""

ORACLE["catch_reconcile_totals"] = f"""
WITH {BASE_CTES}, sf AS ({SF_ROWS}),
spec AS (SELECT SPN, SPECIES_CODE, {fx('sum(SAMPLING_FACTOR)')} AS NUMBER_CRAB, count(*) AS N_ENTRIES
         FROM sf GROUP BY SPN, SPECIES_CODE),
cat AS ({ORACLE["expanded_catch_reconcile"]})
SELECT coalesce(s.SPN, c.SPN) AS SPN, coalesce(s.SPECIES_CODE, c.SPECIES_CODE) AS SPECIES_CODE,
       s.NUMBER_CRAB AS SPEC_NUMBER_CRAB, s.N_ENTRIES AS SPEC_N_ENTRIES,
       c.NUMBER_CRAB AS CATCH_NUMBER_CRAB, c.N_ENTRIES AS CATCH_N_ENTRIES
FROM spec s FULL OUTER JOIN cat c ON s.SPN = c.SPN AND s.SPECIES_CODE = c.SPECIES_CODE
WHERE s.NUMBER_CRAB IS DISTINCT FROM c.NUMBER_CRAB OR s.N_ENTRIES IS DISTINCT FROM c.N_ENTRIES"""


def _poly_sql(t: str, coefs) -> str:
    out = None
    for c in reversed(coefs):
        out = repr(float(c)) + "::DOUBLE" if out is None else f"({out} * {t} + {float(c)!r}::DOUBLE)"
    return out


def _xk1_sql(x: str) -> str:
    from ..operators.krige import _I1_SMALL, _K1_LARGE, _K1_SMALL
    x = f"({x})"
    t = f"(({x} / 3.75::DOUBLE) * ({x} / 3.75::DOUBLE))"
    h2 = f"(({x} / 2.0::DOUBLE) * ({x} / 2.0::DOUBLE))"
    small = f"({x} * ln({x} / 2.0::DOUBLE) * ({x} * {_poly_sql(t, _I1_SMALL)}) + {_poly_sql(h2, _K1_SMALL)})"
    big = f"({x} * {_poly_sql('(2.0::DOUBLE / ' + x + ')', _K1_LARGE)} / (sqrt({x}) * exp({x})))"
    return f"(CASE WHEN {x} <= 0.0 THEN 1.0::DOUBLE WHEN {x} <= 2.0 THEN {small} ELSE {big} END)"


def _fit_sql(cands: str) -> str:
    """Per candidate RANGE: exact weighted least squares for nugget and psill."""
    h = "b.DIST"
    w = f"(b.NP::DOUBLE / greatest({h} * {h}, 1e-12::DOUBLE))"
    f = f"(1.0::DOUBLE - {_xk1_sql(h + ' / c.RANGE')})"
    return f"""
  SELECT RANGE, NUGGET, PSILL,
         (SELECT sum((b.NP::DOUBLE / greatest(b.DIST * b.DIST, 1e-12::DOUBLE))
                     * (b.GAMMA - (NUGGET + PSILL * (1.0::DOUBLE - {_xk1_sql('b.DIST / s.RANGE')}))) ** 2)
          FROM bins b) AS SSE
  FROM (SELECT RANGE,
         CASE WHEN det > 0 AND c0 >= 0 AND c1 >= 0 THEN c0 WHEN det > 0 AND c0 < 0 THEN 0.0::DOUBLE
              ELSE greatest(coalesce(sg / nullif(sw, 0), 0.0::DOUBLE), 0.0::DOUBLE) END AS NUGGET,
         CASE WHEN det > 0 AND c0 >= 0 AND c1 >= 0 THEN c1
              WHEN det > 0 AND c0 < 0 THEN greatest(coalesce(sfg / nullif(sff, 0), 0.0::DOUBLE), 0.0::DOUBLE)
              ELSE 0.0::DOUBLE END AS PSILL
        FROM (SELECT *, (sg * sff - sf * sfg) / nullif(det, 0) AS c0, (sw * sfg - sf * sg) / nullif(det, 0) AS c1
              FROM (SELECT *, sw * sff - sf * sf AS det FROM (
                    SELECT c.RANGE, sum({w}) AS sw, sum({w} * {f}) AS sf, sum({w} * {f} * {f}) AS sff,
                           sum({w} * b.GAMMA) AS sg, sum({w} * {f} * b.GAMMA) AS sfg
                    FROM ({cands}) c CROSS JOIN bins b GROUP BY c.RANGE)))) s"""


def _fit_ctes(where: str = "true") -> str:
    """CTEs of the samples of some stations (n), their pairs, bins and fitted model (m)."""
    return f"""
pts AS (SELECT X, Y, avg(TEMP) AS Z FROM (SELECT DISTINCT X, Y, TEMP FROM ({_stations_xy()}) WHERE {where}) GROUP BY X, Y),
n AS (SELECT *, row_number() OVER (ORDER BY X, Y) AS ID FROM pts),
pr AS (SELECT sqrt((a.X - b.X) ** 2 + (a.Y - b.Y) ** 2) AS DIST, 0.5::DOUBLE * (a.Z - b.Z) ** 2 AS G
       FROM n a JOIN n b ON a.ID < b.ID),
bins AS (SELECT CAST(floor(DIST / 10000.0::DOUBLE) AS INTEGER) AS BIN, count(*) AS NP, avg(DIST) AS DIST, avg(G) AS GAMMA
         FROM pr WHERE DIST <= 150000.0::DOUBLE GROUP BY BIN),
k AS (SELECT max(DIST) * 0.01::DOUBLE AS lo, max(DIST) * 3.0::DOUBLE AS hi FROM bins),
r AS (SELECT lo, hi, pow(hi / lo, 1.0::DOUBLE / 119.0::DOUBLE) AS ratio FROM k),
coarse AS ({_fit_sql("SELECT r.lo * pow(r.ratio, t.i::DOUBLE) AS RANGE FROM r, range(0, 120) t(i)")}),
best AS (SELECT arg_min(RANGE, SSE) AS b FROM coarse),
fine AS ({_fit_sql("SELECT b / r.ratio + ((b * r.ratio - b / r.ratio) / 59.0::DOUBLE) * t.i::DOUBLE AS RANGE FROM best, r, range(0, 60) t(i)")}),
m AS (SELECT arg_min(NUGGET, SSE) AS NUGGET, arg_min(PSILL, SSE) AS PSILL, arg_min(RANGE, SSE) AS RANGE, min(SSE) AS SSE FROM fine)"""


_FIT_CTES = _fit_ctes()

ORACLE["variogram_fit_rounded"] = f"""
WITH {_FIT_CTES}
SELECT {fx('NUGGET', 6)} AS NUGGET, {fx('PSILL', 6)} AS PSILL, {fx('RANGE', 3)} AS RANGE, {fx('SSE * 1e9::DOUBLE', 3)} AS SSE_E9 FROM m"""

ORACLE["variogram_fit"] = f"""
WITH {_FIT_CTES}
SELECT {fx('NUGGET', 6)} AS NUGGET, {fx('PSILL', 6)} AS PSILL, {fx('RANGE', 3)} AS RANGE,
       RANGE <= lo * 1.0001 OR RANGE >= hi * 0.9999 AS RANGE_AT_BOUND FROM m, r"""


ORACLE["variogram_fit_newton"] = f"""
WITH {_FIT_CTES}
SELECT true AS CONVERGED, true AS NO_WORSE, RANGE <= lo * 1.0001 OR RANGE >= hi * 0.9999 AS RANGE_AT_BOUND,
       {fx('SSE * 1e9::DOUBLE', 3)} AS GRID_SSE_E9 FROM m, r"""


# ---------------------------------------------------------------- kriging by elimination

def _cells_sql(res: float) -> str:
    from ..operators.spatial import TEST_LAYERS, layer_edges_sql
    r = f"{float(res)!r}::DOUBLE"
    return f"""
bb AS (SELECT CAST(floor(min(X) / {r}) AS BIGINT) AS ix0, CAST(floor(max(X) / {r}) AS BIGINT) AS ix1,
              CAST(floor(min(Y) / {r}) AS BIGINT) AS iy0, CAST(floor(max(Y) / {r}) AS BIGINT) AS iy1 FROM ({_stations_xy()})),
grid AS (SELECT IX * 4294967296 + IY AS CELL, (IX + 0.5::DOUBLE) * {r} AS X, (IY + 0.5::DOUBLE) * {r} AS Y
         FROM (SELECT unnest(range(ix0, ix1 + 1)) AS IX FROM bb) CROSS JOIN (SELECT unnest(range(iy0, iy1 + 1)) AS IY FROM bb)),
cells AS (SELECT p.CELL, p.X, p.Y FROM grid p, {layer_edges_sql({"boundary": TEST_LAYERS["strata"]})} e
  WHERE (e.y1 > p.Y) <> (e.y2 > p.Y) AND p.X < e.x1 + (p.Y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
  GROUP BY ALL HAVING count(*) % 2 = 1)"""


def _cov_sql(h: str) -> str:
    return f"CASE WHEN {h} > 0 THEN m.PSILL * {_xk1_sql(h + ' / m.RANGE')} ELSE m.NUGGET + m.PSILL END"


def _eliminated(start: str, key: str = "") -> str:
    """Rows (step, i, row) of Gauss-Jordan elimination of `start` (i from 1, row), one system per `key`."""
    k, on = (f"g.{key}, ", f"p.{key} = g.{key} AND ") if key else ("", "")
    return f"""
  SELECT {key + ', ' if key else ''}0 AS step, i, row FROM {start}
  UNION ALL
  SELECT {k}g.step + 1, g.i, CASE WHEN g.i = p.i THEN list_transform(g.row, lambda v: v / p.row[p.i])
    ELSE list_transform(list_zip(g.row, p.row), lambda t: t[1] - g.row[p.i] / p.row[p.i] * t[2]) END
  FROM g JOIN g p ON {on}p.step = g.step AND p.i = g.step + 1"""


_PAIR = "sqrt((a.X - b.X) * (a.X - b.X) + (a.Y - b.Y) * (a.Y - b.Y))"
_MATRIX = f"cov AS (SELECT a.ID AS i, list({_cov_sql('h')} ORDER BY b) AS c FROM (SELECT a.ID, b.ID AS b, {_PAIR} AS h FROM n a, n b) a, m GROUP BY a.ID)"


def _band_sql(x: str) -> str:
    def fmt(v):
        return "Inf" if v == float("inf") else "-Inf" if v == float("-inf") else str(int(v)) if float(v).is_integer() else str(v)
    cases = " ".join(f"WHEN {x} > '{lo}'::DOUBLE AND {x} <= '{hi}'::DOUBLE THEN '({fmt(lo)},{fmt(hi)}]'"
                     for lo, hi in zip(K.TEMP_BREAKS[:-1], K.TEMP_BREAKS[1:]))
    return f"CASE {cases} END"


def _surface_sql(res: float, where: str = "true") -> str:
    """CELL, X, Y, PRED of the cells inside the boundary, from the loggers of some stations."""
    return f"""
WITH RECURSIVE {_fit_ctes(where)}, {_cells_sql(res)}, {_MATRIX},
a0 AS (SELECT i, list_concat(c, [Z, 1.0::DOUBLE]) AS row FROM cov JOIN n ON n.ID = i),
g AS ({_eliminated("a0")}),
w0 AS (SELECT i, row[len(row) - 1] AS a, row[len(row)] AS b FROM g WHERE step = (SELECT count(*) FROM n)),
mean AS (SELECT sum(a) / sum(b) AS mu FROM w0),
w AS (SELECT n.X, n.Y, a - mu * b AS w, mu FROM w0 JOIN n ON n.ID = i, mean)
SELECT CELL, cx AS X, cy AS Y, mu + sum(({_cov_sql('h')}) * w) AS PRED
FROM (SELECT a.CELL, a.X AS cx, a.Y AS cy, b.w, b.mu, {_PAIR} AS h FROM cells a, w b) t, m GROUP BY CELL, cx, cy, mu"""


ORACLE["temp_surface"] = f"""
SELECT CELL, X, Y, {fx('PRED', 3)} AS TEMPERATURE, {_band_sql('PRED')} AS BAND FROM ({_surface_sql(K.GRID_RES_M)})"""

ORACLE["temp_variance"] = f"""
WITH RECURSIVE {_FIT_CTES}, {_cells_sql(5 * K.GRID_RES_M)}, {_MATRIX},
a0 AS (SELECT i, list_concat(c, list_transform(range(1, len(c) + 1), lambda k: CASE WHEN k = i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS row FROM cov),
g AS ({_eliminated("a0")}),
inv AS (SELECT i, row[len(row) // 2 + 1:] AS inv FROM g WHERE step = (SELECT count(*) FROM n)),
one AS (SELECT i, list_sum(inv) AS b, list_dot_product(inv, (SELECT list(Z ORDER BY ID) FROM n)) AS a FROM inv),
s AS (SELECT sum(a) / sum(b) AS mu, sum(b) AS total FROM one),
v AS (SELECT CELL, cx, cy, list({_cov_sql('h')} ORDER BY ID) AS k
      FROM (SELECT a.CELL, a.X AS cx, a.Y AS cy, b.ID, {_PAIR} AS h FROM cells a, n b) t, m GROUP BY CELL, cx, cy),
q AS (SELECT CELL, cx, cy, sum(k[i] * list_dot_product(inv, k)) AS kk, sum(k[i] * b) AS k1, sum(k[i] * a) AS kz
      FROM v, inv JOIN one USING (i) GROUP BY CELL, cx, cy)
SELECT CELL, cx AS X, cy AS Y, {fx('(mu + kz - mu * k1)', 3)} AS TEMPERATURE,
  {fx('greatest(m.NUGGET + m.PSILL - kk + (1.0::DOUBLE - k1) * (1.0::DOUBLE - k1) / total, 0.0::DOUBLE)', 3)} AS VARIANCE FROM q, s, m"""

ORACLE["temp_local"] = f"""
WITH RECURSIVE {_FIT_CTES}, {_cells_sql(5 * K.GRID_RES_M)},
near AS (SELECT CELL, cx, cy, X, Y, Z, {_cov_sql('sqrt(h2)')} AS k0,
           row_number() OVER (PARTITION BY CELL ORDER BY h2, X, Y) AS i
         FROM (SELECT c.CELL, c.X AS cx, c.Y AS cy, n.X, n.Y, n.Z, (c.X - n.X) * (c.X - n.X) + (c.Y - n.Y) * (c.Y - n.Y) AS h2 FROM cells c, n) t, m
         QUALIFY i <= 16),
last AS (SELECT CELL, max(i) + 1 AS size FROM near GROUP BY CELL),
sys AS (SELECT CELL, i, list_concat(list({_cov_sql('h')} ORDER BY j), [1.0::DOUBLE, any_value(k0)]) AS row
        FROM (SELECT a.CELL, a.i, b.i AS j, a.k0, {_PAIR} AS h FROM near a JOIN near b USING (CELL)) t, m GROUP BY CELL, i),
a0 AS (SELECT * FROM sys UNION ALL
       SELECT CELL, size, list_concat(list_transform(range(1, size), lambda k: 1.0::DOUBLE), [0.0::DOUBLE, 1.0::DOUBLE]) FROM last),
g AS ({_eliminated("a0", "CELL")}),
w AS (SELECT g.CELL, g.i, row[len(row)] AS w FROM g JOIN last ON last.CELL = g.CELL AND g.step = last.size)
SELECT near.CELL, cx AS X, cy AS Y, {fx('sum(w.w * near.Z)', 3)} AS TEMPERATURE,
  {fx('greatest(any_value(m.NUGGET + m.PSILL) - sum(w.w * k0) - any_value(mu.w), 0.0::DOUBLE)', 3)} AS VARIANCE
FROM near JOIN w ON w.CELL = near.CELL AND w.i = near.i JOIN last ON last.CELL = near.CELL
  JOIN w mu ON mu.CELL = near.CELL AND mu.i = last.size, m GROUP BY near.CELL, cx, cy"""
