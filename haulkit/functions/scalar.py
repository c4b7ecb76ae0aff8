"""Scalar column functions (H1-H18, B3, B17, B18, B21), all JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .nulls import _c, is_in, safe_div


# --- H1: HHMM (leading zeros lost) -> "HH:MM"; anything invalid -> NULL

def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _hhmm_sql(col_sql: str) -> str:
    s = f"trim(CAST({col_sql} AS STRING))"
    p = f"lpad({s}, 4, '0')"
    return (f"CASE WHEN {s} RLIKE '^[0-9]{{1,4}}$' AND try_cast(substring({p}, 1, 2) AS INT) <= 23 "
            f"AND try_cast(substring({p}, 3, 2) AS INT) <= 59 "
            f"THEN concat(substring({p}, 1, 2), ':', substring({p}, 3, 2)) END")


def hhmm(c) -> Column:
    if isinstance(c, str):            # one SQL expression: one JVM call instead of dozens
        return F.expr(_hhmm_sql(_q(c)))
    s = F.trim(_c(c).cast("string"))
    p = F.lpad(s, 4, "0")           # lpad truncates longer input, so test length first
    h = F.substring(p, 1, 2).try_cast("int")
    m = F.substring(p, 3, 2).try_cast("int")
    ok = s.rlike(r"^[0-9]{1,4}$") & (h <= 23) & (m <= 59)
    return F.when(ok, F.concat(F.substring(p, 1, 2), F.lit(":"), F.substring(p, 3, 2)))


# --- H2: "m/d/Y" date + "HH:MM" time in a named zone -> TIMESTAMP (an instant)

def lift_ts(date, time, tz: str = "America/Anchorage", date_format: str = "M/d/yyyy") -> Column:
    """Wall-clock date and time interpreted in `tz` (never the session zone, N7)."""
    if isinstance(date, str) and isinstance(time, str):
        d = f"try_to_date(CAST({_q(date)} AS STRING), '{date_format}')"
        t = f"CAST({_q(time)} AS STRING)"
        ok = f"{t} RLIKE '^[0-9]{{1,2}}:[0-9]{{2}}$'"
        hh = f"CASE WHEN {ok} THEN try_cast(split({t}, ':')[0] AS INT) END"
        mm = f"CASE WHEN {ok} THEN try_cast(split({t}, ':')[1] AS INT) END"
        return F.expr(f"try_make_timestamp(year({d}), month({d}), dayofmonth({d}), {hh}, {mm}, "
                      f"CAST(0 AS DECIMAL(16,6)), '{tz}')")
    d = F.try_to_date(_c(date).cast("string"), date_format)
    t = _c(time).cast("string")
    ok = t.rlike(r"^[0-9]{1,2}:[0-9]{2}$")
    hh = F.when(ok, F.split(t, ":").getItem(0).try_cast("int"))
    mm = F.when(ok, F.split(t, ":").getItem(1).try_cast("int"))
    return F.try_make_timestamp(F.year(d), F.month(d), F.dayofmonth(d), hh, mm,
                                F.lit(0).cast("decimal(16,6)"), F.lit(tz))


# --- H3: elapsed hours between two instants

def soak_hours(set_ts, haul_ts) -> Column:
    return (F.unix_micros(_c(haul_ts)) - F.unix_micros(_c(set_ts))) / F.lit(3.6e9)


# --- H4: degrees + decimal minutes -> decimal degrees (sign -1 for west longitude)

def dm_to_dd(deg, minutes, sign: float = 1.0) -> Column:
    return (_c(deg).cast("double") + _c(minutes).cast("double") / 60.0) * F.lit(sign)


# --- H5 / H6 / H7: crab classes (case_when: NULL tests are false, no match -> NULL)

def maturity_class(species, sex, length, clutch, species_code: int = K.RED_KING_CRAB,
                   mature_mm: float = K.MATURE_MALE_MM) -> Column:
    sp, sx, ln, cl = _c(species), _c(sex), _c(length), _c(clutch)
    rkc = sp == species_code
    return (F.when(rkc & (sx == K.MALE) & (ln >= mature_mm), "Mature male")
             .when(rkc & (sx == K.MALE) & (ln < mature_mm), "Immature male")
             .when(rkc & (sx == K.FEMALE) & (cl >= 1), "Mature female")
             .when(rkc & (sx == K.FEMALE) & (cl == 0), "Immature female"))


def legal_class(species, sex, length, species_code: int = K.RED_KING_CRAB,
                legal_mm: float = K.LEGAL_MALE_MM) -> Column:
    sp, sx, ln = _c(species), _c(sex), _c(length)
    rkc = (sp == species_code) & (sx == K.MALE)
    return F.when(rkc & (ln >= legal_mm), "Legal male").when(rkc & (ln < legal_mm), "Sublegal male")


def shell_class(species, sex, length, clutch, shell, species_code: int = K.RED_KING_CRAB,
                mature_mm: float = K.MATURE_MALE_MM) -> Column:
    sp, sx, ln, cl, sc = _c(species), _c(sex), _c(length), _c(clutch), _c(shell)
    mm = (sp == species_code) & (sx == K.MALE) & (ln >= mature_mm)
    mf = (sp == species_code) & (sx == K.FEMALE) & (cl >= 1)
    out = None
    for who, cond in (("Mature male", mm), ("Mature female", mf)):
        for k in (1, 2, 3):
            lab = f"{who} SC{k}"
            w = cond & (sc == k)
            out = F.when(w, lab) if out is None else out.when(w, lab)
    return out


# --- H8: crab bycatch label by species code x sex

def bycatch_label(species, sex) -> Column:
    sp, sx = _c(species), _c(sex)
    return (F.when((sp == K.HAIR_CRAB) & ((sx == K.MALE) | (sx == K.FEMALE)), "HairCrab")
             .when((sp == K.TANNER_CRAB) & (sx == K.MALE), "MaleTanner")
             .when((sp == K.TANNER_CRAB) & (sx == K.FEMALE), "FemaleTanner"))


# --- H9: fish label by species name, else "Other" (a NULL name is "Other" too)

def fish_label(name, labels: Mapping[str, str] = K.FISH_LABELS, other: str = K.OTHER_LABEL) -> Column:
    n = _c(name)
    out = None
    for k, v in labels.items():
        out = F.when(n == k, v) if out is None else out.when(n == k, v)
    return out.otherwise(other)


# --- H10: round up strictly to the next multiple (x + m - x mod m; 10 -> 15 for m=5)

def round_up(c, m: float) -> Column:
    x = _c(c).cast("double")
    return x + F.lit(float(m)) - F.pmod(x, F.lit(float(m)))


# --- H11: n equal steps from 0 to limit (n + 1 values)

def breaks(limit, n: int = K.SCALE_N_BREAKS) -> Column:
    lim = _c(limit).cast("double")
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: i.cast("double") * lim / F.lit(float(n)))


# --- H12

def is_zero(c) -> Column:
    return _c(c) == 0


# --- H13 / H14: rates and individual weights without Inf

# --- H16: temperature band, right-closed intervals (a, b]

def temp_band(c, edges: Sequence[float] = K.TEMP_BREAKS) -> Column:
    x = _c(c).cast("double")
    out = None

    def fmt(v):
        if v == float("inf"):
            return "Inf"
        if v == float("-inf"):
            return "-Inf"
        return str(int(v)) if float(v).is_integer() else str(v)

    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        lab = f"({fmt(lo)},{fmt(hi)}]"
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


# --- H18: legend unit by taxon

def measure_of(species, crab: Sequence[str] = K.CRAB_LAYERS) -> Column:
    return F.when(is_in(species, crab), "count").otherwise("kg")


# --- B3: vessel code -> name; unknown -> `default` (NULL for pots, "" for trawl)

def decode_vessel(c, mapping: Mapping[int, str] = K.VESSEL_NAMES, default=None) -> Column:
    v = _c(c)
    out = None
    for k, name in mapping.items():
        out = F.when(v == k, name) if out is None else out.when(v == k, name)
    return out.otherwise(F.lit(default).cast("string"))


# --- B21: gear class from the vessel name

def gear_of(vessel, pot: Sequence[str] = K.POT_VESSELS, trawl: Sequence[str] = K.TRAWL_VESSELS) -> Column:
    v = _c(vessel)
    return F.when(is_in(v, pot), "POT").when(is_in(v, trawl), "TRAWL")


# --- B18: fold a species variant into its parent

def merge_species_name(name, variant: tuple[str, str] = K.PACIFIC_COD_NAME_VARIANT) -> Column:
    n = _c(name)
    return F.when(n == variant[0], variant[1]).otherwise(n)


def merge_species_code(code, variant: tuple[int, int] = K.PACIFIC_COD_VARIANT) -> Column:
    c = _c(code)
    return F.when(c == variant[0], variant[1]).otherwise(c)


# --- B13: regular station codes only

def regular_station(c, maxlen: int = K.MAX_STATION_CODE_LEN) -> Column:
    """R keeps `!nchar(x) > maxlen`: NULL stations are dropped by filter."""
    return F.length(_c(c).cast("string")) <= maxlen


# --- output rounding: half away from zero on x * 10^d (the same double in any engine)

def fix(c, d: int = 4) -> Column:
    s = float(10 ** d)
    return F.round(_c(c).cast("double") * F.lit(s)) / F.lit(s)
