"""Potlift / haul cleaning: B3, B5-B7, B13, B17, H1-H4 applied to frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..functions.nulls import present


def valid_lifts(df: DataFrame, time_col: str = "TIME_HAUL", date_col: str = "DATE_HAUL",
                exclude: Mapping[str, object] | None = None) -> DataFrame:
    """Drop lifts with no haul time or date, and listed lift ids."""
    out = df.where(present(time_col) & present(date_col))
    for c, v in (exclude or {}).items():
        out = out.where(F.col(c) != F.lit(v))
    return out


def recode_gear(df: DataFrame, gear_col: str = "GEAR_CODE", keep: str = "42",
                where=None) -> DataFrame:
    """B7 (per-vessel sheet): keep one gear code, blank the others; NULL stays
    NULL.  `where` limits the recode to one sheet's rows in a single pass."""
    g = F.col(gear_col).cast("string")
    new = F.when(g == keep, keep).when(g.isNotNull(), "")
    return df.withColumn(gear_col, new if where is None else F.when(where, new).otherwise(g))


def gear_filter(df: DataFrame, gear_col: str = "GEAR_CODE", vessel_col: str = "VESSEL",
                codes=("44",)) -> DataFrame:
    """Keep gear unset (with a vessel), empty, or a listed code.

    Same precedence as the reference filter: the vessel test guards only the
    unset-gear branch."""
    g = F.col(gear_col).cast("string")
    cond = (F.col(vessel_col).isNotNull() & g.isNull()) | g.isin(list(codes)) | (g == "")
    return df.where(cond)


def regular_stations(df: DataFrame, col: str = "STATION", maxlen: int = K.MAX_STATION_CODE_LEN) -> DataFrame:
    """Drop camera, bait and coffin pots (codes longer than `maxlen`)."""
    return df.where(S.regular_station(col, maxlen))


def derive_lift_fields(df: DataFrame, tz: str = "America/Anchorage") -> DataFrame:
    """H1-H4 on a potlift sheet: HH:MM times, soak hours, decimal degrees."""
    t_set, t_haul = S.hhmm("TIME_SET"), S.hhmm("TIME_HAUL")
    ts_set = S.lift_ts("DATE_SET", t_set, tz)
    ts_haul = S.lift_ts("DATE_HAUL", t_haul, tz)
    # one projection, so every derived field reads the raw sheet values
    return df.withColumns({
        "TIME_SET": t_set, "TIME_HAUL": t_haul,
        "SOAK_TIME": S.soak_hours(ts_set, ts_haul),
        "LAT_DD": S.dm_to_dd("LAT_DEG", "LAT_MIN"),
        "LON_DD": S.dm_to_dd("LON_DEG", "LON_MIN", -1.0),
    })
