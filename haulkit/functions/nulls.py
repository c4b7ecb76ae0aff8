"""R-style missing-value semantics as Spark column expressions.

The survey scripts rely on R rules that differ from SQL (see README, "NULL
rules").  Each helper here makes the intended rule explicit so the plan stays
inside whole-stage codegen (no Python per row).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- N3: strict aggregates (any NULL input -> NULL result, as R's sum/mean/min/max)

def strict_sum(c) -> Column:
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def strict_avg(c) -> Column:
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def strict_min(c) -> Column:
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.min(c))


def strict_max(c) -> Column:
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.max(c))


# --- N4 / B8: NOT IN that keeps NULL rows (R's `!x %in% set` is never NA)

def not_in(c, values: Iterable) -> Column:
    return ~F.coalesce(_c(c).isin(list(values)), F.lit(False))


def is_in(c, values: Iterable) -> Column:
    """R's `x %in% set`: FALSE (not NULL) for a NULL x."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


# --- N9 / H13 / H14: division that yields NULL instead of Inf or an ANSI error

def safe_div(a, b) -> Column:
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


# --- B4: NULL -> 0 before aggregating

def coalesce0(c) -> Column:
    return F.coalesce(_c(c), F.lit(0))


# --- B16: lenient numeric coercion (R's as.integer / as.numeric give NA)

def to_int(c) -> Column:
    return F.expr(f"try_cast({_sql(c)} AS INT)") if isinstance(c, str) else c.try_cast("int")


def to_double(c) -> Column:
    return F.expr(f"try_cast({_sql(c)} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# --- N18: a CSV text cell that is NULL or the empty string

def is_blank(c) -> Column:
    c = _c(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def present(c) -> Column:
    return ~is_blank(c)


# --- B9 / B10 / B11: keep complete rows

def require(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any listed column (all columns when None)."""
    return df.dropna(how="any", subset=list(cols) if cols is not None else None)


def require_any(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows that are NULL in every listed column."""
    return df.dropna(how="all", subset=list(cols))


# --- B14 / B15: fills

def fill(df: DataFrame, values: dict) -> DataFrame:
    """Per-column fill (R's replace_na(list(...))); columns absent are ignored."""
    present_cols = {k: v for k, v in values.items() if k in df.columns}
    return df.fillna(present_cols) if present_cols else df


def fill_all0(df: DataFrame) -> DataFrame:
    """Fill every numeric NULL with 0 (strings stay NULL; documented deviation)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=cols) if cols else df


# --- N6 / B17: identifier prefix; a NULL id stays NULL (no false "XNA" key)

def prefix_id(c, prefix: str = "X") -> Column:
    return F.concat(F.lit(prefix), _c(c).cast("string"))
