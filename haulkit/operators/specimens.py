"""Specimen-table construction: long biometrics -> wide, joins with guards.

D15 (widen with the N14 duplicate guard), D19 (lengthen), C1-C14 helpers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import key_multiplicity, null_safe_join


def widen(long: DataFrame, ids: Sequence[str], name_col: str, value_col: str,
          names: Sequence[str], dup_col: str | None = "N_DUP", distinct: bool = False,
          also: Sequence[Column] = ()) -> DataFrame:
    """Long (id, name, value) -> one column per listed name.

    The name list is explicit, so the pivot is a single conditional
    aggregation (no extra job to discover names).  A cell whose (id, name)
    occurs more than once is NULL — R would build a list column there (N14)
    — and `dup_col` counts such names per id; `duplicates()` lists them.
    """
    n = F.col(name_col)
    aggs = []
    dup_flags = []
    for nm in names:
        hit = n == nm
        value = F.when(hit, F.col(value_col))
        if distinct:
            many = ~F.min(value).eqNullSafe(F.max(value)) | (F.max(value).isNotNull() & (F.count_if(hit & value.isNull()) > 0))
        else:
            many = F.count_if(hit) > 1
        aggs.append(F.when(~many, F.max(value)).alias(nm))
        dup_flags.append(F.when(many, 1).otherwise(0))
    if dup_col:
        total = dup_flags[0]
        for f in dup_flags[1:]:
            total = total + f
        aggs.append(total.cast("int").alias(dup_col))
    return long.groupBy(*ids).agg(*aggs, *also)


def duplicates(long: DataFrame, ids: Sequence[str], name_col: str) -> DataFrame:
    """The reject table for `widen`: (ids, name) keys that occur more than once."""
    m = key_multiplicity(long, list(ids) + [name_col])
    return m.where(F.col("n_matches") > 1)


def lengthen(wide: DataFrame, ids: Sequence[str], cols: Sequence[str], name_col: str = "SPECIES",
             value_col: str = "VALUE") -> DataFrame:
    """Wide species columns -> long rows (unpivot, no shuffle)."""
    return wide.unpivot(list(ids), list(cols), name_col, value_col)


def fanout(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: str | None = None) -> DataFrame:
    """Multiplicity report for a many-to-many join: keys whose right side has
    more than one row, with the number of left rows each would multiply (`rows`:
    a column of the left side saying for how many rows one stands)."""
    rm = key_multiplicity(right, keys, "right_rows").where(F.col("right_rows") > 1)
    lm = (key_multiplicity(left, keys, "left_rows") if rows is None
          else left.groupBy(*keys).agg(F.sum(rows).cast("bigint").alias("left_rows")))
    return null_safe_join(rm, lm, list(keys), "inner")
