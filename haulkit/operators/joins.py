"""Join helpers with dplyr key semantics (N1 NULL matches NULL, N2 natural keys).

Joins are ordinary equi-joins: `<=>` keys are planned by Catalyst as hash /
sort-merge joins on (coalesce(k), isnull(k)) pairs, so AQE can still pick a
broadcast from measured sizes and split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """The key set a dplyr join without `by` would use (left column order)."""
    rset = set(right.columns)
    return [c for c in left.columns if c in rset]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None,
                   how: str = "left", part: str | None = None,
                   only: str | None = None) -> DataFrame:
    """Equi-join on `keys` where NULL matches NULL; one output column per key.

    `how` is one of inner/left/right/full/left_semi/left_anti.  Key columns of
    the result take the left value, or the right one where the left is absent
    (right/full rows without a partner), as a `using` join would.

    `part` names a column of both sides that follows from the keys and is never
    NULL: sides already dealt by it (`repartition(part)`) are not dealt again,
    and neither is the result by a next join or aggregation that takes it in.
    `only` names a boolean column of the left side: other rows have no partner.

    Rows are sorted by the keys in their order, the first of them mostly without
    looking at the row: a key of many values should come first.
    """
    keys = list(keys) if keys is not None else common_columns(left, right)
    if not keys:
        raise ValueError("null_safe_join needs at least one key (use an explicit cross product)")
    l = left.alias("__l")
    r = right.alias("__r")
    cond = None if part is None else F.col(f"__l.`{part}`") == F.col(f"__r.`{part}`")
    for k in keys:
        e = F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`"))
        cond = e if cond is None else cond & e
    if only is not None:
        cond = cond & F.col(f"__l.`{only}`")
    keys = keys if part is None else [part, *keys]
    joined = l.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    out = []
    for k in keys:
        if how in ("right", "right_outer", "rightouter"):
            out.append(F.col(f"__r.`{k}`").alias(k))
        elif how in ("full", "outer", "full_outer", "fullouter"):
            out.append(F.coalesce(F.col(f"__l.`{k}`"), F.col(f"__r.`{k}`")).alias(k))
        else:
            out.append(F.col(f"__l.`{k}`").alias(k))
    kset = set(keys)
    out += [F.col(f"__l.`{c}`").alias(c) for c in left.columns if c not in kset]
    lset = set(left.columns)
    for c in right.columns:
        if c in kset:
            continue
        # dplyr suffixes clashing payload columns with .x / .y
        name = c + ".y" if c in lset else c
        out.append(F.col(f"__r.`{c}`").alias(name))
    return joined.select(*out)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """N1 + N2: dplyr `left_join(x, y)` with no `by`."""
    return null_safe_join(left, right, common_columns(left, right), how)


def split_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each string key as two columns (`key_parts`) that are never NULL: its value,
    empty for NULL, and whether it is NULL.  Equality on both is N1, so a table
    aggregated by them is joined by them without being dealt out again."""
    return df.withColumns({null_flag(k): F.col(k).isNull() for k in keys} | {k: F.coalesce(F.col(k), F.lit("")) for k in keys})


def merge_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys as before `split_nulls`."""
    return df.withColumns({k: F.when(~F.col(null_flag(k)), F.col(k)) for k in keys}).drop(*map(null_flag, keys))


def null_flag(key: str) -> str:
    return f"__null_{key}"


def key_parts(keys: Sequence[str]) -> list[str]:
    return [c for k in keys for c in (k, null_flag(k))]


def null_safe_parts(df: DataFrame, key: str) -> list[Column]:
    """What `null_safe_join` sorts a key by, for groups of rows that come sorted from one."""
    zero = F.lit("") if dict(df.dtypes)[key] == "string" else F.lit(0).cast(df.schema[key].dataType)
    return [F.coalesce(F.col(key), zero), F.col(key).isNull()]


def with_group_stats(df: DataFrame, keys: Sequence[str], *aggs) -> DataFrame:
    """Attach per-group aggregates to every row without a window.

    A window over `keys` would put a whole group into one task; the aggregate
    is partially combined map-side and joined back, so a hot group (a third of
    all rows) is split across tasks by AQE's skew-join handling.
    """
    stats = df.groupBy(*keys).agg(*aggs)
    return null_safe_join(df, stats, list(keys), "inner")


def key_multiplicity(df: DataFrame, keys: Sequence[str], name: str = "n_matches") -> DataFrame:
    """Rows per key: the guard for many-to-many joins (>1 means fan-out)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))
